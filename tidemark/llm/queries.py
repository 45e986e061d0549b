"""The operators over whole tables, one query each, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import brown, chat, decontaminate, divergence, jaccard, lines, mixing, quality, resampling, rules, sharding, substrings, urls
from tidemark.llm.common import n_words, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = scratch(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    dealt = mixing.copies(sized, F.col("size"))
    return dealt.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL["op4_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS most,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) AS k
  FROM sized GROUP BY source),
lev AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY most / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM src),
aim AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM (SELECT *, least(most, max(lvl) OVER () * w) AS target FROM lev)),
line AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY cls, bucket, size, doc_id) AS rk
  FROM (SELECT *, floor(16 * log2(size + 1.5))::INT AS cls,
               floor(64 * (('0x' || substr(md5('mix' || chr(31) || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE))::INT AS bucket
        FROM sized)),
off AS (
  SELECT l.*, a.source_size, a.target, a.rate,
         ('0x' || substr(md5('mix' || chr(31) || (l.source IS NULL)::VARCHAR || chr(31) || coalesce(l.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM line l JOIN aim a ON l.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate * rk + u) - floor(rate * (rk - 1) + u)))::BIGINT AS taken FROM off
"""


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    back = chat.read_back(chat.render(chat.fold(chat.as_streamed(turns))))
    learnt = F.array_join("learnt", "")
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _escapes(text: str) -> str:
    counts = [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in ("\\", *chat.CONTROL)]
    return " + ".join(counts)


SQL["op5_chat_formatting"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(chat.START + chat.SEP + chat.END)} + length(role) + length(text) + {_escapes("role")} + {_escapes("text")})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


URL_RULES = [
    urls.PathRule("allow", "org", "/"),
    urls.PathRule("block", "example.org", "/es/"),
    urls.PathRule("block", "example.org", "/en/1"),
    urls.PathRule("allow", "com", "/fr/"),
    urls.PathRule("block", "com", "/de/"),
]


@query
def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


@query
def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = substrings.remove_repeats(table(spark, folder, "documents"))
    return cleaned.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("repeated"), F.coalesce(F.try_divide("n_removed", "n_bytes"), F.lit(0.0)).alias("removed_share"),
    )


@query
def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.similar(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies", "n_shingles")


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The whole table, after copies of a tenth of it were delivered under ids beyond the table's and withdrawn again."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    span = docs.agg(F.max("doc_id") - F.min("doc_id") + 1).first()[0] or 0
    copies = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0).where("doc_id is not null").select((F.col("doc_id") + span).alias("doc_id"), "text")
    cleaned = lines.dedup_lines(docs, withdrawn=copies)
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


SQL["op3_line_dedup"] = """
WITH line AS (
  SELECT r, doc_id, pos, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS pos
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
often AS (
  SELECT k, max(coalesce(doc_id, -9223372036854775808)) AS last FROM line WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT r) >= 3),
judged AS (
  SELECT line.*, often.k IS NOT NULL AND coalesce(doc_id, -9223372036854775808) <> last AS gone FROM line LEFT JOIN often ON line.k = often.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    hit = F.aggregate("hits", F.lit(0), lambda a, r: a + r["end"] - r["first"]).cast("long")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


SQL["op7_decontamination"] = """
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + least(10, len(w))], ' ') AS k, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
spot AS (
  SELECT r, i, n, array_to_string(w[i + 1 : i + n], ' ') AS k
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i FROM doc, size WHERE len(w) >= n)),
hit AS (SELECT spot.r, spot.i, spot.n, win.item_id FROM spot JOIN win ON spot.k = win.k AND spot.n = win.n),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""


@query
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = brown.held_out(F.col("doc_id"))
    scored = brown.score(docs, brown.fit(docs.where(~held)))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


SQL["op1_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(greatest(1, len(w) - 4)), lambda i: array_to_string(w[i + 1 : i + 5], ' ')))) END AS s
  FROM d),
t AS (SELECT r, len(s) AS n, unnest(s) AS g FROM s),
common AS (SELECT a.r AS a, b.r AS b, any_value(a.n) AS x, any_value(b.n) AS y, count(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
link AS (SELECT a, b FROM common WHERE c / (x + y - c) >= 0.8),
reach AS (SELECT r AS a, r AS b FROM s UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
class AS (SELECT a AS r, min(doc_id) AS class_id FROM reach JOIN s ON s.r = reach.b GROUP BY 1),
n_link AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY 1)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, CASE WHEN len(s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY s) END AS n_copies, len(s)::BIGINT AS n_shingles
FROM s JOIN class USING (r) LEFT JOIN n_link USING (r)
"""


def _rules_sql(risk: float = 0.05, error: float = 0.05) -> str:
    """The operator's steps over the same rules, with the binomial bound as a plain sum."""
    def passed(r: rules.Rule) -> str:
        sign = ">" if r.above else "<"
        return " + ".join(f"coalesce(({r.top} / nullif({r.bottom}, 0) {sign} {c})::INT, 0)" for c in r.grid)

    places = ", ".join(f"[{i}, {passed(r)}]" for i, r in enumerate(rules.RULES))
    risk /= len(rules.RULES)
    cutoffs = sum(len(r.grid) for r in rules.RULES)
    lone = r"[^\x20\x09-\x0D]"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{lone}')) AS ls
  FROM documents),
win AS (SELECT r, i, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM (SELECT r, w, unnest(range(len(w) - 2)) AS i FROM d WHERE len(w) > 2)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY 1),
s AS (
  SELECT doc_id, stratum, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(again.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g'))::BIGINT AS n_capitals, length(regexp_replace(t, '[^!]+', '', 'g'))::BIGINT AS n_exclamations
  FROM d LEFT JOIN again USING (r)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [{places}] AS places FROM s),
held AS (SELECT stratum, quality = 1 AS good, unnest(places) AS p FROM j JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IS NOT NULL),
cell AS (SELECT stratum, p[1] AS rule, p[2] AS passed, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad FROM held GROUP BY 1, 2, 3),
found AS (
  SELECT *, sum(good) OVER (PARTITION BY stratum, rule) AS n, sum(bad) OVER (PARTITION BY stratum, rule) AS n_bad,
         sum(good) OVER (PARTITION BY stratum, rule ORDER BY passed DESC) AS k, sum(bad) OVER (PARTITION BY stratum, rule ORDER BY passed DESC) AS k_bad
  FROM cell),
safe AS (
  SELECT *, k_bad * n - k * n_bad AS gain,
         list_sum(list_transform(range((k + 1)::BIGINT), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) AS tail
  FROM found WHERE passed > 0 AND k < n * {risk}),
best AS (
  SELECT stratum, rule, passed FROM safe WHERE gain > 0 AND tail * (SELECT count(DISTINCT stratum) FROM cell) * {cutoffs} <= {error}
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, passed DESC) = 1),
cut AS (SELECT stratum, list([rule, passed]) AS cuts FROM best GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(len(list_filter(cuts, lambda c: places[c[1] + 1][2] >= c[2])), 0) = 0 AS kept
FROM j LEFT JOIN cut USING (stratum)
"""


SQL["op2_quality_rules"] = _rules_sql()


@query
def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length("text") + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("same"),
    ).fillna({"size": 8})
    dealt = sharding.shard(docs, size=F.col("size"), group=F.col("same"), shards=24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: crc32 of the bytes whose hexadecimal digits are in {h}, by a table made from the polynomial.
_CRC_TABLE = "(SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc)"
_CRC = (
    "xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all({h}, '..'), lambda x: ('0x' || x)::BIGINT), "
    "lambda c, x: xor(c // 256, crc[xor(c % 256, x) + 1])), 4294967295)"
)

SQL["op11_sharding"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t, (strlen(coalesce(text, '')) + 8)::BIGINT AS size, md5(coalesce(text, '')) AS g FROM documents),
code AS (
  SELECT g, {_CRC.format(h="h")}::BIGINT AS text_crc32 FROM (SELECT DISTINCT g, hex(encode(t)) AS h FROM d) x, {_CRC_TABLE}),
grp AS (SELECT g, sum(size)::BIGINT AS bytes, min(coalesce(doc_id, -9223372036854775808)) AS first FROM d GROUP BY g),
line AS (SELECT *, row_number() OVER (ORDER BY bytes DESC, first, g) AS k FROM grp),
lpt AS (
  SELECT 0::BIGINT AS k, -1::BIGINT AS shard, list_transform(range(24), lambda i: 0::BIGINT) AS loads
  UNION ALL
  SELECT line.k, list_position(loads, list_min(loads)) - 1,
         list_transform(loads, lambda x, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN x + bytes ELSE x END)
  FROM lpt JOIN line ON line.k = lpt.k + 1),
place AS (
  SELECT a.g, b.shard
  FROM (SELECT g, bytes, row_number() OVER (PARTITION BY bytes ORDER BY k) AS n FROM line) a
  JOIN (SELECT bytes, shard, row_number() OVER (PARTITION BY bytes ORDER BY shard) AS n FROM lpt JOIN line USING (k)) b USING (bytes, n))
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, g) - 1 AS slot, NULL::INT AS grown_shard
FROM d JOIN place USING (g) JOIN code USING (g)
"""


@query
def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


SQL["op12_divergence"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
own AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
lang AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY 1),
grp AS (SELECT DISTINCT lang, source FROM d),
total AS (SELECT lang, source, sum(n) AS n FROM own GROUP BY 1, 2),
cell AS (
  SELECT grp.lang, source, term, coalesce(own.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(own.n, 0) + 1) // (coalesce(total.n, 0) + lang.v))::HUGEINT AS p,
         (1 + 1000000000::HUGEINT * (kept.n + 1) // (lang.n + lang.v))::HUGEINT AS q
  FROM grp JOIN kept USING (lang) JOIN lang USING (lang) LEFT JOIN own USING (lang, source, term) LEFT JOIN total USING (lang, source)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM cell WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)))::INT AS rank FROM every
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)))::INT AS rank FROM term)
WHERE rank <= 200
"""


@query
def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op13_resampling"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
i AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
own AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY 1, 2),
aim AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM i) GROUP BY 1),
code AS (
  SELECT w, {_CRC.format(h="h")} % 10000 AS b
  FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM own UNION SELECT w FROM aim)) x, {_CRC_TABLE}),
s AS (SELECT b, sum(n)::DOUBLE AS s FROM own JOIN code USING (w) GROUP BY 1),
t AS (SELECT b, sum(n)::DOUBLE AS t FROM aim JOIN code USING (w) GROUP BY 1),
gain AS (
  SELECT s.b, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000) / ((s + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (b)),
weight AS (SELECT r, sum(n * gain)::BIGINT AS weight FROM own JOIN code USING (w) JOIN gain USING (b) GROUP BY 1),
score AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN weight USING (r)),
line AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features) END AS k FROM score)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= (SELECT count(*) FROM score WHERE n_features >= 20) * 10 // 100 THEN k END AS rank FROM line
"""
