"""Scalar functions by family, each with the warehouse dialect's semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as s
from tidemark.plans import inputs as i
from tidemark.plans.registry import query


@query("string_functions", covers="F07", sql="""SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS init, trim(p_brand, 'B#') AS trimmed, ltrim(p_brand, 'Brand') AS lt, rtrim(p_name, 'tl') AS rt, length(p_name) AS len, left(p_name, 3) AS l3, right(p_name, 3) AS r3,
 substr(p_name, 2, 4) AS sub, string_split(p_name, ' ')[1] AS first_word, split_part(p_name, ' ', 2) AS second_word, split_part(p_name, ' ', -1) AS last_word, split_part(p_name, ' ', 1) AS zero_word, replace(p_name, 'red', 'RED') AS rep, p_brand || '/' || p_type AS con, p_brand || '-' || nullif(p_type, 'PROMO') AS strict,
 contains(p_name, 'bolt') AS has_bolt, starts_with(p_name, 'small') AS small, strpos(p_name, 'e') AS pos, chr(65 + p_size % 26) AS ch FROM part""")
def string_functions(t):
    n, b, k = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return t.part.select(
        "p_partkey", F.upper(n).alias("up"), F.lower(k).alias("low"), F.initcap(k).alias("init"), F.btrim(b, F.lit("B#")).alias("trimmed"), F.expr("trim(LEADING 'Brand' FROM p_brand)").alias("lt"),
        F.expr("trim(TRAILING 'tl' FROM p_name)").alias("rt"), F.length(n).cast("long").alias("len"), F.left(n, F.lit(3)).alias("l3"), F.right(n, F.lit(3)).alias("r3"), F.substring(n, 2, 4).alias("sub"),
        F.get(F.split(n, " "), F.lit(0)).alias("first_word"), s.split_part(n, " ", 2).alias("second_word"), s.split_part(n, " ", -1).alias("last_word"), s.split_part(n, " ", 0).alias("zero_word"),
        F.replace(n, F.lit("red"), F.lit("RED")).alias("rep"), F.concat(b, F.lit("/"), k).alias("con"), s.concat_strict("-", b, F.nullif(k, F.lit("PROMO"))).alias("strict"),
        F.contains(n, F.lit("bolt")).alias("has_bolt"), F.startswith(n, F.lit("small")).alias("small"), F.locate("e", n).cast("long").alias("pos"), F.char(F.col("p_size") % 26 + 65).alias("ch"))


@query("regex_functions", covers="F11 M05", sql="""SELECT p_partkey, nullif(regexp_extract(p_brand, '[0-9]+'), '') AS digits, array_to_string(regexp_extract_all(p_name, '[aeiou]'), '') AS vowels, len(regexp_extract_all(p_name, '[aeiou]')) AS n_vowels, regexp_replace(p_name, '[aeiou]', '', 'g') AS bare,
 CASE WHEN regexp_matches(p_name, 'l') THEN strpos(p_name, 'l') ELSE 0 END AS first_l, regexp_extract(p_name, '([a-z]+) ([a-z]+)', 2) AS word2, array_to_string(list_filter(regexp_split_to_array(p_name, '[ e]'), lambda x: x <> ''), '|') AS tokens FROM part""")
def regex_functions(t):
    n = F.col("p_name")
    vowels = F.regexp_extract_all(n, F.lit("[aeiou]"), F.lit(0))
    return t.part.select("p_partkey", F.regexp_substr("p_brand", F.lit("[0-9]+")).alias("digits"), F.array_join(vowels, "").alias("vowels"), F.regexp_count(n, F.lit("[aeiou]")).cast("long").alias("n_vowels"),
                         F.regexp_replace(n, "[aeiou]", "").alias("bare"), F.regexp_instr(n, F.lit("l")).cast("long").alias("first_l"), F.regexp_extract(n, "([a-z]+) ([a-z]+)", 2).alias("word2"),
                         F.array_join(s.strtok_array(n, " e"), "|").alias("tokens"))


@query("hash_functions", covers="M05 P17", sql="""WITH x AS (SELECT *, upper(substr(md5(c_name), 1, 4)) || substr(md5(c_name), 5, 3) || upper(substr(md5(c_name), 8, 5)) || substr(md5(c_name), 13, CASE WHEN c_custkey % 9 = 0 THEN 2 ELSE 3 END) AS raw_id FROM customer)
SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS h, raw_id, CASE WHEN length(raw_id) <> 15 THEN raw_id ELSE raw_id || array_to_string(list_transform([0, 5, 10], lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ012345',
 1 + list_sum(list_transform([0, 1, 2, 3, 4], lambda i: CASE WHEN substr(raw_id, g + i + 1, 1) BETWEEN 'A' AND 'Z' THEN (2 ** i)::INTEGER ELSE 0 END))::INTEGER, 1)), '') END AS safe_id,
 CAST(strftime(TIMESTAMP '2024-01-01 05:00:00' + to_hours(CAST(c_custkey % 10 AS INTEGER)) - INTERVAL 8 HOUR, '%Y%m%d') AS INTEGER) AS zoned FROM x""")
def hash_functions(t):
    """Ids of mixed case made from names; every ninth has 14 characters and stays as it is."""
    m, k = F.md5("c_name"), F.col("c_custkey")
    raw = F.concat(F.upper(F.substring(m, 1, 4)), F.substring(m, 5, 3), F.upper(F.substring(m, 8, 5)), F.when(k % 9 == 0, F.substring(m, 13, 2)).otherwise(F.substring(m, 13, 3)))
    at = F.timestamp_add("HOUR", (k % 10).cast("int"), F.expr("timestamp_ntz'2024-01-01 05:00:00'"))
    x = t.customer.withColumn("raw_id", raw)
    return x.select("c_custkey", m.alias("m"), F.sha2("c_name", 256).alias("h"), "raw_id", s.case_safe_id("raw_id").alias("safe_id"), s.zoned_date_id(at).alias("zoned"))


@query("masked_random", covers="M05", sql="SELECT c_custkey, 12 AS n, true AS is_plain FROM customer")
def masked_random(t):
    """Random mask of sensitive text: not repeatable, so its length and characters are compared."""
    m = t.customer.select("c_custkey", s.masked_random(12).alias("masked"))
    return m.select("c_custkey", F.length("masked").alias("n"), F.col("masked").rlike("^[A-Za-z0-9]*$").alias("is_plain"))


@query("timestamps_from_text", covers="F05", sql="""WITH x AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS good, CASE WHEN o_orderkey % 7 = 0 THEN 'no date' WHEN o_orderkey % 7 <> 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS maybe FROM orders)
SELECT o_orderkey, CAST(good AS TIMESTAMP) AS strict, TRY_CAST(maybe AS TIMESTAMP) AS tried, maybe AS held FROM x""")
def timestamps_from_text(t):
    """Text to time, failing or NULL where it doesn't parse, and a value held as a variant."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    maybe = F.when(k % 7 == 0, "no date").when(k % 7 != 1, F.date_format(day, "yyyy-MM-dd"))
    x = t.orders.select(k, F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("good"), maybe.alias("maybe"))
    held = F.variant_get(F.to_variant_object(F.struct("maybe")), "$.maybe", "string")
    return x.select("o_orderkey", F.to_timestamp_ntz("good").alias("strict"), F.try_to_timestamp("maybe").cast("timestamp_ntz").alias("tried"), held.alias("held"))


@query("conditional_functions", covers="F05 F06 F12", sql="""WITH x AS (SELECT p_partkey, nullif(p_size % 5, 0) AS a, nullif(p_size % 3, 0) AS b FROM part) SELECT p_partkey, coalesce(a, b, -1) AS co, ifnull(a, 9) AS ifn, coalesce(a, 0) AS zin, nullif(b, 0) AS niz, CASE WHEN a > b THEN 'y' ELSE 'n' END AS iff, CASE a WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'more' END AS dec,
 a IS NOT DISTINCT FROM b AS eqn, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) END AS lst, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN greatest(a, b) END AS grt FROM x""")
def conditional_functions(t):
    x = t.part.select("p_partkey", F.nullif(F.col("p_size") % 5, F.lit(0)).alias("a"), F.nullif(F.col("p_size") % 3, F.lit(0)).alias("b"))
    return x.select("p_partkey", F.coalesce("a", "b", F.lit(-1)).alias("co"), F.ifnull("a", F.lit(9)).alias("ifn"), F.zeroifnull("a").alias("zin"), F.nullifzero("b").alias("niz"),
                    s.iff(F.col("a") > F.col("b"), "y", "n").alias("iff"), s.decode("a", {1: "one", 2: "two"}, "more").alias("dec"), F.equal_null("a", "b").alias("eqn"),
                    s.least_or_null("a", "b").alias("lst"), s.greatest_or_null("a", "b").alias("grt"))


@query("math_functions", covers="F05", sql="""SELECT p_partkey, round(p_retailprice, 1) AS r1, CAST(floor(p_retailprice / 7) AS BIGINT) AS fl, trunc(p_retailprice) AS tr, abs(p_size - 25) AS ab, pow(p_size, 2) AS pw, round(ln(p_size), 6) AS lg, CASE WHEN p_size % 4 = 0 THEN 0 ELSE p_retailprice / (p_size % 4) END AS d0,
 CASE WHEN coalesce(nullif(p_size % 4, 1), 0) = 0 THEN 0 ELSE p_retailprice / (p_size % 4) END AS d0n, p_retailprice / nullif(p_size % 4, 0) AS ratio FROM part""")
def math_functions(t):
    p, z = F.col("p_retailprice"), F.col("p_size")
    return t.part.select("p_partkey", F.round(p, 1).alias("r1"), F.floor(p / 7).alias("fl"), p.cast("long").cast("double").alias("tr"), F.abs(z - 25).alias("ab"), F.pow(z, F.lit(2)).alias("pw"), F.round(F.ln(z), 6).alias("lg"),
                         s.div0(p, z % 4).alias("d0"), s.div0null(p, F.nullif(z % 4, F.lit(1))).alias("d0n"), s.ratio(p, z % 4).alias("ratio"))


@query("conversion_functions", covers="F07 F19", sql="""SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS txt, TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN 'x1' ELSE CAST(o_orderkey AS VARCHAR) END AS BIGINT) AS num, TRY_CAST(CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'maybe' END AS BOOLEAN) AS flag,
 strftime(o_orderdate, '%Y/%m') AS formatted, CAST('2020-01-' || lpad(CAST(o_orderkey % 28 + 1 AS VARCHAR), 2, '0') AS DATE) AS parsed, TRY_CAST('2020-02-' || lpad(CAST(o_orderkey % 40 + 1 AS VARCHAR), 2, '0') AS DATE) AS maybe_date, epoch_ms(CAST(o_orderkey * 1000000 AS BIGINT)) AS from_millis,
 make_timestamp(CAST(o_orderkey AS BIGINT) * 1000000) AS from_seconds, [o_orderkey] AS arr, TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE '1.5' END AS DOUBLE) IS NOT NULL AS real FROM orders""")
def conversion_functions(t):
    k = F.col("o_orderkey")
    utc = lambda x: F.convert_timezone(F.current_timezone(), F.lit("UTC"), x.cast("timestamp_ntz"))
    day = lambda m, n: F.concat(F.lit(f"2020-{m}-"), F.lpad((k % n + 1).cast("string"), 2, "0"))
    return t.orders.select("o_orderkey", F.col("o_totalprice").cast("string").alias("txt"), F.when(k % 3 == 0, "x1").otherwise(k.cast("string")).try_cast("bigint").alias("num"),
                           F.when(k % 2 == 0, "true").otherwise("maybe").try_cast("boolean").alias("flag"), F.date_format("o_orderdate", "yyyy/MM").alias("formatted"), F.to_date(day("01", 28)).alias("parsed"),
                           day("02", 40).try_cast("date").alias("maybe_date"), utc(F.timestamp_millis(k * 1000000)).alias("from_millis"), utc(F.timestamp_seconds(k)).alias("from_seconds"),
                           F.array(k).alias("arr"), s.is_real(F.when(k % 5 == 0, "n/a").otherwise("1.5")).alias("real"))


@query("date_functions", covers="F07", sql="""WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate + to_hours(CAST(o_orderkey % 500 AS INTEGER)) + to_minutes(CAST(o_orderkey % 59 AS INTEGER)) AS TIMESTAMP) AS e, o_orderdate AS o FROM orders)
SELECT o_orderkey, CAST(date_trunc('week', d) AS DATE) AS wk, CAST(date_trunc('quarter', d) AS DATE) AS qt, CAST(d + INTERVAL 1 MONTH AS DATE) AS plus_month, CAST(d - INTERVAL 10 DAY AS DATE) AS minus_days, date_diff('day', d, CAST(e AS DATE)) AS dd, date_diff('month', d, CAST(e AS DATE)) AS dm, date_diff('year', d, CAST(e AS DATE)) AS dy,
 date_diff('hour', o, e) AS dh, date_diff('minute', o, e) AS dmi, date_diff('day', date_trunc('week', d), date_trunc('week', e)) // 7 AS dw, date_diff('quarter', d, CAST(e AS DATE)) AS dq, year(d) AS y, month(d) AS m, day(d) AS dom, hour(e) AS h, minute(e) AS mi, strftime(d, '%a') AS dn, strftime(d, '%b') AS mn, CAST(last_day(d) AS DATE) AS ld, weekofyear(d) AS wy, CAST(isodow(d) AS BIGINT) AS dow FROM x""")
def date_functions(t):
    k = F.col("o_orderkey")
    e = F.timestamp_add("MINUTE", (k % 59).cast("int"), F.timestamp_add("HOUR", (k % 500).cast("int"), F.col("o_orderdate")))
    x = t.orders.select(k, i.day("o_orderdate").alias("d"), e.alias("e"), F.col("o_orderdate").alias("o"))
    diff = lambda u, a="d": s.boundary_diff(u, a, "e").cast("long")
    b = lambda c: c.cast("long")
    return x.select("o_orderkey", F.trunc("d", "week").alias("wk"), F.trunc("d", "quarter").alias("qt"), F.add_months("d", 1).alias("plus_month"), F.date_sub("d", 10).alias("minus_days"), diff("day").alias("dd"), diff("month").alias("dm"),
                    diff("year").alias("dy"), diff("hour", "o").alias("dh"), diff("minute", "o").alias("dmi"), diff("week").alias("dw"), diff("quarter").alias("dq"), b(F.year("d")).alias("y"), b(F.month("d")).alias("m"),
                    b(F.dayofmonth("d")).alias("dom"), b(F.hour("e")).alias("h"), b(F.minute("e")).alias("mi"), F.date_format("d", "E").alias("dn"), F.date_format("d", "MMM").alias("mn"), F.last_day("d").alias("ld"),
                    b(F.weekofyear("d")).alias("wy"), b(F.weekday("d") + 1).alias("dow"))


@query("time_zones", covers="F07", sql="""SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS local_ts, CASE WHEN TRY_CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) IS NOT NULL THEN CAST(ts AS DATE) END AS day, round(date_diff('day', DATE '2023-12-01', CAST(ts AS DATE)) / 31.0, 6) * 0 + date_diff('month', DATE '2023-12-01', CAST(ts AS DATE)) AS months FROM events""")
def time_zones(t):
    return t.events.select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), "ts").alias("local_ts"), i.day("ts").alias("day"),
                           F.floor(F.months_between(F.trunc("ts", "month"), F.expr("date'2023-12-01'"))).cast("double").alias("months"))


@query("array_functions", covers="F07", sql="""WITH x AS (SELECT p_partkey, [p_size, p_size % 7, nullif(p_size % 3, 0)] AS a, string_split(p_name, ' ') AS w FROM part)
SELECT p_partkey, len(list_filter(a, lambda v: v IS NOT NULL)) AS compact, array_to_string(list_append(w, 'end'), ',') AS app, array_to_string(list_prepend('start', w), ',') AS pre, array_to_string([w[1], 'mid'] || w[2:], ',') AS ins, list_contains(w, 'bolt') AS has, list_has_any(w, ['bolt', 'gear']) AS ovl, len(a) AS size, array_to_string(w[1:1], ',') AS slc,
 array_to_string(list_sort(w), ',') AS srt, list_max(a) AS mx, list_min(a) AS mn, w[1] AS g0, w[9] AS g8, array_to_string(w, '+') AS joined FROM x""")
def array_functions(t):
    w, a = F.col("w"), F.col("a")
    x = t.part.select("p_partkey", F.array("p_size", F.col("p_size") % 7, F.nullif(F.col("p_size") % 3, F.lit(0))).alias("a"), F.split("p_name", " ").alias("w"))
    j = lambda c: F.array_join(c, ",")
    return x.select("p_partkey", F.size(F.array_compact(a)).cast("long").alias("compact"), j(F.array_append(w, F.lit("end"))).alias("app"), j(F.array_prepend(w, F.lit("start"))).alias("pre"), j(s.array_insert0(w, 1, F.lit("mid"))).alias("ins"),
                    F.array_contains(w, "bolt").alias("has"), F.arrays_overlap(w, F.array(F.lit("bolt"), F.lit("gear"))).alias("ovl"), F.size(a).cast("long").alias("size"), j(s.array_slice(w, 0, 1)).alias("slc"), j(F.array_sort(w)).alias("srt"),
                    F.array_max(a).alias("mx"), F.array_min(a).alias("mn"), F.get(w, F.lit(0)).alias("g0"), F.get(w, F.lit(8)).alias("g8"), F.array_join(w, "+").alias("joined"))


@query("json_functions", covers="F19", sql="""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 1 END AS parsed, array_to_string(json_keys(props), ',') AS keys, CASE WHEN event_id % 2 = 0 THEN '{"id":' || event_id || ',"v":"x"}' ELSE '{"id":' || event_id || '}' END AS built FROM events""")
def json_functions(t):
    e = F.col("event_id")
    bad = F.when(e % 4 == 0, F.lit("{broken")).otherwise(F.col("props"))
    built = F.to_json(F.struct(e.alias("id"), F.when(e % 2 == 0, "x").alias("v")))
    return t.events.select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"), F.when(F.try_parse_json(bad).isNotNull(), 1).alias("parsed"),
                           F.array_join(F.json_object_keys("props"), ",").alias("keys"), built.alias("built"))
