"""Semi-structured data and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as s
from tidemark.operators import semistructured as ss
from tidemark.operators import text_rules as tr
from tidemark.plans import inputs as i
from tidemark.plans.registry import query

K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def contexts(t):
    """Events with a context list: a page context on even ids, a person context on ids not divisible by three."""
    page = F.concat(F.lit('{"schema":"shop/page/jsonschema/1-0-0","data":{"id":"'), F.col("event_id").cast("string"), F.lit('","k":'), F.get_json_object("props", "$.k"), F.lit("}}"))
    person = F.concat(F.lit('{"schema":"shop/person/jsonschema/2-0-1","data":{"user":'), F.col("user_id").cast("string"), F.lit(',"staff":"'), (F.col("user_id") % 2 == 0).cast("string"), F.lit('"}}'))
    parts = F.array_compact(F.array(F.when(F.col("event_id") % 2 == 0, page), F.when(F.col("event_id") % 3 != 0, person)))
    return t.events.select("event_id", "event_type", "props", F.concat(F.lit('{"data":['), F.array_join(parts, ","), F.lit("]}")).alias("contexts"))


@query("unpack_contexts", covers="P13 F19", sql=f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id END AS page_id, CASE WHEN event_id % 2 = 0 THEN {K_SQL} END AS page_k,
 CASE WHEN event_id % 3 <> 0 THEN user_id END AS person_user, CASE WHEN event_id % 3 <> 0 THEN user_id % 2 = 0 END AS person_staff FROM events""")
def unpack_contexts(t):
    c = ss.unpack_context(contexts(t), "contexts", "shop/page/jsonschema/%", {"id": "bigint", "k": "int"}, "page_")
    c = ss.unpack_context(c, "contexts", "%/person/%", {"user": "bigint", "staff": "boolean"}, "person_")
    return c.drop("contexts", "event_type", "props")


@query("unpack_event_fields", covers="P13", sql=f"""SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN {K_SQL} END AS ui_k FROM events""")
def unpack_event_fields(t):
    return ss.unpack_event(t.events.select("event_id", "event_type", "props"), "event_type", ["click", "view"], "props", {"k": "int"}, "ui_").drop("props")


SQL_NESTED = """payload AS (SELECT o_custkey AS id, '{"orders":{"count":' || count(*) || ',"open":' || CASE WHEN count(*) FILTER (o_orderstatus = 'O') = 0 THEN -1 ELSE count(*) FILTER (o_orderstatus = 'O') END
 || '},"seen":["' || min(o_orderpriority) || '","' || max(o_orderpriority) || '"],"deep":{"a":{"b":{"keys":' || max(o_orderkey) || '}}},"name":"c' || o_custkey || '"}' AS payload FROM orders GROUP BY o_custkey)"""


def nested_payload(t):
    opened = F.count_if(F.col("o_orderstatus") == "O")
    g = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").alias("n"), F.when(opened == 0, -1).otherwise(opened).alias("open"), F.min("o_orderpriority").alias("p0"),
        F.max("o_orderpriority").alias("p1"), F.max("o_orderkey").alias("k"))
    return g.select("id", F.to_json(F.struct(
        F.struct(F.col("n").alias("count"), "open").alias("orders"), F.array("p0", "p1").alias("seen"),
        F.struct(F.struct(F.struct(F.col("k").alias("keys")).alias("b")).alias("a")).alias("deep"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("name"))).alias("payload"))


@query("flatten_metrics", covers="P14 M06", sql=f"""WITH {SQL_NESTED}
SELECT payload.id, replace(substr(fullkey, 3), '"', '') AS path, CASE WHEN json_extract_string(atom, '$') = '-1' THEN '0' ELSE json_extract_string(atom, '$') END AS value, json_extract_string(atom, '$') = '-1' AS has_timed_out
FROM payload, json_tree(payload.payload) AS j WHERE j.type NOT IN ('OBJECT', 'ARRAY')""")
def flatten_metrics(t):
    return ss.flatten_metrics(nested_payload(t), "id", "payload")


@query("payload_fields", covers="P14", sql=f"""WITH {SQL_NESTED}
SELECT id, CAST(json_extract(payload, '$.orders.count') AS BIGINT) AS orders, json_extract_string(payload, '$.seen[1]') AS last_priority, CAST(json_extract(payload, '$.deep.a.b.keys') AS BIGINT) AS deep_key, CAST(json_extract(payload, '$.missing') AS BIGINT) AS missing FROM payload""")
def payload_fields(t):
    v = nested_payload(t).select("id", F.parse_json("payload").alias("v"))
    g = lambda p, k: F.try_variant_get("v", p, k)
    return v.select("id", g("$.orders.count", "bigint").alias("orders"), g("$.seen[1]", "string").alias("last_priority"),
                    g("$.deep.a.b.keys", "bigint").alias("deep_key"), g("$.missing", "bigint").alias("missing"))


@query("document_words", covers="P15 J07 J08", sql="""SELECT lang, lower(w) AS word, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, lang, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1, 2""")
def document_words(t):
    # every word counts once, and once more per document as one of its distinct words; both are added up before the shuffle
    d = t.documents.select("lang", F.split(F.lower("text"), " ").alias("w"))
    every = ss.explode_list(d, F.col("w"), "word").select("lang", "word", F.lit(1).alias("n"), F.lit(0).alias("docs"))
    own = ss.explode_list(d, F.array_distinct("w"), "word").select("lang", "word", F.lit(0).alias("n"), F.lit(1).alias("docs"))
    return every.unionByName(own).groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


@query("explode_outer_lists", covers="P15 J08", sql="""SELECT conv_id, turn, word FROM (SELECT conv_id, turn, unnest(CASE WHEN len(list_filter(string_split(text, ' '), lambda x: len(x) > 12)) = 0 THEN [NULL] ELSE list_filter(string_split(text, ' '), lambda x: len(x) > 12) END) AS word FROM conversations)""")
def explode_outer_lists(t):
    long_words = F.filter(F.split("text", " "), lambda x: F.length(x) > 12)
    return ss.explode_list(t.conversations.select("conv_id", "turn", "text"), long_words, "word", outer=True).drop("text")


@query("document_lines", covers="M06 P15", sql="""SELECT doc_id, unnest(string_split(text, chr(10))) AS piece, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS index FROM documents""")
def document_lines(t):
    return ss.split_rows(t.documents.select("doc_id", "text"), "text", "\n").drop("text")


@query("parse_kv_blob", covers="P16 A26", sql="""SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus AS status, nullif(CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END, '') AS priority, CAST(o_orderdate AS DATE) AS created_at, o_orderkey % 2 = 0 AS trial FROM orders""")
def parse_kv_blob(t):
    line = lambda k, v: F.concat(F.lit(k + ": "), v)
    created = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("created_at: &1 x\nzone: utc\nkind: time\ntime: '"), i.day("o_orderdate").cast("string"), F.lit("'"))).otherwise(
        line("created_at", i.day("o_orderdate").cast("string")))
    blob = F.concat_ws("\n", F.lit("--- row"), line("customer_id", F.col("o_custkey").cast("string")), line("status", F.col("o_orderstatus")),
                       line("priority", F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.concat(F.lit("'"), F.col("o_orderpriority"), F.lit("'")))),
                       created, line("trial", (F.col("o_orderkey") % 2 == 0).cast("string")))
    return ss.parse_kv_blob(t.orders.select("o_orderkey", blob.alias("object")), ["o_orderkey"], "object",
                            {"customer_id": "bigint", "status": "string", "priority": "string", "created_at": "date", "trial": "boolean"}, ["created_at"])


@query("object_map", covers="M05 A18", sql="""SELECT user_id, CAST(count(*) FILTER (event_type = 'view') AS VARCHAR) AS views, 'u' || user_id AS name, 2 AS keys FROM events GROUP BY 1""")
def object_map(t):
    g = t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "view").alias("n"))
    blob = F.concat(F.lit('[{"key":"views","value":{"int_value":'), F.col("n").cast("string"), F.lit('}},{"key":"name","value":{"string_value":"u'), F.col("user_id").cast("string"), F.lit('","int_value":null}}]'))
    m = g.select("user_id", ss.object_array_to_map(blob).alias("m"))
    return m.select("user_id", F.col("m")["views"].alias("views"), F.col("m")["name"].alias("name"), F.size(F.map_keys("m")).alias("keys"))


@query("object_edit", covers="M05", sql="""SELECT c_custkey, c_mktsegment AS seg, 'x' AS extra, CAST(NULL AS VARCHAR) AS gone, 'extra,seg' AS keys FROM customer""")
def object_edit(t):
    m = F.create_map(F.lit("seg"), F.col("c_mktsegment"), F.lit("old"), F.col("c_name"))
    m = ss.object_insert(ss.object_delete(m, "old"), "extra", F.lit("x"))
    return t.customer.select("c_custkey", m["seg"].alias("seg"), m["extra"].alias("extra"), m["old"].alias("gone"), F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"))


@query("merge_duplicate_payloads", covers="P59b A29", sql="""WITH r AS (SELECT l_returnflag, l_linestatus, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_quantity AS qty, list_sort([CAST(l_linenumber % 3 AS INTEGER), CAST(l_quantity % 2 AS INTEGER)]) AS tags FROM lineitem)
SELECT l_returnflag, l_linestatus, month, array_to_string(tags, ',') AS tags, count(*) AS occurrence_multiplier, qty * count(*) AS qty FROM r GROUP BY l_returnflag, l_linestatus, month, r.tags, r.qty""")
def merge_duplicate_payloads(t):
    r = t.lineitem.select("l_returnflag", "l_linestatus", i.month("l_shipdate").alias("month"), F.col("l_quantity").alias("qty"),
                          F.array((F.col("l_quantity") % 2).cast("int"), F.col("l_linenumber") % 3).alias("tags"))
    m = ss.merge_duplicate_payloads(r, ["l_returnflag", "l_linestatus", "month"], ["tags"], ["qty"])
    return m.withColumn("tags", F.array_join("tags", ","))


@query("conversation_mentions", covers="P63a M05", sql="""SELECT conv_id, m AS mention, count(*) AS n FROM (SELECT conv_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{4,}')) AS m FROM conversations) GROUP BY 1, 2""")
def conversation_mentions(t):
    return tr.mentions(t.conversations, ["conv_id"], "text", "[A-Z][a-z]{4,}").groupBy("conv_id", "mention").agg(F.count("*").alias("n"))


@query("net_mentions", covers="P63a", sql="""WITH m AS (SELECT conv_id, turn, unnest(regexp_extract_all(text, '[A-Z][a-z]{3,}')) AS mention FROM conversations)
SELECT conv_id, mention FROM m WHERE turn % 2 = 0 EXCEPT SELECT conv_id, mention FROM m WHERE turn % 2 = 1""")
def net_mentions(t):
    m = tr.mentions(t.conversations, ["conv_id", "turn"], "text", "[A-Z][a-z]{3,}")
    return tr.net_mentions(m.where(F.col("turn") % 2 == 0), m.where(F.col("turn") % 2 == 1), ["conv_id", "mention"])


@query("url_parts", covers="P65 M05", sql="""SELECT page_id, nullif(regexp_extract(url, '^([a-zA-Z]+)://', 1), '') AS url_scheme, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_param, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref_param,
 regexp_replace(regexp_replace(lower(regexp_replace(url, '^[a-zA-Z]+://[^/?#]*|[?#].*$', '', 'g')), '/[0-9]+(/|$)', '/:id\\1', 'g'), '/+$', '') AS clean_path FROM pages""")
def url_parts(t):
    p = tr.url_parts(t.pages.select("page_id", "url"), "url")
    return p.select("page_id", "url_scheme", tr.url_parameter(F.col("url"), "page").alias("page_param"), tr.url_parameter(F.col("url"), "ref").alias("ref_param"), "clean_path")


@query("campaign_code_parts", covers="P65 M05", sql="""SELECT p_partkey, string_split(code, '_')[1] AS region, string_split(code, '_')[2] AS kind, string_split(code, '_')[3] AS topic, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g')) AS slug FROM (SELECT p_partkey, p_name, p_brand || '_' || p_type || '_' || p_size AS code FROM part)""")
def campaign_code_parts(t):
    code = F.concat_ws("_", "p_brand", "p_type", F.col("p_size").cast("string"))
    return t.part.select("p_partkey", *tr.campaign_parts(code, ["region", "kind", "topic"]), tr.slugify(F.col("p_name")).alias("slug"))


@query("classify_parts", covers="P61 F09 F10 F11", sql="""SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'promotion' WHEN p_name LIKE '%widget%' OR p_name LIKE '%gear%' THEN 'mechanical' WHEN regexp_matches(p_name, '^(red|blue) ') THEN 'colour' WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'house' ELSE 'other' END AS category FROM part""")
def classify_parts(t):
    return tr.classify(t.part, [("p_type", "eq", "PROMO", "promotion"), ("p_name", "like_any", ["%widget%", "%gear%"], "mechanical"),
                                ("p_name", "regex", "^(red|blue) ", "colour"), ("p_brand", "in", ["Brand#1", "Brand#2"], "house")], "other", "category").select("p_partkey", "category")


@query("classify_by_rule_table", covers="P61", sql="""WITH rules AS (SELECT word, row_number() OVER (ORDER BY word) AS priority, 'L' || len(word) AS label FROM (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS word FROM part) WHERE word <> '' AND word < 'r'),
w AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS word FROM part), b AS (SELECT p_partkey, arg_min(label, priority) AS label FROM w JOIN rules USING (word) GROUP BY 1)
SELECT part.p_partkey, coalesce(label, 'none') AS label FROM part LEFT JOIN b ON b.p_partkey = part.p_partkey""")
def classify_by_rule_table(t):
    words = t.part.select(F.explode(F.split(F.lower("p_name"), " ")).alias("word")).where((F.col("word") != "") & (F.col("word") < "r")).distinct()
    rules = words.select("word", F.col("word").alias("priority"), F.concat(F.lit("L"), F.length("word").cast("string")).alias("label"))
    return tr.classify_by_table(t.part.select("p_partkey", "p_name"), "p_partkey", "p_name", rules, "none", "label").select("p_partkey", "label")


@query("mask_customers", covers="P66", sql="""SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'masked' ELSE c_name END AS c_name, CASE WHEN c_acctbal < 0 THEN 'hidden' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def mask_customers(t):
    m = tr.mask_when(t.customer, {"c_name": (F.col("c_mktsegment") == "MACHINERY", "masked"), "c_mktsegment": (F.col("c_acctbal") < 0, "hidden")})
    return m.select("c_custkey", "c_name", "c_mktsegment")


@query("email_domain_types", covers="P64", sql="""SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'Bulk load' WHEN c_custkey % 4 = 0 THEN 'Missing' WHEN c_custkey % 4 IN (1, 2) THEN 'Personal' ELSE 'Business' END AS kind FROM customer""")
def email_domain_types(t):
    domain = F.element_at(F.array(F.lit(""), F.lit("gmail.com"), F.lit(" Web.de"), F.lit("acme.io")), (F.col("c_custkey") % 4 + 1).cast("int"))
    source = F.when(F.col("c_nationkey") % 5 == 0, "list import").otherwise("web")
    return t.customer.select("c_custkey", tr.email_domain_type(domain, source, ["list import"]).alias("kind"))


@query("find_definition", covers="P99", sql="""SELECT doc_id, CAST(line_number AS INTEGER) AS line_number, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_number FROM documents) WHERE regexp_matches(line, '[Tt]he [a-z]+ing')""")
def find_definition(t):
    return tr.find_definition(t.documents, "doc_id", "text", "[Tt]he [a-z]+ing")
