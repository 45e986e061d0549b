"""The given/expect cases of the event preparation steps."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.scalars import regexp_full
from tidemark.operators import semistructured as ss
from tidemark.operators import text_rules as tr
from tidemark.streaming import incremental as inc

A, B, C, D = (f"{n}23e4567-e89b-12d3-a456-426614174000" for n in "1234")
ID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def ts(hh, mm):
    return dt.datetime(2023, 5, 2, hh, mm)


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, uploaded_at timestamp_ntz, derived timestamp_ntz, app_id string")


def counts(df):
    ok = regexp_full("event_id", ID) & F.col("app_id").isNotNull() & F.col("derived").isNotNull()
    return inc.event_counts(df, "event_id", "uploaded_at", ok)


def test_last_upload_time(spark):
    df = events(spark, [(A, ts(12, 0), ts(11, 0), "web"), (A, ts(12, 30), ts(11, 0), "web"), (B, ts(13, 0), ts(11, 0), "web")])
    got = {tuple(r) for r in counts(df).collect()}
    assert got == {(A, 2, ts(12, 30)), (B, 1, ts(13, 0))}


def test_event_filtering(spark):
    df = events(spark, [("bad", ts(12, 0), ts(11, 0), "web"), (A, ts(12, 30), ts(11, 0), "web"), (B, ts(12, 0), ts(11, 0), None),
                        (C, ts(12, 0), None, "web"), (A, ts(13, 15), ts(11, 0), "web")])
    assert [tuple(r) for r in counts(df).collect()] == [(A, 2, ts(13, 15))]


def test_duplicate_filter(spark):
    df = events(spark, [(A, ts(12, 0), ts(11, 0), "web"), (A, ts(12, 30), ts(11, 0), "web"), (B, ts(13, 0), ts(11, 0), "web"),
                        (C, ts(13, 5), ts(11, 0), "web"), (C, ts(14, 35), ts(11, 0), "web")])
    known = spark.createDataFrame([(A, 2, ts(12, 30)), (B, 1, ts(13, 0)), (C, 1, ts(13, 5))], "event_id string, event_count long, last_loaded_at timestamp_ntz")
    got = inc.only_once(df, known, "event_id", "uploaded_at").select("event_id", "uploaded_at").collect()
    assert sorted(tuple(r) for r in got) == [(B, ts(13, 0)), (C, ts(13, 5))]


def test_staging_flag(spark):
    df = spark.createDataFrame([(1, "shop", "https://www.shop.io/a"), (2, "shop-staging", "https://www.shop.io/a"), (3, "shop", "https://staging.shop.io/a")], "id int, app_id string, url string")
    rules = [("app_id", "like", "%-staging", "true"), ("url", "regex", "^https?://staging\\.", "true")]
    got = {r.id: r.staging for r in tr.classify(df, rules, "false", "staging").collect()}
    assert got == {1: "false", 2: "true", 3: "true"}


def test_tracker_filter(spark):
    df = spark.createDataFrame([("js-1",), ("rb-2",), ("py-3",), ("java-4",), ("other-5",)], "v_tracker string")
    kept = df.where(tr.rule_condition("like_any", F.col("v_tracker"), ["js-%", "rb-%", "py-%", "java-%"]))
    assert kept.count() == 4


def test_url_parameter(spark):
    df = spark.createDataFrame([("https://a.b/c?glm_source=test1",), ("https://a.b/c?param1=value1&glm_source=test2&param2=value2",), ("https://a.b/c?x=1",)], "u string")
    assert [r[0] for r in df.select(tr.url_parameter(F.col("u"), "glm_source")).collect()] == ["test1", "test2", None]


def test_page_id_dedup(spark):
    df = events(spark, [(A, ts(12, 0), ts(11, 0), "w"), (B, ts(12, 0), ts(11, 0), "w"), (C, ts(12, 0), ts(11, 0), "w"), (C, ts(12, 0), ts(11, 0), "w"), (D, ts(12, 0), ts(11, 0), "w")])
    pages = spark.createDataFrame([(A, "p1"), (B, "p2"), (C, "p3"), (C, "p3"), (D, None)], "event_id string, page string")
    single = inc.only_once(df, counts(df), "event_id")
    joined = single.join(pages.distinct(), "event_id", "left").where(F.col("page").isNotNull() | (F.col("event_id") == D))
    assert sorted(r.event_id for r in joined.collect()) == [A, B, D]


CONTEXT = ('{"data":[{"schema":"shop/standard/jsonschema/1-0-0","data":{"namespace_id":"1","project_id":2,"user_id":"user123","is_staff":"true"}},'
           '{"schema":"shop/editor/jsonschema/2-1-0","data":{"prefix_length":"15","suffix_length":7,"model":"m","cached":false}}]}')


def test_context_flatten_and_types(spark):
    df = spark.createDataFrame([(A, CONTEXT), (B, '{"data":[{"schema":"shop/other/jsonschema/1-0-0","data":{}}]}')], "event_id string, contexts string")
    out = ss.unpack_context(df, "contexts", "shop/standard/%", {"namespace_id": "bigint", "project_id": "bigint", "user_id": "string", "is_staff": "boolean"})
    out = ss.unpack_context(out, "contexts", "shop/editor/jsonschema/%", {"prefix_length": "int", "suffix_length": "int", "model": "string", "cached": "boolean"}, "ed_")
    assert dict(out.dtypes)["is_staff"] == "boolean" and dict(out.dtypes)["ed_prefix_length"] == "int"
    rows = {r.event_id: r for r in out.drop("contexts").collect()}
    assert tuple(rows[A]) == (A, 1, 2, "user123", True, 15, 7, "m", False)
    assert tuple(rows[B]) == (B,) + (None,) * 8


def test_context_dedup(spark):
    df = spark.createDataFrame([(A, dt.datetime(2023, 5, 2, 11, 5), CONTEXT), (A, dt.datetime(2023, 5, 2, 12, 10), CONTEXT)], "event_id string, uploaded_at timestamp_ntz, contexts string")
    known = spark.createDataFrame([(A, 1, dt.datetime(2023, 5, 2, 11, 5))], "event_id string, event_count long, last_loaded_at timestamp_ntz")
    out = ss.unpack_context(inc.only_once(df, known, "event_id", "uploaded_at"), "contexts", "shop/standard/%", {"namespace_id": "bigint", "project_id": "bigint", "user_id": "string"})
    assert [tuple(r)[-3:] for r in out.collect()] == [(1, 2, "user123")]
