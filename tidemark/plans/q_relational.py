"""Projections, joins, aggregates, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import scalars as s
from tidemark.operators import ordered
from tidemark.plans import inputs as i
from tidemark.plans.registry import query

r2 = lambda x: F.round(x, 2)
r6 = lambda x: F.round(x, 6)


def views(t, *names):
    for n in names:
        getattr(t, n).createOrReplaceTempView(f"tm_{n}")


# --- projections and predicates -----------------------------------------------------------------

@query("alias_reuse", covers="F01 F02 F05", sql="SELECT * FROM (SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem) WHERE gross > 50000")
def alias_reuse(t):
    views(t, "lineitem")
    return t.spark.sql("SELECT * FROM (SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, net * (1 + l_tax) AS gross FROM tm_lineitem) WHERE gross > 50000")


@query("exclude_columns", covers="F03 F04", sql="SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def exclude_columns(t):
    return t.customer.drop("c_acctbal", "c_name")


@query("predicates", covers="F08 F09 F10 F12", sql="""SELECT p_partkey, p_size BETWEEN 10 AND 20 AS mid, p_type IN ('PROMO', 'SMALL') AS kind, p_name ILIKE '%RED%' AS red, p_name LIKE '%bolt' OR p_name LIKE 'small%' AS any_like, p_name NOT LIKE '%widget%' AS no_widget,
 nullif(p_size, 7) IS DISTINCT FROM nullif(p_size, 8) AS differs, p_size BETWEEN 10 AND 20 AND p_size <> 15 AS edge FROM part""")
def predicates(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", F.col("p_size").between(10, 20).alias("mid"), F.col("p_type").isin("PROMO", "SMALL").alias("kind"), n.ilike("%RED%").alias("red"),
                         (n.like("%bolt") | n.like("small%")).alias("any_like"), (~n.like("%widget%")).alias("no_widget"),
                         (~F.nullif("p_size", F.lit(7)).eqNullSafe(F.nullif("p_size", F.lit(8)))).alias("differs"), (F.col("p_size").between(10, 20) & (F.col("p_size") != 15)).alias("edge"))


@query("like_any_sql", covers="F10", sql="SELECT p_partkey FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%gear'")
def like_any_sql(t):
    views(t, "part")
    return t.spark.sql("SELECT p_partkey FROM tm_part WHERE p_name LIKE ANY ('red%', '%gear')")


@query("full_string_regex", covers="F11", sql="SELECT p_partkey, regexp_full_match(p_name, '[a-z]+ bolt') AS is_bolt, regexp_full_match(upper(p_name), '(?i)red [a-z]+') AS is_red FROM part")
def full_string_regex(t):
    return t.part.select("p_partkey", s.regexp_full("p_name", "[a-z]+ bolt").alias("is_bolt"), s.regexp_full(F.upper("p_name"), "red [a-z]+", "i").alias("is_red"))


@query("exists_in_case", covers="F13 J17", sql="SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000) THEN 'big' ELSE 'small' END AS kind FROM customer")
def exists_in_case(t):
    big = t.orders.where(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit("big"))
    return t.customer.select("c_custkey").join(big, "c_custkey", "left").select("c_custkey", F.coalesce("hit", F.lit("small")).alias("kind"))


@query("semi_join", covers="F14 J17", sql="SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def semi_join(t):
    return t.orders.join(t.customer.where(F.col("c_acctbal") > 5000), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")


@query("not_in_null_aware", covers="F15 J18", sql="SELECT p_partkey FROM part WHERE p_size NOT IN (SELECT p_size FROM part WHERE p_type = 'PROMO' AND p_size % 2 = 0)")
def not_in_null_aware(t):
    """NULLs are taken out on purpose: an anti join keeps what NOT IN over non-null keys keeps."""
    drop = t.part.where((F.col("p_type") == "PROMO") & (F.col("p_size") % 2 == 0) & F.col("p_size").isNotNull()).select("p_size").distinct()
    return t.part.where(F.col("p_size").isNotNull()).join(drop, "p_size", "left_anti").select("p_partkey")


@query("scalar_subquery", covers="F16 O02", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def scalar_subquery(t):
    last = t.orders.agg(F.max("o_orderdate").alias("m")).scalar()
    return t.orders.where(F.col("o_orderdate") == last).select("o_orderkey", "o_totalprice")


@query("having", covers="F17 A03", sql="SELECT o_custkey, count(*) AS orders, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS finished FROM orders GROUP BY 1 HAVING count(*) > 10")
def having(t):
    g = t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("finished"))
    return g.where(F.col("orders") > 10)


# --- joins ----------------------------------------------------------------------------------------

@query("left_join_chain", covers="S02 S03 J01 J06", sql="SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def left_join_chain(t):
    c = t.customer.where(F.col("c_acctbal") > 0)
    return (t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("o_orderkey", "c_name", "n_name", "r_name"))


@query("composite_key_join", covers="J02", sql="WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1, 2), b AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS m FROM events WHERE event_type = 'click' GROUP BY 1, 2) SELECT user_id, day, n, m FROM a JOIN b USING (user_id, day)")
def composite_key_join(t):
    g = lambda k, n: t.events.where(F.col("event_type") == k).groupBy("user_id", i.day("ts").alias("day")).agg(F.count("*").alias(n))
    return g("view", "n").join(g("click", "m"), ["user_id", "day"])


@query("right_join", covers="J04", sql="SELECT n_name, count(s_suppkey) AS suppliers FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY 1")
def right_join(t):
    sup = t.supplier.where(F.col("s_acctbal") > 5000).groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
    return sup.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right").select("n_name", F.coalesce("suppliers", F.lit(0).cast("long")).alias("suppliers"))


@query("one_row_parameters", covers="J05", sql="SELECT o_orderkey, o_totalprice > p.limit_price AS above FROM orders CROSS JOIN (SELECT avg(o_totalprice) AS limit_price FROM orders) p")
def one_row_parameters(t):
    limit = t.orders.agg(F.avg("o_totalprice").alias("p")).scalar()
    return t.orders.select("o_orderkey", (F.col("o_totalprice") > limit).alias("above"))


@query("anti_join_unmatched", covers="J18", sql="SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-06-01') o ON o_custkey = c_custkey WHERE o_custkey IS NULL")
def anti_join_unmatched(t):
    recent = t.orders.where(F.col("o_orderdate") >= F.expr("timestamp_ntz'2001-06-01'"))
    return t.customer.join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("null_safe_join", covers="J19 F12", sql="WITH a AS (SELECT nullif(p_size % 5, 0) AS k, count(*) AS n FROM part GROUP BY 1), b AS (SELECT nullif(CAST(s_nationkey % 5 AS INTEGER), 0) AS k, count(*) AS m FROM supplier GROUP BY 1) SELECT a.k, n, m FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k")
def null_safe_join(t):
    a = t.part.groupBy(F.nullif(F.col("p_size") % 5, F.lit(0)).alias("k")).agg(F.count("*").alias("n"))
    b = t.supplier.groupBy(F.nullif(F.col("s_nationkey") % 5, F.lit(0)).alias("k2")).agg(F.count("*").alias("m"))
    return a.join(b, F.col("k").eqNullSafe(F.col("k2"))).select("k", "n", "m")


@query("conditional_lookup", covers="J20 J23", sql="SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN c_name ELSE 'open ' || c_mktsegment END AS label FROM orders JOIN customer ON o_custkey = c_custkey")
def conditional_lookup(t):
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("c_name")).otherwise(F.concat(F.lit("open "), F.col("c_mktsegment"))).alias("label"))


@query("either_key_join", covers="J23", sql="SELECT DISTINCT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey OR s_suppkey % 25 = n_nationkey")
def either_key_join(t):
    """An OR between two keys as the distinct union of two equi-joins."""
    a = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    b = t.supplier.join(t.nation, F.col("s_suppkey") % 25 == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return a.union(b).distinct()


@query("cumulative_members", covers="J15", sql="WITH f AS (SELECT o_custkey, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS month FROM orders GROUP BY 1), g AS (SELECT month, count(*) AS joined FROM f GROUP BY 1) SELECT month, joined, CAST(sum(joined) OVER (ORDER BY month) AS BIGINT) AS members FROM g")
def cumulative_members(t):
    """Membership so far as a running sum over months, not a join of every month with all earlier ones."""
    g = t.orders.groupBy("o_custkey").agg(F.trunc(F.min("o_orderdate"), "month").alias("month")).groupBy("month").agg(F.count("*").alias("joined"))
    return g.withColumn("members", F.sum("joined").over(W.orderBy("month").rowsBetween(W.unboundedPreceding, 0)))


# --- aggregates -----------------------------------------------------------------------------------

@query("pricing_summary", covers="A01 A06 A09", sql="""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 6) AS sum_charge,
 round(avg(l_quantity), 6) AS avg_qty, round(avg(l_discount), 6) AS avg_disc, count(*) AS lines FROM lineitem WHERE l_shipdate <= DATE '2001-09-02' GROUP BY 1, 2""")
def pricing_summary(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.where(F.col("l_shipdate") <= F.expr("timestamp_ntz'2001-09-02'")).groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), r2(F.sum("l_extendedprice")).alias("sum_base"), F.round(F.sum(net), 4).alias("sum_disc"),
        r6(F.sum(net * (1 + F.col("l_tax")))).alias("sum_charge"), r6(F.avg("l_quantity")).alias("avg_qty"), r6(F.avg("l_discount")).alias("avg_disc"), F.count("*").alias("lines"))


@query("group_by_all", covers="A02", sql="SELECT p_brand, p_type, count(*) AS parts, max(p_size) AS largest FROM part GROUP BY ALL")
def group_by_all(t):
    views(t, "part")
    return t.spark.sql("SELECT p_brand, p_type, count(*) AS parts, max(p_size) AS largest FROM tm_part GROUP BY ALL")


@query("distinct_counts", covers="A04 A05", sql="SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT CASE WHEN value > 10 THEN user_id END) AS big_users FROM events GROUP BY 1")
def distinct_counts(t):
    return t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct(i.day("ts")).alias("days"),
                                              F.countDistinct(F.when(F.col("value") > 10, F.col("user_id"))).alias("big_users"))


@query("approximate_aggregates", covers="A12 A13", sql="SELECT l_returnflag, true AS p90_is_near, true AS orders_is_near FROM lineitem GROUP BY 1")
def approximate_aggregates(t):
    """Approximate percentile and distinct count beside the exact ones: the estimate's rank is off by 0.1 % at most, the count by 15 %."""
    # beside a distinct count, both sketches would be kept for every single order
    near = t.lineitem.groupBy("l_returnflag").agg(F.percentile_approx("l_extendedprice", 0.9).alias("p90"), F.approx_count_distinct("l_orderkey").alias("orders"))
    near = near.join(t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("exact")), "l_returnflag")
    # a row per flag: sent to the lines, which would else meet in a task per flag
    rank = t.lineitem.join(F.broadcast(near), "l_returnflag").groupBy("l_returnflag", "orders", "exact").agg(
        F.avg((F.col("l_extendedprice") < F.col("p90")).cast("double")).alias("below"), F.avg((F.col("l_extendedprice") <= F.col("p90")).cast("double")).alias("upto"))
    return rank.select("l_returnflag", ((F.col("below") <= 0.901) & (F.col("upto") >= 0.899)).alias("p90_is_near"), (F.abs(F.col("orders") - F.col("exact")) <= 0.15 * F.col("exact")).alias("orders_is_near"))


@query("ordered_lists", covers="A15 A16 A17", sql="""SELECT c_mktsegment, array_to_string(list_sort(list(DISTINCT n_name)), ',') AS nations, len(list(DISTINCT n_name)) AS n, string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS listed FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def ordered_lists(t):
    """Lists of distinct values of a dimension of fixed size."""
    d = t.customer.select("c_mktsegment", "c_nationkey").distinct().join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    names = F.array_sort(F.collect_set("n_name"))
    return d.groupBy("c_mktsegment").agg(F.array_join(names, ",").alias("nations"), F.size(names).alias("n"), F.array_join(names, "|").alias("listed"))


@query("object_aggregate", covers="A18", sql="SELECT user_id, CAST(count(*) FILTER (event_type = 'view') AS VARCHAR) AS view_count, CAST(count(DISTINCT event_type) AS INTEGER) AS keys FROM events GROUP BY 1")
def object_aggregate(t):
    g = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    m = g.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", F.col("n").cast("string").alias("n")))).alias("m"))
    return m.select("user_id", F.coalesce(F.col("m")["view"], F.lit("0")).alias("view_count"), F.size("m").alias("keys"))


@query("boolean_aggregates", covers="A19 A20 A21", sql="SELECT o_custkey, bool_and(o_totalprice > 1000) AS all_big, bool_or(o_orderstatus = 'P') AS any_partial, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1")
def boolean_aggregates(t):
    return t.orders.groupBy("o_custkey").agg(F.bool_and(F.col("o_totalprice") > 1000).alias("all_big"), F.bool_or(F.col("o_orderstatus") == "P").alias("any_partial"),
                                             F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))


@query("spread", covers="A14 A07", sql="SELECT c_mktsegment, round(stddev_samp(c_acctbal), 4) AS sd, min(c_name) AS first_name, max(c_acctbal) AS top FROM customer GROUP BY 1")
def spread(t):
    return t.customer.groupBy("c_mktsegment").agg(F.round(F.stddev_samp("c_acctbal"), 4).alias("sd"), F.min("c_name").alias("first_name"), F.max("c_acctbal").alias("top"))


@query("pivot_status", covers="A24 A26", sql="SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f_orders, count(*) FILTER (o_orderstatus = 'O') AS o_orders, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS f_amount, round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS o_amount FROM orders GROUP BY 1")
def pivot_status(t):
    p = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O"]).agg(F.count(F.lit(1)).alias("orders"), r2(F.sum("o_totalprice")).alias("amount"))
    return p.select("o_orderpriority", *[F.col(f"{k}_{m}").alias(f"{k.lower()}_{m}") for k in "FO" for m in ("orders", "amount")])


@query("unpivot_sizes", covers="A27", sql="SELECT p_partkey, 'size' AS k, CAST(p_size AS DOUBLE) AS v FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part")
def unpivot_sizes(t):
    return t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")).unpivot("p_partkey", ["size", "price"], "k", "v")


# --- windows: over (customer, month) rows, at most one per calendar month -------------------------------

SQL_CM = "cm AS (SELECT o_custkey AS c, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2)"


def customer_months(t):
    return t.orders.groupBy(F.col("o_custkey").alias("c"), i.month("o_orderdate").alias("m")).agg(F.count("*").alias("n"), r2(F.sum("o_totalprice")).alias("v"))


@query("window_ranks", covers="W01 W02 W03 W20", sql=f"WITH {SQL_CM} SELECT c, m, row_number() OVER (PARTITION BY c ORDER BY v DESC, m) AS rn, rank() OVER (PARTITION BY c ORDER BY n DESC) AS rk, dense_rank() OVER (PARTITION BY c ORDER BY n DESC) AS dr, row_number() OVER (PARTITION BY c ORDER BY CASE WHEN n > 1 THEN m END ASC NULLS LAST, m) AS busy FROM cm")
def window_ranks(t):
    w = W.partitionBy("c")
    by_n = w.orderBy(F.col("n").desc())
    return customer_months(t).select("c", "m", F.row_number().over(w.orderBy(F.col("v").desc(), "m")).cast("long").alias("rn"), F.rank().over(by_n).cast("long").alias("rk"),
                                     F.dense_rank().over(by_n).cast("long").alias("dr"),
                                     F.row_number().over(w.orderBy(F.when(F.col("n") > 1, F.col("m")).asc_nulls_last(), "m")).cast("long").alias("busy"))


@query("window_offsets", covers="W05 W06", sql=f"WITH {SQL_CM} SELECT c, m, lag(n, 2, 0) OVER w AS two_back, lead(v) OVER w AS next_v, lag(nullif(n, 1) IGNORE NULLS) OVER w AS last_busy, coalesce(min(v) OVER (PARTITION BY c ORDER BY m ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) < v, false) AS falls_later FROM cm WINDOW w AS (PARTITION BY c ORDER BY m)")
def window_offsets(t):
    w = W.partitionBy("c").orderBy("m")
    busy = F.last(F.nullif("n", F.lit(1)), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    return customer_months(t).select("c", "m", F.lag("n", 2, 0).over(w).alias("two_back"), F.lead("v").over(w).alias("next_v"), busy.alias("last_busy"),
                                     F.coalesce(F.min("v").over(w.rowsBetween(1, 14)) < F.col("v"), F.lit(False)).alias("falls_later"))


@query("window_values", covers="W07 W08 W09 W18", sql=f"WITH {SQL_CM} SELECT c, m, first_value(v) OVER w AS first_v, last_value(v) OVER w AS last_v, nth_value(v, 2) OVER w AS second_v, first_value(nullif(n, 1) IGNORE NULLS) OVER w AS first_busy, bool_or(n > 2) OVER (PARTITION BY c) AS any_busy FROM cm WINDOW w AS (PARTITION BY c ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
def window_values(t):
    w = W.partitionBy("c").orderBy("m").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return customer_months(t).select("c", "m", F.first("v").over(w).alias("first_v"), F.last("v").over(w).alias("last_v"), F.nth_value("v", 2).over(w).alias("second_v"),
                                     F.first(F.nullif("n", F.lit(1)), ignorenulls=True).over(w).alias("first_busy"), F.bool_or(F.col("n") > 2).over(W.partitionBy("c")).alias("any_busy"))


@query("window_frames", covers="W10 W11 W12 W13 W15", sql=f"WITH {SQL_CM} SELECT c, m, round(sum(v) OVER (PARTITION BY c ORDER BY m ROWS UNBOUNDED PRECEDING), 2) AS so_far, round(sum(v) OVER (PARTITION BY c ORDER BY m ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 2) AS trailing, round(sum(v) OVER (PARTITION BY c), 2) AS total, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY m) AS BIGINT) AS busy_no FROM cm")
def window_frames(t):
    w = W.partitionBy("c").orderBy("m")
    run = w.rowsBetween(W.unboundedPreceding, 0)
    return customer_months(t).select("c", "m", r2(F.sum("v").over(run)).alias("so_far"), r2(F.sum("v").over(w.rowsBetween(-11, 0))).alias("trailing"),
                                     r2(F.sum("v").over(W.partitionBy("c"))).alias("total"), F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).over(run).alias("busy_no"))


@query("window_over_aggregate", covers="W14 W17", sql="SELECT c_mktsegment, c_nationkey, round(sum(c_acctbal), 2) AS balance, round(sum(c_acctbal) / nullif(sum(sum(c_acctbal)) OVER (PARTITION BY c_mktsegment), 0), 6) AS share FROM customer GROUP BY 1, 2")
def window_over_aggregate(t):
    g = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.sum("c_acctbal").alias("b"))
    return g.select("c_mktsegment", "c_nationkey", r2("b").alias("balance"), r6(s.ratio("b", F.sum("b").over(W.partitionBy("c_mktsegment")))).alias("share"))


@query("distinct_over_partition", covers="W16", sql="SELECT o_orderkey, d.days FROM orders JOIN (SELECT o_custkey, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY 1) d ON d.o_custkey = orders.o_custkey")
def distinct_over_partition(t):
    o = t.orders.select("o_orderkey", "o_custkey", i.day("o_orderdate").alias("d"))
    return ordered.with_totals(o, ["o_custkey"], {"days": F.countDistinct("d")}).select("o_orderkey", "days")


@query("global_rank", covers="W19 O06", sql="SELECT o_orderkey, CAST(rank() OVER (ORDER BY o_totalprice) AS BIGINT) AS price_rank FROM orders")
def global_rank(t):
    """Rank over the whole table through value bins instead of one sorted task."""
    o = t.orders.select("o_orderkey", "o_totalprice")
    ranks = ordered.with_cumulative_count(o, [], "o_totalprice").select("o_totalprice", (F.col("__below") + 1).alias("price_rank"))
    return o.join(ranks, "o_totalprice").select("o_orderkey", "price_rank")


# --- ordering and sets ----------------------------------------------------------------------------

@query("top_orders", covers="O01 O05", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_orders(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(50)


@query("top_per_group", covers="O03 O04", sql="SELECT c_mktsegment, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) <= 5")
def top_per_group(t):
    from tidemark.operators.keys import latest_per_key
    return latest_per_key(t.customer, ["c_mktsegment"], [F.col("c_acctbal").desc(), F.col("c_custkey")], 5).select("c_mktsegment", "c_custkey", "c_acctbal")


@query("null_ordering", covers="O06", sql="""SELECT p_partkey, 'low' AS side FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY nullif(p_size, 7) ASC NULLS LAST, p_partkey) <= 3
UNION ALL SELECT p_partkey, 'high' FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY nullif(p_size, 7) DESC NULLS FIRST, p_partkey) <= 3""")
def null_ordering(t):
    """NULLs count as the largest value, unlike Spark's default."""
    from tidemark.operators.keys import latest_per_key
    k = F.nullif("p_size", F.lit(7))
    low = latest_per_key(t.part, ["p_brand"], [k.asc_nulls_last(), F.col("p_partkey")], 3).select("p_partkey", F.lit("low").alias("side"))
    high = latest_per_key(t.part, ["p_brand"], [k.desc_nulls_first(), F.col("p_partkey")], 3).select("p_partkey", F.lit("high").alias("side"))
    return low.unionByName(high)


@query("set_operations", covers="U01 U02 U06", sql="""SELECT 'all' AS op, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) UNION ALL SELECT 'distinct', count(*) FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 400000) UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def set_operations(t):
    a, b = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    c, o = t.customer.select("c_custkey"), t.orders.where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    n = lambda d, op: d.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
    return n(a.union(b), "all").union(n(a.union(b).distinct(), "distinct")).union(n(c.intersect(o), "intersect")).union(n(c.subtract(o), "except"))
