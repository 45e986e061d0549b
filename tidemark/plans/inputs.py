"""Inputs that the queries derive from the tables, each once for Spark and once as a SQL common table expression."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators import ordered
from tidemark.plans.registry import Tables
from tidemark.session import dealt

ORDERS_AS_OF = dt.date(2001, 12, 31)
EVENTS_AS_OF = dt.date(2024, 1, 31)



def day(x: str):
    return F.col(x).cast("date")


def month(x: str):
    return F.trunc(F.col(x).cast("date"), "month")


# --- revenue ------------------------------------------------------------------------------

SQL_ACCOUNT_MONTH = """account_month AS (
  SELECT o_custkey AS account_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS amount,
         max(CAST(substr(p_brand, 7) AS INTEGER) % 3) + 1 AS tier
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2)"""


def account_month(t: Tables) -> DataFrame:
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    return j.groupBy(F.col("o_custkey").alias("account_id"), month("o_orderdate").alias("month")).agg(
        F.sum("l_quantity").alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("amount"),
        (F.max(F.substring("p_brand", 7, 9).cast("int") % 3) + 1).alias("tier"),
    )


SQL_ACCOUNT_DENSE = """account_span AS (
  SELECT account_id, min(month) AS a, max(month) AS b FROM account_month GROUP BY 1),
account_dense AS (
  SELECT s.account_id, s.month, coalesce(m.quantity, 0) AS quantity, coalesce(m.amount, 0) AS amount,
         coalesce(m.tier, 0) AS tier
  FROM (SELECT account_id, CAST(unnest(generate_series(a, CAST(b + INTERVAL 1 MONTH AS DATE), INTERVAL 1 MONTH)) AS DATE) AS month
        FROM account_span) s
  LEFT JOIN account_month m ON m.account_id = s.account_id AND m.month = s.month)"""


SQL_CHARGE = """charge AS (
  SELECT l_orderkey AS order_id, o_custkey AS account_id, l_partkey AS part_id, l_quantity AS quantity,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS start_date,
         CAST(date_trunc('month', l_shipdate) + INTERVAL 12 MONTH AS DATE) AS end_date,
         l_extendedprice / 12 AS mrr, l_extendedprice AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def order_lines(t: Tables) -> DataFrame:
    """Lines with their order, dealt by the order."""
    return dealt(t.lineitem, "l_orderkey").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def charge(t: Tables) -> DataFrame:
    start = month("l_shipdate")
    return order_lines(t).select(
        F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("account_id"), F.col("l_partkey").alias("part_id"),
        F.col("l_quantity").alias("quantity"), start.alias("start_date"), F.add_months(start, 12).alias("end_date"),
        (F.col("l_extendedprice") / 12).alias("mrr"), F.col("l_extendedprice").alias("amount"),
    )


# --- effective-dated history ----------------------------------------------------------------

SQL_PLAN_HISTORY = """plan_history AS (
  SELECT key, value, valid_from, lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from) AS valid_to
  FROM (SELECT o_custkey AS key, CAST(o_orderdate AS DATE) AS valid_from, arg_min(o_orderpriority, o_orderkey) AS value
        FROM orders GROUP BY 1, 2) d)"""


def plan_history(t: Tables) -> DataFrame:
    """Order priority of a customer as an attribute with validity [valid_from, valid_to); one winner per day.

    At (customer, day) grain the rows of a key are bounded by the calendar.
    """
    days = t.orders.groupBy(F.col("o_custkey").alias("key"), day("o_orderdate").alias("valid_from")).agg(
        F.min_by("o_orderpriority", "o_orderkey").alias("value")
    )
    w = W.partitionBy("key").orderBy("valid_from")
    return days.select("key", "value", "valid_from", F.lead("valid_from").over(w).alias("valid_to"))


# --- graphs ---------------------------------------------------------------------------------

SQL_ORDER_EDGES = """order_edges AS (
  SELECT o_orderkey AS id, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS parent_id,
         o_orderdate AS starts
  FROM orders)"""


def order_edges(t: Tables) -> DataFrame:
    """Order and the order of the same customer it follows."""
    prev = ordered.with_previous(
        t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], None, {"parent_id": "o_orderkey"}
    )
    return prev.select(F.col("o_orderkey").alias("id"), "parent_id", F.col("o_orderdate").alias("starts"))


SQL_GEO_TREE = """geo_tree AS (
  SELECT r_regionkey + 1000000000 AS id, CAST(NULL AS BIGINT) AS parent_id, r_name AS name FROM region
  UNION ALL SELECT n_nationkey + 2000000000, n_regionkey + 1000000000, n_name FROM nation
  UNION ALL SELECT c_custkey, c_nationkey + 2000000000, c_name FROM customer)"""

REGION_OFFSET, NATION_OFFSET = 1_000_000_000, 2_000_000_000


def geo_tree(t: Tables) -> DataFrame:
    r = t.region.select((F.col("r_regionkey") + F.lit(REGION_OFFSET).cast("long")).alias("id"),
                        F.lit(None).cast("long").alias("parent_id"), F.col("r_name").alias("name"))
    n = t.nation.select((F.col("n_nationkey") + F.lit(NATION_OFFSET).cast("long")).alias("id"),
                        (F.col("n_regionkey") + F.lit(REGION_OFFSET).cast("long")).alias("parent_id"),
                        F.col("n_name").alias("name"))
    k = t.customer.select(F.col("c_custkey").alias("id"),
                          (F.col("c_nationkey") + F.lit(NATION_OFFSET).cast("long")).alias("parent_id"),
                          F.col("c_name").alias("name"))
    return r.unionByName(n).unionByName(k)


# --- invoices -------------------------------------------------------------------------------

SQL_INVOICES = """invoices AS (
  SELECT o_orderkey AS invoice_id, o_custkey AS account_id, CAST(o_orderdate AS DATE) AS invoice_date,
         CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due_date, o_totalprice AS amount,
         CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN floor(o_totalprice / 2) ELSE o_totalprice END AS balance
  FROM orders),
payments AS (
  SELECT invoice_id, account_id, invoice_date, CAST(invoice_date + to_days(CAST(invoice_id % 60 AS INTEGER)) AS DATE) AS payment_date,
         round(amount - balance, 2) AS amount,
         CASE invoice_id % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'wire' WHEN 2 THEN 'check' ELSE 'external' END AS payment_type
  FROM invoices WHERE amount > balance)"""


def invoices(t: Tables) -> DataFrame:
    d = day("o_orderdate")
    total = F.col("o_totalprice")
    return t.orders.select(
        F.col("o_orderkey").alias("invoice_id"), F.col("o_custkey").alias("account_id"), d.alias("invoice_date"),
        F.date_add(d, 30).alias("due_date"), total.alias("amount"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0.0)).when(F.col("o_orderstatus") == "P", F.floor(total / 2).cast("double"))
        .otherwise(total).alias("balance"),
    )


def payments(t: Tables) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(x) for x in ("card", "wire", "check", "external")]),
                        (F.col("invoice_id") % 4 + 1).cast("int"))
    return invoices(t).where(F.col("amount") > F.col("balance")).select(
        "invoice_id", "account_id", "invoice_date",
        F.date_add("invoice_date", (F.col("invoice_id") % 60).cast("int")).alias("payment_date"),
        F.round(F.col("amount") - F.col("balance"), 2).alias("amount"), kind.alias("payment_type"),
    )


# --- events ---------------------------------------------------------------------------------

SQL_SESSIONED = """gapped AS (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events),
sessioned AS (
  SELECT *, CAST(sum(CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_index FROM gapped)"""


def sessioned(t: Tables, minutes: int = 30) -> DataFrame:
    from tidemark.operators.usage import sessionize

    return sessionize(t.events, "user_id", "ts", "event_id", minutes)


# Customers stand in for the people behind user ids: a user is the customer of the same number.
SQL_STAGE_DATES = """stage_history AS (
  SELECT user_id AS item_id, event_type AS stage, CAST(min(ts) AS DATE) AS stage_date, min(ts) AS stage_ts
  FROM events GROUP BY 1, 2)"""


def stage_history(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("user_id").alias("item_id"), F.col("event_type").alias("stage")).agg(
        F.min("ts").cast("date").alias("stage_date"), F.min("ts").alias("stage_ts")
    )


def one_day():
    return F.expr("INTERVAL 1 DAY")


def thirds(df, overlap: dt.timedelta = dt.timedelta(0)) -> list:
    """``df`` in three parts by ``ts``; later parts may reach back into the one before, rows without time are in the first."""
    lo, hi = df.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return [df, df.limit(0), df.limit(0)]
    a, b = (F.lit(lo + (hi - lo) * k / 3).cast("timestamp_ntz") for k in (1, 2))
    back = lambda k: F.lit(lo + (hi - lo) * k / 3 - overlap).cast("timestamp_ntz")
    ts = F.col("ts")
    return [df.where(ts.isNull() | (ts < a)), df.where((ts >= back(1)) & (ts < b)), df.where(ts >= back(2))]
