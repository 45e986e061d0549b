"""Date spines, the fiscal date dimension and dense time series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.scalars import boundary_diff

# Units a spine can step by.
STEPS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH", "hour": "INTERVAL 1 HOUR"}


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, unit: str = "day", name: str = "date_day") -> DataFrame:
    """One row per unit from start up to, not including, end."""
    step = F.expr(STEPS[unit])
    dates = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), step)
    return spark.range(1).select(F.explode(dates).alias(name)).where(F.col(name) < F.lit(end))


def span_spine(df: DataFrame, col: str, unit: str = "day", name: str = "date_day") -> DataFrame:
    """Spine over the range of a date column, both ends included."""
    ends = df.agg(F.min(F.col(col).cast("date")).alias("a"), F.max(F.col(col).cast("date")).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.expr(STEPS[unit]))).alias(name))


def _ends(trunc: Column, months: int) -> tuple[Column, Column]:
    return trunc, F.date_sub(F.add_months(trunc, months), 1)


def fiscal_attributes(d: Column, start_month: int = 2) -> dict[str, Column]:
    """Fiscal calendar of a date as plain arithmetic, without looking at other dates."""
    lead = start_month - 1
    shifted = F.add_months(F.trunc(d, "month"), -lead)  # calendar month at the same place of its year
    year = F.year(shifted) + (1 if lead else 0)
    quarter = F.quarter(shifted)
    q_start = F.add_months(F.trunc(shifted, "quarter"), lead)
    y_start = F.add_months(F.trunc(shifted, "year"), lead)
    q_end = F.date_sub(F.add_months(q_start, 3), 1)
    y_end = F.date_sub(F.add_months(y_start, 12), 1)
    return {
        "fiscal_year": year,
        "fiscal_quarter": quarter.cast("string"),
        "month_of_fiscal_year": F.month(shifted),
        "first_day_of_fiscal_quarter": q_start,
        "last_day_of_fiscal_quarter": q_end,
        "first_day_of_fiscal_year": y_start,
        "last_day_of_fiscal_year": y_end,
        "fiscal_quarter_name": F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string")),
        "fiscal_quarter_name_fy": F.concat(F.lit("FY"), F.substring(year.cast("string"), 3, 2), F.lit("-Q"), quarter.cast("string")),
        "fiscal_month_name": F.concat(year.cast("string"), F.lit("-"), F.date_format(d, "MMM")),
        "fiscal_month_name_fy": F.concat(F.lit("FY"), F.substring(year.cast("string"), 3, 2), F.lit("-"), F.date_format(d, "MMM")),
    }


def holiday(d: Column) -> Column:
    """Name of a fixed-date holiday."""
    md = F.date_format(d, "MM-dd")
    return F.when(md == "01-01", "New Year's Day").when(md == "12-25", "Christmas Day").when(md == "12-26", "Boxing Day")


def business_days_between(start: Column, end: Column) -> Column:
    """Weekdays that are no fixed holiday from start to end, both included, by arithmetic on weeks and years."""
    def weekdays_to(d):  # weekdays from Monday 1970-01-05 up to and including d
        n = F.datediff(d, F.lit("1970-01-05").cast("date")) + 1
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))

    def holidays_to(d):
        def counted(y, m, day):
            h = F.make_date(y, F.lit(m), F.lit(day))
            return F.when((h >= start) & (h <= d) & (F.weekday(h) < 5), 1).otherwise(0)

        years = F.sequence(F.year(start), F.year(d))
        per_year = F.transform(years, lambda y: counted(y, 1, 1) + counted(y, 12, 25) + counted(y, 12, 26))
        return F.aggregate(per_year, F.lit(0), lambda a, v: a + v)

    return (weekdays_to(end) - weekdays_to(F.date_sub(start, 1)) - holidays_to(end)).cast("int")


def nth_business_day(start: Column, n: int) -> Column:
    """The n-th business day from ``start`` (a date) on, by trying the days that can be it."""
    days = F.sequence(start, F.date_add(start, 2 * n + 8), F.expr("INTERVAL 1 DAY"))
    return F.get(F.filter(days, lambda d: business_days_between(start, d) >= n), F.lit(0))


def date_dimension(spine: DataFrame, start_month: int = 2) -> DataFrame:
    """Calendar and fiscal attributes of every day of a spine (``date_day``).

    First and last days of a period are those of the calendar, also where the spine begins or ends inside it, so no
    window over the spine is needed and every attribute is row-wise.
    """
    d = F.col("date_day")
    month_first, month_last = _ends(F.trunc(d, "month"), 1)
    quarter_first, quarter_last = _ends(F.trunc(d, "quarter"), 3)
    year_first, year_last = _ends(F.trunc(d, "year"), 12)
    week_first = F.trunc(d, "week")
    out = spine.select(
        d, d.alias("date_actual"), F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        F.date_format(d, "E").alias("day_name"), F.month(d).alias("month_actual"), F.year(d).alias("year_actual"),
        F.quarter(d).alias("quarter_actual"), (F.weekday(d) + 1).alias("day_of_week"),
        week_first.alias("first_day_of_week"), F.date_add(week_first, 6).alias("last_day_of_week"),
        F.weekofyear(d).alias("week_of_year"), F.dayofmonth(d).alias("day_of_month"),
        (F.datediff(d, quarter_first) + 1).alias("day_of_quarter"), F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        month_first.alias("first_day_of_month"), month_last.alias("last_day_of_month"),
        year_first.alias("first_day_of_year"), year_last.alias("last_day_of_year"),
        quarter_first.alias("first_day_of_quarter"), quarter_last.alias("last_day_of_quarter"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        holiday(d).alias("holiday_desc"), holiday(d).isNotNull().alias("is_holiday"),
        (F.datediff(month_last, month_first) + 1).alias("days_in_month_count"),
        F.datediff(month_last, d).alias("days_until_last_day_of_month"),
        F.date_add(F.add_months(month_first, 1), 7).alias("snapshot_date_eighth"),
        F.date_add(F.add_months(month_first, 1), 4).alias("snapshot_date_fifth"),
        F.date_add(F.add_months(month_first, 1), 3).alias("snapshot_date_fourth"),
        F.date_add(F.add_months(month_first, 1), 44).alias("snapshot_date_billings"),
        *[v.alias(k) for k, v in fiscal_attributes(d, start_month).items()],
    )
    fq0, fq1 = F.col("first_day_of_fiscal_quarter"), F.col("last_day_of_fiscal_quarter")
    fy0, fy1 = F.col("first_day_of_fiscal_year"), F.col("last_day_of_fiscal_year")
    to_q_end = F.datediff(fq1, d)
    week_norm = (12 - F.floor(to_q_end / 7)).cast("int")
    open_day = (F.col("day_of_week") < 6) & ~F.col("is_holiday")
    return out.select(
        "*",
        (F.datediff(d, fq0) + 1).alias("day_of_fiscal_quarter"), (F.datediff(d, fy0) + 1).alias("day_of_fiscal_year"),
        (boundary_diff("week", fy0, d) + 1).alias("week_of_fiscal_year"),
        F.floor(F.datediff(d, fq0) / 7).cast("int").alias("week_of_fiscal_quarter"),
        F.trunc(fq1, "month").alias("last_month_of_fiscal_quarter"),
        (F.trunc(fq1, "month") == d).alias("is_first_day_of_last_month_of_fiscal_quarter"),
        F.trunc(fy1, "month").alias("last_month_of_fiscal_year"),
        (F.trunc(fy1, "month") == d).alias("is_first_day_of_last_month_of_fiscal_year"),
        (F.datediff(fq1, fq0) + 1).alias("days_in_fiscal_quarter_count"),
        (90 - to_q_end).alias("day_of_fiscal_quarter_normalised"), week_norm.alias("week_of_fiscal_quarter_normalised"),
        F.when(week_norm < 5, week_norm).when(week_norm < 9, week_norm - 4).otherwise(week_norm - 8)
        .alias("week_of_month_normalised"),
        (365 - F.datediff(fy1, d)).alias("day_of_fiscal_year_normalised"),
        (((F.pmod(to_q_end - 6, F.lit(7)) == 0) | (d == fq0)).cast("int")).alias("is_first_day_of_fiscal_quarter_week"),
        F.when(open_day, business_days_between(fq0, d)).alias("business_day_of_quarter"),
    )


def densify(df: DataFrame, keys: Sequence[str], month: str, extra_months: int = 1, fill: Sequence[str] = ()) -> DataFrame:
    """Every month from a key's first to its last (plus ``extra_months``); missing months get zeros, other columns NULL.

    Input unique at (keys, month). Each row generates the months up to the key's next one, so the table is read once
    and not joined with a spine; rows per key are bounded by the calendar.
    """
    next_month = F.lead(month).over(W.partitionBy(*keys).orderBy(month))
    until = F.coalesce(F.add_months(next_month, -1), F.add_months(F.col(month), extra_months))
    grown = df.withColumn("__until", until).withColumn("__m", F.explode(F.sequence(month, "__until", F.expr("INTERVAL 1 MONTH"))))
    own = F.col("__m") == F.col(month)
    out = []
    for name in df.columns:
        if name == month:
            out.append(F.col("__m").alias(month))
        elif name in keys:
            out.append(F.col(name))
        elif name in fill:
            zero = F.lit(0).cast(df.schema[name].dataType)
            out.append(F.when(own, F.coalesce(name, zero)).otherwise(zero).alias(name))
        else:
            out.append(F.when(own, F.col(name)).alias(name))
    return grown.select(*out)


def open_per_day(df: DataFrame, keys: Sequence[str], start: str, end: str, horizon: dt.date, born: str | None = None, name: str = "day") -> DataFrame:
    """How many intervals ``[start, end)`` are open on each day per key: ``open_count``, and ``total_age`` in days since ``born`` (else ``start``).

    Equal to expanding every interval to its days and counting, but an interval is only +1 on its first day and -1 after its last.
    Changes are summed per day before they meet, so a key has at most one row per day. Open ends run to ``horizon``, included; days
    without an open interval have no row.
    """
    until = F.coalesce(end, F.lit(horizon + dt.timedelta(days=1)))
    since = F.datediff(born or start, F.lit(dt.date(1970, 1, 1))).cast("long")
    change = lambda at, sign: F.struct(at.alias("at"), F.lit(sign).alias("n"), (sign * since).alias("born"))
    changes = df.where(F.col(start) < until).select(*keys, F.explode(F.array(change(F.col(start), 1), change(until, -1))).alias("c"))
    days = changes.groupBy(*keys, F.col("c.at").alias("__at")).agg(F.sum("c.n").alias("__n"), F.sum("c.born").alias("__born"))
    w = W.partitionBy(*keys).orderBy("__at")
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    held = days.select(*keys, "__at", F.lead("__at").over(w).alias("__next"), F.sum("__n").over(so_far).alias("open_count"), F.sum("__born").over(so_far).alias("__born"))
    out = held.where("open_count > 0").withColumn(name, F.explode(F.sequence("__at", F.date_sub("__next", 1), F.expr("INTERVAL 1 DAY"))))
    age = F.col("open_count") * F.datediff(name, F.lit(dt.date(1970, 1, 1))) - F.col("__born")
    return out.select(*keys, name, "open_count", age.cast("long").alias("total_age"))


def expand_interval(df: DataFrame, start: str, end: str, unit: str = "month", horizon: dt.date | None = None,
                    name: str = "period") -> DataFrame:
    """One row per day or month in which the row is active: [start, end), an open end runs to ``horizon`` (included).

    By month both ends count as their month, so a row that ends inside a month is not active in it. The dates are generated inside the row, so no range join and no shuffle is needed.
    """
    if unit not in ("day", "month"):
        raise ValueError(unit)
    cut = (lambda x: F.trunc(x, "month")) if unit == "month" else (lambda x: x)
    first = cut(F.col(start).cast("date"))
    if unit == "month":
        last = F.add_months(cut(F.col(end).cast("date")), -1)
    else:
        last = F.date_sub(F.col(end).cast("date"), 1)
    if horizon is not None:
        last = F.coalesce(last, cut(F.lit(horizon).cast("date")))
    grown = F.when(first <= last, F.sequence(first, last, F.expr(STEPS[unit])))
    return df.select("*", F.explode(grown).alias(name))
