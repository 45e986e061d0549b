"""Column helpers that give warehouse-dialect semantics where Spark's built-in differs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- keys ---------------------------------------------------------------------------------


def surrogate_key(cols: Sequence[ColumnLike], null_token: str = NULL_TOKEN) -> Column:
    """MD5 over the '-'-joined text of the columns; NULL has its own token."""
    parts = [F.coalesce(c(x).cast("string"), F.lit(null_token)) for x in cols]
    return F.md5(F.concat_ws("-", *parts))


def date_id(x: ColumnLike) -> Column:
    """Date as the integer YYYYMMDD."""
    return F.date_format(c(x), "yyyyMMdd").cast("int")


def zoned_date_id(x: ColumnLike, zone: str = "America/Los_Angeles") -> Column:
    """``date_id`` of a UTC timestamp after conversion to a zone."""
    return date_id(F.convert_timezone(F.lit("UTC"), F.lit(zone), c(x).cast("timestamp_ntz")))


def keyed_null(x: ColumnLike, missing: str | int = -1) -> Column:
    """Foreign key with NULL sent to the missing member."""
    return F.coalesce(c(x).cast("string"), F.md5(F.lit(str(missing))))


def salted_hash(x: ColumnLike, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), F.lower(F.trim(c(x).cast("string")))), 256)


def infinity(x: ColumnLike) -> Column:
    """Open end of a validity interval as a far-future timestamp."""
    return F.coalesce(c(x).cast("timestamp_ntz"), F.expr("timestamp_ntz'9999-12-31 00:00:00'"))


# --- conditional and arithmetic -----------------------------------------------------------


def iff(cond: Column, a, b) -> Column:
    return F.when(cond, a).otherwise(b)


def div0(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, 0 for a zero divisor, NULL for a NULL one."""
    a, b = c(a), c(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def div0null(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, 0 for a zero or NULL divisor."""
    a, b = c(a), c(b)
    return F.when(F.coalesce(b, F.lit(0)) == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, NULL for a zero divisor."""
    return F.try_divide(c(a), c(b))


def _any_null(cols: Sequence[ColumnLike]) -> Column:
    cond = c(cols[0]).isNull()
    for x in cols[1:]:
        cond = cond | c(x).isNull()
    return cond


def least_or_null(*cols: ColumnLike) -> Column:
    """Row-wise minimum that is NULL as soon as one argument is."""
    return F.when(~_any_null(cols), F.least(*[c(x) for x in cols]))


def greatest_or_null(*cols: ColumnLike) -> Column:
    return F.when(~_any_null(cols), F.greatest(*[c(x) for x in cols]))


def decode(x: ColumnLike, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c(x) == F.lit(k), F.lit(v)) if out is None else out.when(c(x) == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def is_real(x: ColumnLike) -> Column:
    return c(x).try_cast("double").isNotNull()


# --- dates --------------------------------------------------------------------------------


def month_start(x: ColumnLike) -> Column:
    return F.trunc(c(x), "month")


def boundary_diff(unit: str, start: ColumnLike, end: ColumnLike) -> Column:
    """Number of unit boundaries crossed between two instants (not whole elapsed units)."""
    a, b = c(start), c(end)
    unit = unit.lower()
    if unit == "year":
        return F.year(b) - F.year(a)
    if unit == "quarter":
        return (F.year(b) - F.year(a)) * 4 + (F.quarter(b) - F.quarter(a))
    if unit == "month":
        return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
    if unit == "week":
        return (F.datediff(F.trunc(b, "week"), F.trunc(a, "week")) / 7).cast("int")
    if unit == "day":
        return F.datediff(b.cast("date"), a.cast("date"))
    if unit in ("hour", "minute", "second", "millisecond"):
        lo = F.date_trunc(unit, a.cast("timestamp_ntz"))
        hi = F.date_trunc(unit, b.cast("timestamp_ntz"))
        return F.timestamp_diff(unit.upper(), lo, hi)
    raise ValueError(unit)


def seconds_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Elapsed seconds with fraction."""
    return F.timestamp_diff("MICROSECOND", c(start), c(end)) / F.lit(1000000.0)


# --- text and arrays ----------------------------------------------------------------------


def regexp_full(x: ColumnLike, pattern: str, flags: str = "") -> Column:
    """Regular expression that must match the whole string."""
    lead = f"(?{flags})" if flags else ""
    return c(x).rlike(f"{lead}^(?:{pattern})$")


def concat_strict(sep: str, *cols: ColumnLike) -> Column:
    """Separator concatenation that is NULL as soon as one argument is."""
    parts = []
    for i, x in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(c(x).cast("string"))
    return F.concat(*parts)


def split_part(x: ColumnLike, sep: str, n: int) -> Column:
    """n-th field, 1-based, negative from the end; index 0 means 1."""
    return F.split_part(c(x), F.lit(sep), F.lit(n or 1))


def strtok_array(x: ColumnLike, delimiters: str) -> Column:
    """Tokens between any of the delimiter characters, empty ones dropped."""
    klass = "[" + "".join(d if d.isalnum() else "\\" + d for d in delimiters) + "]"
    return F.filter(F.split(c(x), klass), lambda t: t != "")


def array_slice(x: ColumnLike, start: int, stop: int) -> Column:
    """Elements [start, stop), 0-based."""
    return F.slice(c(x), start + 1, max(stop - start, 0))


def array_insert0(x: ColumnLike, pos: int, value: Column) -> Column:
    return F.array_insert(c(x), F.lit(pos + 1), value)


def ip_number(x: ColumnLike) -> Column:
    """Dotted IPv4 text as a long, NULL when it is no address."""
    parts = F.split(c(x), "\\.")
    octets = F.transform(parts, lambda p: p.try_cast("long"))
    valid = (F.size(parts) == 4) & F.forall(octets, lambda o: o.isNotNull() & o.between(0, 255))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda acc, o: acc * 256 + o)
    return F.when(valid, number)


# The 32 check characters of the case-safe record id.
ID_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ012345"


def case_safe_id(x: ColumnLike) -> Column:
    """15-character case-sensitive record id to its 18-character case-safe form.

    Each group of five characters gives one check character: bit i is set when character i is upper case.
    """
    x = c(x)
    checks = []
    for group in range(3):
        bits = F.lit(0)
        for i in range(5):
            ch = F.substring(x, group * 5 + i + 1, 1)
            bits = bits + F.when(ch.rlike("^[A-Z]$"), F.lit(1 << i)).otherwise(F.lit(0))
        checks.append(F.substring(F.lit(ID_ALPHABET), bits + 1, F.lit(1)))
    return F.when(F.length(x) == 15, F.concat(x, *checks)).otherwise(x)


def masked_random(length: int = 16) -> Column:
    """Random text of a length (non-deterministic: never part of a checked result)."""
    return F.substring(F.sha2(F.expr("uuid()"), 256), 1, length)
