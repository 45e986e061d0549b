"""What the operators share: words, scratch tables, hashing of one key into [0, 1), sorted groups in Python workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch  # noqa: F401

WHITE = r"[\x20\x09-\x0D]+"
#: The same characters for ``bytes.strip`` and ``bytes.translate``.
WHITE_BYTES = b" \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def unit(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the parts alone (md5, so other engines can repeat it)."""
    text = F.concat_ws("\x1f", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that ``df`` has no column of (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def smaller_batches(spark: SparkSession, rows: int = 512) -> None:
    """Texts are long rows: Python workers get at most ``rows`` of them at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
