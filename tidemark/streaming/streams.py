"""Structured Streaming forms of the incremental operators.

Results are kept as a log of batches: each micro-batch writes its rows under its own batch number, and a reader takes
the newest row per key. A replayed batch overwrites its own folder, so results are exactly once, and a batch costs
what changed, not the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.streaming import log


def stream_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files arriving in a folder as a stream; sub-folders such as hive-style partitions are included."""
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _log_batch(path: str):
    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write


def run_to_log(df: DataFrame, path: str, checkpoint: str, mode: str = "update"):
    """Process everything available, write each batch to the log, and wait for the end."""
    q = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(_log_batch(path)).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_append(df: DataFrame, path: str, checkpoint: str):
    """Append rows to a Parquet table, exactly once by the sink's own log."""
    q = df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def read_log(spark: SparkSession, path: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Contents of a log, compacted or not: with keys, the newest row per key."""
    return log.read(spark, path, keys)


def merge_sum_counts(stream: DataFrame, event_id: str, loaded_at: str, valid: Column) -> DataFrame:
    """Running count and last load time per valid id; state is one row per id."""
    return stream.where(valid).groupBy(event_id).agg(F.count("*").alias("event_count"), F.max(loaded_at).alias("last_loaded_at"))


def tumbling_counts(stream: DataFrame, ts: str, width: str, keys: Sequence[str], late: str) -> DataFrame:
    w = F.window(ts, width)
    return stream.withWatermark(ts, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("events")).select(
        F.col("w.start").alias("window_start"), *keys, "events")


def sliding_active(stream: DataFrame, ts: str, width: str, slide: str, user: str, late: str) -> DataFrame:
    """Approximate active users of a trailing window that moves by ``slide``."""
    w = F.window(ts, width, slide)
    return stream.withWatermark(ts, late).groupBy(w.alias("w")).agg(F.approx_count_distinct(user).alias("active"), F.count("*").alias("events")).select(
        F.col("w.end").alias("window_end"), "active", "events")


def sessions(stream: DataFrame, user: str, ts: str, gap: str, late: str) -> DataFrame:
    """Sessions by inactivity gap; a session is final once the watermark has passed its end.

    Events later than ``late`` are not in the stream's answer; ``stateful.session_changes`` takes them in.
    """
    w = F.session_window(ts, gap)
    return stream.withWatermark(ts, late).groupBy(user, w.alias("w")).agg(F.count("*").alias("events")).select(
        user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")


def first_copy(stream: DataFrame, event_id: str, ts: str, late: str) -> DataFrame:
    """First copy of every id within the lateness bound (unlike ``only_once``, which drops repeated ids entirely)."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([event_id])
