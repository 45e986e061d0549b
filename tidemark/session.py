"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, SparkSession] = {}


def get_spark(app: str = "tidemark", cpus: int | str | None = None) -> SparkSession:
    """Local session for tests and the benchmark; on a cluster pass your own session to the operators."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "8"
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` as the cluster sets it.

    Only a local session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor does not replay a whole iteration."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt by ``keys`` into ``spark.sql.shuffle.partitions`` parts that stay apart.

    Adaptive execution joins the parts of a shuffle up to a size in bytes as compressed, and a join, aggregates and windows in one stage then
    hold many times that in memory. Parts asked for by number are left as they are.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def scratch(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read back: a lost executor replays nothing before it.

    With ``by`` it is written in folders of these columns, so that a filter on them reads no other. The folder goes when Python exits.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    _folders[folder] = spark
    (df.write.partitionBy(*by) if by else df.write).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@atexit.register
def _clean() -> None:
    for folder, spark in _folders.items():
        with contextlib.suppress(Exception):  # the session may be gone
            jvm = spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
