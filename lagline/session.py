"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lagline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by ``spark.checkpoint.dir``.

    Only where the session names none (a local test run) is a temporary folder used.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="lagline-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_dir(spark)}/lagline/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str, partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder, or to ``path`` in it, and read it back.

    Cuts lineage so that several fits reuse one result; the files outlive any executor.
    """
    path = path or scratch_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_parts(parts: Iterable[DataFrame], path: str) -> DataFrame:
    """Write the rows of all parts to one table below the scratch folder and read it back.

    A part gives its shuffle files up before the next, so these never take more than the files of one.
    """
    for part in parts:
        part.write.mode("append").option("compression", "zstd").parquet(path)
        release_shuffles(part.sparkSession)
    return part.sparkSession.read.schema(part.schema).parquet(path)


def shares_of(df: DataFrame, share_bytes: int, most: int) -> int:
    """Into how many shares a table is cut, by Spark's estimate of its size."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return min(most, max(1, math.ceil(int(str(size)) / share_bytes)))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the scratch folder that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def release_shuffles(spark: SparkSession) -> None:
    """Give up the shuffle files of the steps before at once.

    Spark deletes them when the driver's garbage collector finds them unused, which may take half an hour.
    Its threads hold on to the last job, so there is one more, of a single row, before the collector is asked.
    """
    spark.range(1).collect()
    gc.collect()
    spark._jvm.System.gc()
