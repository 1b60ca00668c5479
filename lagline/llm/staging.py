"""Tables written to the shared folder, where any executor finds them again."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from lagline.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as compressed Parquet and read back; lost executors don't lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(df: DataFrame, name: str) -> DataFrame:
    """``staged``, after which the shuffle files that led to the table are given up at once.

    Spark deletes the files of a shuffle when the driver's garbage collector finds it unused, which
    may take half an hour; a chain of large steps would pile them up until then. Spark's threads hold on
    to the last job, so there is one more, of a single row, before the collector is asked.
    """
    out = staged(df, name)
    del df
    out.sparkSession.range(1).collect()
    gc.collect()
    out.sparkSession._jvm.System.gc()
    return out


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
