"""Intermediate tables in the folder that driver and executors share."""
from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..functions.scratch import shared_dir

_recorders: list[list[DataFrame]] = []


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` as a Parquet table of the shared folder, in folders by the columns ``by``: computed once, read many times,
    safe when executors go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    for tables in _recorders:
        tables.append(out)
    return out


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The tables that are written inside the block."""
    _recorders.append([])
    try:
        yield _recorders[-1]
    finally:
        _recorders.pop()


def discarded(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more, and have Spark drop the shuffle files of what has ended.

    Spark does the latter when the driver's garbage is collected, each half an hour at least; steps that move much
    data one after the other should not keep each other's files till then."""
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    for _ in range(2):  # what has ended is only let go of some moments later; with 0.2 s it was still there every other time
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.6)


def reads(df: DataFrame, table: DataFrame) -> bool:
    """Whether ``df`` reads the written ``table``."""
    return any(table._scratch_path.rsplit("/", 1)[1] in f for f in df.inputFiles())


def steady(df: DataFrame) -> DataFrame:
    """``df``, or a written copy if rows come out of an exchange, that is, in another order when it is computed again."""
    return written(df) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` for small tables of iterations; its files stay unless Spark is set to clean checkpoints."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
