"""The folder that driver and executors share."""
from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where it is unset, a folder of our own."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if conf.get("spark.master", "").startswith("local"):
        path = tempfile.mkdtemp(prefix="spark-loanloom-")
    else:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    spark.sparkContext.setCheckpointDir(path)
    return path


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, for small tables that a query reads several times."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of the shared folder: computed once, read by columns, safe when executors go."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Has Spark drop the shuffle files of what has ended: steps that move much should not keep each other's files."""
    for _ in range(2):  # what has ended is only let go of some moments later
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.6)
