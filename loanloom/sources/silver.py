"""Loan months stored so that what is per loan needs no exchange: buckets by (trust, asset), sorted by month."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.scratch import shared_dir

KEYS = ("securitizationKey", "assetNumber")


def dealt(df: DataFrame, buckets: int, keys: tuple[str, str] = KEYS) -> DataFrame:
    """Rows laid out as ``write_silver`` wants them: each bucket in one task."""
    return df.repartition(buckets, *keys)


def write_silver(df: DataFrame, buckets: int, *, keys: tuple[str, str] = KEYS, month: str = "reportingPeriodBeginningDate", in_place: bool = False) -> str:
    """Writes ``df`` as a bucketed table of the shared folder and gives its name. Loans of a large trust lie in all buckets.

    Windows, groupings and joins by (trust, asset) over the table read bucket by bucket, without an exchange. ``in_place``:
    the rows of a bucket are in one task already, so they are not moved again. ``buckets`` should give files of some
    hundred megabytes, and be the same for tables that are joined."""
    name = f"silver_{uuid.uuid4().hex}"
    rows = df if in_place else dealt(df, buckets, keys)
    path = f"{shared_dir(df.sparkSession)}/{name}"
    rows.write.bucketBy(buckets, *keys).sortBy(*keys, month).option("path", path).option("compression", "zstd").saveAsTable(name)
    return name


def read_silver(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
