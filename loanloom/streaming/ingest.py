"""Incremental ingest: new filings only, later filings win, changed trusts recomputed."""
from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import settled
from ..operators.clean import keep_last
from ..operators.metrics import trust_month_metrics
from ..sources.readers import write_partitions
from ..sources.schemas import raw_schema
from ..sources.versioned import Versioned

KEY = "securitizationKey"


def filings(spark: SparkSession, folder: str, kind: str = "loan") -> DataFrame:
    """A stream of asset rows of the XML files that appear in ``folder``, with their file names."""
    rows = spark.readStream.format("xml").option("rowTag", "assets").schema(raw_schema(kind)).load(folder)
    return rows.withColumn("filename", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))


def ingest(stream: DataFrame, prepare, table: str, checkpoint: str):
    """Runs ``stream`` over what is there now and stops. ``prepare`` gives typed rows with trust and report date.

    The table is partitioned by trust. A batch rewrites the partitions of its trusts: stored and new rows together,
    one for each loan month, that of the latest report. Running it again with the same checkpoint reads nothing."""

    def batch(rows: DataFrame, _: int) -> None:
        spark, new = rows.sparkSession, prepare(rows)
        path = spark._jvm.org.apache.hadoop.fs.Path(table)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            old = spark.read.schema(new.schema).parquet(table).join(new.select("securitizationKey").distinct(), "securitizationKey", "left_semi")
            new = old.unionByName(new)
        # all rows lie in the shared folder before their own partitions are replaced: no lost executor needs these again
        write_partitions(settled(keep_last(new)), table, "securitizationKey")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_atomically(stream: DataFrame, prepare, table: Versioned, checkpoint: str, *, before_switch=None):
    """As ``ingest``, into a versioned table: a batch's trusts come into force together or not at all. A batch that died
    before that is run again by the stream; one that died after it is known by its tag and not applied twice."""

    def batch(rows: DataFrame, number: int) -> None:
        tag, version = f"{checkpoint}#{number}", table.version()
        if not table.applied(tag):
            new = prepare(rows)
            trusts = new.select(KEY).distinct()
            stored = table.read(version)
            both = stored.join(trusts, KEY, "left_semi").unionByName(new.select(*table.schema.names))
            table.commit(keep_last(both), tag=tag, version=version, before_switch=before_switch)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def refresh_changed(loans: Versioned, gold: Versioned, make=partial(trust_month_metrics, deal=True)) -> int:
    """Makes anew the gold rows of those trusts only whose loans have changed since the gold table was made, and drops
    those of trusts that are gone. The folder of a trust's loans is the mark of its gold rows."""
    source, version = loans.manifest(), gold.version()
    now = source.select("key", F.col("folder").alias("mark"))
    stored = gold.manifest(version)
    new, gone = now.join(stored.select("key", "mark"), ["key", "mark"], "left_anti"), stored.join(now, "key", "left_anti").select("key")
    if new.isEmpty() and gone.isEmpty():
        return version
    rows = loans.read().join(new.select(F.col("key").alias(KEY)), KEY, "left_semi")
    return gold.commit(make(rows), new, gone, version=version)


def refresh(loans: DataFrame, gold: str, trusts: list[str] | None = None) -> None:
    """Trust metrics of the given trusts (all without) written over their partitions."""
    rows = loans if trusts is None else loans.filter(F.col("securitizationKey").isin(trusts))
    write_partitions(trust_month_metrics(rows), gold, "securitizationKey")
