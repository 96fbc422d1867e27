"""Readers and writers of filings, listings, dictionaries, benchmarks and published tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.clean import typed
from ..operators.compare import label_quarter
from .schemas import raw_schema
from .versioned import Versioned

#: Rows of a written filing at most: a compressed file is read by one task.
FILING_ROWS = 1_000_000
LISTING = "secname string, filename string, entitytype string, assetclass string, reportdate string, url string"


def read_tape(spark: SparkSession, paths: str | list[str], kind: str = "loan", keep: list[str] | None = None, corrupt: str | None = None) -> DataFrame:
    """Asset rows of XML filings; elements that a file lacks are null; ``keep`` prunes the schema. Rows that do not parse are
    null, with their text in the column ``corrupt`` if it is named."""
    schema, reader = raw_schema(kind, keep), spark.read.format("xml").option("rowTag", "assets")
    if corrupt:
        schema, reader = StructType([*schema.fields, StructField(corrupt, StringType())]), reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).load(paths)


def listed_paths(listing: DataFrame, folder: str) -> list[str]:
    """The paths of the listed files that are in ``folder``: names of files, some thousands, not their rows."""
    spark = listing.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    held = {s.getPath().getName() for s in fs.listStatus(at)} if fs.exists(at) else set()
    names = [r["filename"] for r in listing.select("filename").distinct().collect()]
    return [f"{folder.rstrip('/')}/{n}" for n in sorted(n for n in names if n in held)]


def _wanted(listing: DataFrame, entity: str, assets: str) -> DataFrame:
    from ..operators.listing import shelf

    rows = listing.filter((F.col("entitytype") == entity) & (F.col("assetclass") == assets))
    return rows.select("filename", F.col("secname").alias("securitizationKey"), shelf(F.col("secname")).alias("shelf"), F.col("reportdate").alias("reportDate"))


def _filed(spark: SparkSession, wanted: DataFrame, folder: str, kind: str, keep: list[str] | None) -> DataFrame:
    paths = listed_paths(wanted, folder)
    if not paths:
        return spark.createDataFrame([], StructType([*raw_schema(kind, keep).fields, StructField("_corrupt", StringType()), StructField("filename", StringType())]))
    return read_tape(spark, paths, kind, keep, "_corrupt").withColumn("filename", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))


def read_tapes(spark: SparkSession, listing: DataFrame, folder: str, entity: str, assets: str, kind: str = "loan", keep: list[str] | None = None) -> DataFrame:
    """Typed rows of all listed filings of a class in ``folder``, with trust, shelf and report date of the listing. The
    listing chooses the files before they are read; other files of the folder are not opened. Rows that do not parse
    are left to ``quarantine``."""
    wanted = _wanted(listing, entity, assets)
    rows = _filed(spark, wanted, folder, kind, keep).filter("_corrupt is null").drop("_corrupt")
    return typed(rows, kind).join(F.broadcast(wanted), "filename")  # names of files, as in ``listed_paths``


def quarantine(spark: SparkSession, listing: DataFrame, folder: str, entity: str, assets: str, kind: str = "loan") -> DataFrame:
    """(filename, assetNumber, record): what of the listed filings does not parse, with the asset number if it was read."""
    return _filed(spark, _wanted(listing, entity, assets), folder, kind, None).filter("_corrupt is not null").select("filename", "assetNumber", F.col("_corrupt").alias("record"))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=LISTING)


def read_dictionary(spark: SparkSession, path: str, columns: tuple[str, str] = ("old", "new")) -> DataFrame:
    return spark.read.csv(path, header=True, schema=", ".join(f"{c} string" for c in columns))


def read_benchmark(spark: SparkSession, path: str) -> DataFrame:
    """(month, value) of a date,value file; lines that are neither go."""
    raw = spark.read.csv(path, header=True, schema="date string, value string")
    return raw.select(F.trunc(F.col("date").try_cast("date"), "MM").alias("month"), F.col("value").try_cast("double").alias("value")).dropna().orderBy("month")


def read_quarters(spark: SparkSession, path: str) -> DataFrame:
    """(date, value): labels to quarter ends, fractions to percent."""
    raw = spark.read.csv(path, header=True, schema="label string, value string")
    value = F.col("value").try_cast("double")
    return raw.select(label_quarter(F.col("label")).alias("date"), F.when(F.abs(value) <= 1, value * 100).otherwise(value).alias("value")).dropna()


def write_quarters(series: DataFrame, path: str) -> None:
    series.select(F.last_day("date").alias("date"), "value").orderBy("date").write.mode("overwrite").csv(path, header=True)


def published(df: DataFrame, columns: list[str], as_of: str | None = None) -> DataFrame:
    """The published columns in their order, trust keys in snake case, stamped with ``as_of``."""
    out = df.withColumnRenamed("securitizationKey", "securitization_key")
    out = out.withColumn("as_of", F.lit(as_of).cast("date")) if as_of else out
    return out.select(*[c for c in columns if c in out.columns])


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both with one for each key, the new one where there are two."""
    both = old.withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)))
    return both.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_age"))).filter("_n = 1").drop("_n", "_age")


def merge(table: Versioned, new: DataFrame, keys: list[str]) -> int:
    """``upsert`` into a stored table: only partitions that hold incoming rows are read and written, and all are switched at
    once. A key belongs to one partition for good."""
    version = table.version()
    touched = new.select(table.by).distinct()
    stored = table.read(version).join(touched, table.by, "left_semi")
    return table.commit(upsert(stored, new.select(*table.schema.names), keys), version=version)


def write_tape(rows: DataFrame, path: str, mode: str = "error") -> None:
    """Asset rows as XML filings, as ``read_tape`` reads them, compressed: element names are most of their bytes."""
    rows.write.mode(mode).format("xml").option("compression", "gzip").option("maxRecordsPerFile", FILING_ROWS).option("rootTag", "assetData").option("rowTag", "assets").option("dateFormat", "MM-dd-yyyy").save(path)


def write_csvs(frames: dict[str, DataFrame], path: str) -> None:
    """Each derived table (index, trust months, universe) as CSV with a header, in a folder of its own name."""
    for name, df in frames.items():
        df.write.mode("overwrite").csv(f"{path}/{name}", header=True)


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replaces only the partitions that ``df`` has rows of."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def snapshot(index: DataFrame, columns: list[str], benchmarks: DataFrame) -> DataFrame:
    """One row of JSON: the series in order, its latest row, and benchmarks by series and metric."""
    point = F.struct(F.col("month").cast("string").alias("date"), *columns)
    series = index.agg(F.to_json(F.array_sort(F.collect_list(point))).alias("series"), F.to_json(F.max_by(point, "month")).alias("latest"))
    each = benchmarks.groupBy("series", "metric").agg(F.array_sort(F.collect_list(F.struct("date", "value"))).alias("points"))
    marks = each.agg(F.to_json(F.array_sort(F.collect_list(F.struct("series", "metric", "points")))).alias("benchmarks"))
    return series.join(marks)
