"""What the operators keep on disk between their steps."""
from fractions import Fraction
from pathlib import Path

from pyspark.sql import functions as F

from loanloom.llm import jaccard_join, maxent


def shuffled(spark) -> int:
    """Bytes of the shuffle files that are still there."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = (Path(files.apply(k).toString()) for k in range(files.length()))
    return sum(p.stat().st_size for p in paths if p.name.startswith("shuffle_") and p.exists())


def test_gradients_leave_no_shuffle_files_behind(spark, monkeypatch):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(60))).alias("text")).repartition(4)
    held, inner = [], maxent.per_partition

    def step(*args):
        out = inner(*args)
        held.append(shuffled(spark))
        return out

    monkeypatch.setattr(maxent, "per_partition", step)
    maxent.train(docs)
    assert len(held) == 6 and held[0] > 1 << 18
    assert max(held) < 6 * held[0]  # a step has twice as many sums as the first; some have more of their blocks


def test_prefixes_are_on_disk_once_at_a_time(spark, monkeypatch):
    docs = spark.range(0, 400, 1, 4).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(1000))).alias("text"))
    held, inner = [], jaccard_join.written

    def write(*args):
        out = inner(*args)
        if out.columns == ["tok", "gid", "pivot"]:
            held.append(shuffled(spark))
        return out

    monkeypatch.setattr(jaccard_join, "written", write)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where tables are large
    try:
        jaccard_join._linked(docs, 5, Fraction(4, 5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(held) == 1 and held[0] < 3_000_000
