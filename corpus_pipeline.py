"""A training corpus from documents: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which the runner writes as Parquet and reads again
as the next stage's ``docs``. All but the last return the columns of ``documents``, ``n_chars`` set anew where the
text changed. A stage's working tables are deleted when the next stage begins, unless ``docs`` still reads them.

Defined cases: rows are judged one by one, so a rejected row takes no other row of its id along. Null ids are allowed
everywhere; ``near_duplicates`` gives such rows numbers above all ids, made from their texts. Of rows with one id it
keeps one. Null and empty texts pass all stages (``packed`` makes them the end id alone). Extra columns are kept,
whatever their names. Empty tables give empty results.
"""
from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import decontamination, jaccard_join, kneser_ney, packing, suffix_dedup
from loanloom.llm.scratch import reads, recorded, release, shared_dir
from loanloom.llm.text import fresh, quoted, table, thinned, without

#: Shortest repeated string that goes, in bytes: less than 50 words of most languages.
REPEATED = 200
_held: list[DataFrame] = []


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that first deletes the working tables of the stage before it."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _held
        own = [t for t in _held if t.sparkSession is spark]
        kept = [t for t in own if reads(docs, t)]
        release(spark, *(t for t in own if not any(t is k for k in kept)))
        with recorded() as made:
            out = function(spark, docs, sf_dir)
        _held = kept + made
        return out

    return run


def _key(*columns: str) -> Column:
    """What rows alike in ``columns`` share, and no others; never null."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney quality classifier does not reject. Its verdict depends on text and language."""
    key = fresh(docs, "key")
    rows = docs.withColumn(key, _key("text", "lang"))
    verdicts = kneser_ney.judged(rows, table(spark, sf_dir, "labels").filter("quality = 1"), keep=(key,))
    return without(rows, verdicts.filter("not kept").select(key), key).drop(key)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join: that with the smallest id. Of rows that share this id, one
    stays, that with the least hash of its text."""
    node = fresh(docs, "node")
    rows = docs.withColumn(node, F.coalesce(F.col("doc_id").cast("long"), F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(1 << 62)))
    joined = jaccard_join.join(rows, id_col=node)
    others = joined.filter("doc_id <> component_id").select(F.col("doc_id").alias(node))
    again = joined.groupBy(F.col("doc_id").alias(node)).count().filter("count > 1").select(node)
    firsts = without(rows, others, node)
    several = thinned(firsts, again, node).join(again, node, "left_semi")
    one = several.groupBy(node).agg(F.min_by(F.struct(*map(quoted, docs.columns)), F.xxhash64("text")).alias("row")).select("row.*")
    return without(firsts, again, node).drop(node).unionByName(one)


@_stage
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of ``REPEATED`` bytes that occur again; documents of which nothing is left go.

    A cut inside a character drops that character."""
    rest = [c for c in docs.columns if c != "text"]
    missing = fresh(docs, "missing")
    rows = docs.select(F.struct(*map(quoted, rest), F.col("text").isNull().alias(missing)).alias("rest"), "text")
    out = suffix_dedup.remove_repeats(rows, id_col="rest", length=REPEATED, gram=32)
    cut = F.size("spans") > 0
    text = F.when(cut | ~F.col(f"rest.{missing}"), F.col("text"))
    values = {c: F.col(f"rest.`{c}`") for c in rest} | {"text": text}
    if "n_chars" in values:
        values["n_chars"] = F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(values["n_chars"])
    return out.filter(~cut | (F.length("text") > 0)).select(*(values[c].alias(c) for c in docs.columns))


@_stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. The verdict depends on the text."""
    key = fresh(docs, "key")
    rows = docs.withColumn(key, _key("text"))
    found = decontamination.leaks(rows, table(spark, sf_dir, "benchmark"), id_col=key)
    return without(rows, found.select(key).distinct(), key).drop(key)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings), ("benchmark_leaks", benchmark_leaks), ("packed", packed)]

#: The stages are no SQL; the tests hold their operators against brute force, and the whole by counts and odd rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
