"""Features of loans for default models: encoded regressors, forest importances, interaction tables."""
from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.util import inheritable_thread_target

from ..functions import double
from ..functions.scratch import stored
from .quantiles import quantiles

KEY = "securitizationKey"
# fixed values
EXCLUDED = (
    "commercialCreditScore", "obligorEmploymentVerificationCode", "gracePeriodNumber", "obligorIncomeVerificationCode",
    "servicingFeePercentage", "vehicleManufacturerName",
)


def profile(df: DataFrame, fields: list[str]) -> DataFrame:
    """Per field: rows, filled share, different values, most frequent value, and of the filled rows its share and the
    values above 15 %, most frequent first. Of values as frequent the greater comes first; nulls are no value."""
    long = df.select(*(F.col(c).cast("string").alias(c) for c in fields)).unpivot([], fields, "field", "v")
    counts = long.groupBy("field", "v").agg(F.count(F.lit(1)).alias("n"))
    known = F.when(F.col("v").isNotNull(), F.col("n"))
    total = counts.groupBy("field").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(known), F.lit(0)).alias("filled"), F.count("v").alias("values"))
    share = known / F.col("filled")
    often = F.sort_array(F.collect_list(F.when(share > 0.15, F.struct("n", "v"))), asc=False)
    tops = counts.join(total, "field").groupBy("field", "rows", "filled", "values").agg(F.max_by("v", F.when(known.isNotNull(), F.struct("n", "v"))).alias("top"), F.max(share).alias("top_share"), often["v"].alias("frequent"))
    return tops.withColumn("fill_share", F.col("filled") / F.col("rows"))


def encode(df: DataFrame, fields: list[str]) -> DataFrame:
    """The rows with 0/1 columns. Of a field with two values or more and more than a fifth of its rows filled: one for a
    dominant value (90 % or more); else one for each frequent value, the last one left out if all are frequent; else,
    if no value has a tenth, one for each tenth of a numeric field up to the eighth. And one for null, where only a part
    is null. The rules come from one row of statistics per field."""
    rules = {r["field"]: r for r in profile(df, fields).collect()}
    numeric = [c for c in fields if dict(df.dtypes)[c] not in ("string", "boolean", "date")]
    cuts = df.agg(*(F.percentile(double(c), [u / 100 for u in range(0, 81, 10)]).alias(c) for c in numeric)).first() if numeric else {}
    flag = lambda test: F.coalesce(test, F.lit(False)).cast("int")
    out = {}
    for c in (c for c in fields if c in rules):
        r = rules[c]
        if r["values"] > 1 and r["fill_share"] > 0.2:
            if r["top_share"] >= 0.9:
                out[f"{c}_is_{r['top']}"] = flag(F.col(c).cast("string") == r["top"])
            elif r["top_share"] >= 0.1:
                chosen = r["frequent"][: r["values"] - 1]
                out |= {f"{c}_is_{v}": flag(F.col(c).cast("string") == v) for v in chosen}
            elif c in numeric:
                out |= {f"{c}_p{10 * k}": flag((double(c) >= lo) & (double(c) < hi)) for k, (lo, hi) in enumerate(zip(cuts[c], cuts[c][1:]))}
        if 0 < r["filled"] < r["rows"]:
            out[f"{c}_null"] = F.col(c).isNull().cast("int")
    return df.withColumns(out) if out else df


def binned(df: DataFrame, columns: list[str], bins: int = 32) -> DataFrame:
    """Numeric columns with more than ``bins`` values cut at their exact quantiles: a value becomes the number of its bin.
    What comes out is a bounded number of different values, whatever the number of rows."""
    values = df.select(*(double(c).alias(c) for c in columns)).unpivot([], columns, "field", "v").filter("v is not null").distinct()
    many = [r["field"] for r in values.groupBy("field").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bins).collect()]
    out = {c: double(c) for c in columns}
    if many:
        cuts = {}
        for r in quantiles(df, [], sorted(many), [k / bins for k in range(1, bins)]).collect():
            cuts.setdefault(r["field"], set()).add(r["value"])
        # bin k: values above k of the cuts
        for c, at in cuts.items():
            out[c] = F.size(F.filter(F.array(*map(F.lit, sorted(at))), lambda x, c=c: x < double(c))).cast("double")
    return df.withColumns(out)


def _drawn(patterns: DataFrame, tree: int, seed: int) -> DataFrame:
    """The patterns with ``taken``: how often a bootstrap of the rows takes a row of theirs. Those without any go."""

    def run(batches):
        for batch in batches:
            n = batch.column("n").to_numpy()
            first = zlib.crc32(str(batch.slice(0, 1).to_pylist()).encode())
            taken = np.random.Generator(np.random.Philox(key=[(seed << 32) + tree, first])).poisson(n).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(taken)], names=[*batch.schema.names, "taken"]).filter(pa.array(taken > 0))

    return patterns.mapInArrow(run, StructType([*patterns.schema.fields, StructField("taken", DoubleType())]))


def importances(df: DataFrame, columns: list[str], bad: list[int] = (2, 3, 4, 5), trees: int = 100, seed: int = 7, threads: int = 8) -> tuple[DataFrame, float]:
    """(feature, importance) of a random forest that tells loans in the ``bad`` states, and its area under the curve
    on a fifth of the rows that it has not seen.

    The forest is fitted on 0/1 as numbers: their variance is half the Gini impurity, so splits and importances are a
    classifier's, but leaves that vote for the same class are not merged, which leaves nothing where few loans are bad.

    Rows with the same label and the same columns (in 32 bins, among which the trees split anyway) are counted first. A
    bootstrap takes each row a Poisson number of times, so a pattern of n rows as often as a draw of mean n says: what the
    trees are fitted on is as large as the patterns, not the rows times the trees. Each tree is a fit of its own."""
    from multiprocessing.pool import ThreadPool

    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    held = F.pmod(F.xxhash64(KEY, "assetNumber"), F.lit(5)) == 0
    rows = df.dropna(subset=columns).select(*columns, F.coalesce(F.col("monthsDelinquent").isin(*bad), F.lit(False)).cast("double").alias("label"), held.alias("held"))
    patterns = stored(binned(rows, columns).groupBy(*columns, "label", "held").agg(F.count(F.lit(1)).alias("n")))
    vectors, growing = VectorAssembler(inputCols=columns, outputCol="features"), patterns.filter("not held")
    one = RandomForestRegressor(numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", weightCol="taken")

    def fitted(tree: int):
        return one.copy({one.seed: seed + tree}).fit(vectors.transform(_drawn(growing, tree, seed)))

    with ThreadPool(threads) as pool:
        grown = pool.map(inheritable_thread_target(df.sparkSession)(fitted), range(trees))
    scored = vectors.transform(patterns.filter("held"))
    for k, tree in enumerate(grown):
        scored = tree.setPredictionCol(f"_{k}").transform(scored)
    mean = sum((F.col(f"_{k}") for k in range(1, trees)), F.col("_0")) / trees
    area = BinaryClassificationEvaluator(rawPredictionCol="score", weightCol="n").evaluate(scored.select("label", F.col("n").cast("double").alias("n"), mean.alias("score")))
    total = np.sum([tree.featureImportances.toArray() for tree in grown], axis=0)
    shares = total / total.sum() if total.sum() else total
    found = sorted(((c, float(x)) for c, x in zip(columns, shares)), key=lambda r: -r[1])
    return df.sparkSession.createDataFrame(found, "feature string, importance double"), area


def bucketed(df: DataFrame, fields: str | list[str], number: int = 7, listed: int = 10_000) -> DataFrame:
    """Adds ``<field>_bucket`` for each field: equal bins for numeric fields with more than ``number`` values, else the
    value's place. Rows in none of them, nulls and the greatest number, count to the first.

    One aggregate over all fields gives what the buckets need: a range, or the values. Up to ``listed`` values of a field
    become part of the plan; a text field with more of them is joined with its places."""
    fields = [fields] if isinstance(fields, str) else list(fields)
    kinds = dict(df.dtypes)
    values = df.select(*(F.struct(F.col(c).cast("string").alias("v"), (F.lit(None) if kinds[c] == "string" else F.col(c)).cast("double").alias("x")).alias(c) for c in fields)).unpivot([], fields, "field", "_")
    known = values.filter("_.v is not null").select("field", "_.v", "_.x").distinct()
    numeric = F.col("field").isin(*(c for c in fields if kinds[c] != "string"))
    size = F.count(F.lit(1))
    binned = numeric & (F.col("n") > number)
    found = known.groupBy("field").agg(size.alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    few = known.join(F.broadcast(found.filter(~binned & (F.col("n") <= listed)).select("field")), "field").groupBy("field").agg(F.array_sort(F.collect_list(F.struct("x", "v"))).alias("values"))
    rules = {r["field"]: r for r in found.join(few, "field", "left").collect()}
    out, joins = {}, []
    for c in fields:
        r, b = rules.get(c), F.lit(0)
        if r is not None and kinds[c] != "string" and r["n"] > number:
            step = (r["hi"] - r["lo"]) / number
            place = F.floor((double(c) - r["lo"]) / step)
            b = F.when((double(c) < r["hi"]) & (place >= 0), F.least(place, F.lit(number - 1)).cast("int"))
        elif r is not None and r["values"] is not None:
            places = F.create_map(*(F.lit(x) for k, v in enumerate(r["values"]) for x in (v["v"], k)))
            b = places[F.col(c).cast("string")]
        elif r is not None:
            place = F.row_number().over(Window.partitionBy("field").orderBy("v")) - 1
            joins.append((c, known.filter(F.col("field") == c).select(F.col("v").alias(c), place.alias(f"_{c}"))))
            b = F.col(f"_{c}")
        out[f"{c}_bucket"] = F.coalesce(b, F.lit(0))
    rows = df
    for c, places in joins:
        rows = rows.join(places, c, "left")
    return rows.withColumns(out).drop(*(f"_{c}" for c, _ in joins))


def _is_bad(bad: list[int]) -> Column:
    return F.coalesce(F.col("monthsDelinquent").isin(*bad), F.lit(False)).cast("double")


def interactions(df: DataFrame, a: str, b: str, bad: list[int] = (2, 3, 4, 5)) -> DataFrame:
    """Mean bad share by pair of buckets."""
    return df.groupBy(a, b).agg(F.avg(_is_bad(bad)).alias("bad_share"), F.count(F.lit(1)).alias("n"))


def top_fields(importance: DataFrame, number: int = 4, excluded: tuple[str, ...] = EXCLUDED) -> list[str]:
    """The ``number`` fields with the most important features, those excluded left out. What comes after the first
    ``_`` of a feature is not part of its field; of fields as important the first by name."""
    field = F.substring_index("feature", "_", 1).alias("field")
    rows = importance.groupBy(field).agg(F.max("importance").alias("most")).filter(~F.col("field").isin(*excluded))
    return [r["field"] for r in rows.orderBy(F.desc("most"), "field").limit(number).collect()]


def interaction_tables(df: DataFrame, fields: list[str], bad: list[int] = (2, 3, 4, 5), number: int = 7) -> DataFrame:
    """(field_a, field_b, bucket_a, bucket_b, bad_share, n) of all pairs of ``fields``, in one pass over the rows."""
    df = bucketed(df, fields, number)
    cells = [F.struct(F.lit(a).alias("field_a"), F.lit(b).alias("field_b"), F.col(f"{a}_bucket").alias("bucket_a"), F.col(f"{b}_bucket").alias("bucket_b")) for a, b in combinations(fields, 2)]
    each = df.select(_is_bad(bad).alias("bad"), F.inline(F.array(*cells)))
    return each.groupBy("field_a", "field_b", "bucket_a", "bucket_b").agg(F.avg("bad").alias("bad_share"), F.count(F.lit(1)).alias("n"))


def bootstrap(df: DataFrame, fraction: float = 0.2, seed: int = 7) -> DataFrame:
    return df.sample(True, fraction, seed)
