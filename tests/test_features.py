"""Regressor flags, buckets and interaction tables: rules on small rows, and queries against their SQL twins."""
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loanloom.operators import features

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["f1_regressor_profile", "f1_encoded", "f3_f4_interactions", "f4_interaction_tables"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, D).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    text = lambda df: sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))
    assert text(got) == text(want)


def test_encode_rules(spark):
    rows = [("x" if k else "y", "u", None if k < 17 else "v", "ab"[k % 2], float(k), None if k < 4 else "w") for k in range(20)]
    df = spark.createDataFrame(rows, "most string, one string, sparse string, two string, wide double, holes string")
    out = features.encode(df, df.columns)
    new = [c for c in out.columns if c not in df.columns]
    # one value gives no flag; of two equally frequent values the greater stays; a mostly null field has its null flag only
    assert new == ["most_is_x", "sparse_null", "two_is_b", *(f"wide_p{k}" for k in range(0, 80, 10)), "holes_null"]
    total = out.groupBy().sum(*new).first()
    assert [total[f"sum({c})"] for c in new] == [19, 17, 10, *[2] * 8, 4]


def test_encode_empty(spark):
    df = spark.createDataFrame([], "a string, b double")
    assert features.encode(df, ["a", "b"]).columns == ["a", "b"]


def test_buckets_take_nulls_and_the_greatest_first(spark):
    df = spark.createDataFrame([(float(k), None if k == 3 else "pq"[k % 2]) for k in range(15)] + [(None, "q")], "x double, y string")
    got = {r["x"]: (r["x_bucket"], r["y_bucket"]) for r in features.bucketed(features.bucketed(df, "x"), "y").collect()}
    assert got == {**{float(k): (k // 2 if k < 14 else 0, k % 2 if k != 3 else 0) for k in range(15)}, None: (0, 1)}


def test_top_fields_and_their_tables(spark):
    marks = [("a_is_1", 0.1), ("b", 0.3), ("a_p10", 0.4), ("vehicleManufacturerName_is_x", 0.9), ("d", 0.3), ("c_null", 0.2), ("e", 0.0)]
    fields = features.top_fields(spark.createDataFrame(marks, "feature string, importance double"))
    assert fields == ["a", "b", "d", "c"]
    rows = [(k % 2, k % 3, k % 4, "z", None if k == 0 else k % 7) for k in range(30)]
    got = features.interaction_tables(spark.createDataFrame(rows, "a int, b int, d int, c string, monthsDelinquent int"), fields).collect()
    want = {}
    for r in rows:
        values = dict(zip("abdc", (*r[:3], 0)))
        for x, y in ("ab", "ad", "ac", "bd", "bc", "dc"):
            want.setdefault((x, y, values[x], values[y]), []).append(float(r[4] in (2, 3, 4, 5)))
    assert {tuple(r)[:4]: (pytest.approx(r["bad_share"]), r["n"]) for r in got} == {k: (sum(v) / len(v), len(v)) for k, v in want.items()}


def test_forest_is_fitted_on_counted_patterns(spark, monkeypatch):
    """Rows with the same columns are one row with a count, so that nothing of the size of rows times trees is kept."""
    kept = []
    monkeypatch.setattr(features, "stored", lambda df: kept.append(df.localCheckpoint()) or kept[-1])
    rows = spark.range(6000).selectExpr(
        "'t' securitizationKey", "cast(id as string) assetNumber", "cast(id % 3 as double) kind", "cast(xxhash64(id) % 1000 as double) noise",
        "case when id % 3 = 1 and xxhash64(id, 1) % 10 < 8 then 2 when id = 5 then null else 0 end monthsDelinquent")
    found, area = features.importances(rows, ["kind", "noise"], trees=4)
    (patterns,) = kept
    assert patterns.agg(F.sum("n")).first()[0] == 6000 and patterns.count() <= 3 * 32 * 2 * 2
    assert found.first()["feature"] == "kind" and found.first()["importance"] > 0.9 and area > 0.85
    taken = features._drawn(patterns.filter("not held"), 0, 7).agg(F.sum("taken"), F.sum("n")).first()
    assert 4500 < taken[0] < 5100  # as many rows as there are, by chance
