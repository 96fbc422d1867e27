"""Words, hashes and readers shared by the text operators."""
from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Distinct words one Python worker remembers before it starts again; a memory bound, results do not depend on it.
CACHE_WORDS = 300_000
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Hash buckets by which large rows are thinned out before a join; at most this many numbers are broadcast.
_BUCKETS = 1 << 20


def fresh(rows: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``rows`` does not have; Spark takes names that differ in case for one."""
    held = {c.lower() for c in rows.columns}
    while name.lower() in held:
        name += "_"
    return name


def quoted(column: str) -> Column:
    """A column by its whole name, whatever signs are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def nullable(kind: DataType) -> DataType:
    """The type with nulls allowed in all fields."""
    return StructType([StructField(f.name, nullable(f.dataType)) for f in kind.fields]) if isinstance(kind, StructType) else kind


def _bucket(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(_BUCKETS))


def thinned(rows: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """The rows whose key columns may be in ``wanted``, so that a following join moves few others."""
    at = fresh(rows, "bucket")
    near = F.broadcast(wanted.select(_bucket(*columns).alias(at)).distinct())
    return rows.withColumn(at, _bucket(*columns)).join(near, at, "left_semi").drop(at)


def without(rows: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """The rows whose ``columns`` (never null) are not in ``keys``; rows of other hash buckets are not moved."""
    at = fresh(rows, "bucket")
    near, tagged = F.broadcast(keys.select(_bucket(*columns).alias(at)).distinct()), rows.withColumn(at, _bucket(*columns))
    far = tagged.join(near, at, "left_anti")
    close = tagged.join(near, at, "left_semi").join(keys.select(*columns).distinct(), list(columns), "left_anti")
    return far.unionByName(close.select(*map(quoted, tagged.columns))).drop(at)


def least_count(counted: DataFrame, limit: int, count: str = "n") -> int:
    """A count that no more than ``limit`` rows reach: the least at steps of about 1 %.

    The driver gets 64 numbers of rows for each power of two, however many different counts there are."""
    step = F.floor(64 * F.log2(count)).alias("step")
    held = counted.groupBy(step).agg(F.count(F.lit(1)).alias("rows"), F.min(count).alias("least")).toArrow().to_pandas().sort_values("step", ascending=False)
    fit = held[held["rows"].cumsum() <= limit]
    return int(fit["least"].min()) if len(fit) else 1 << 62


def most_frequent(counted: DataFrame, limit: int, count: str = "n") -> DataFrame:
    """The rows with the greatest counts: as many counts from the top as give no more than ``limit`` rows."""
    return counted.filter(F.col(count) >= least_count(counted, limit, count))


def words(text: str | None, lower: bool = True) -> list[bytes]:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]``; ``lower`` folds A-Z only. Null gives none.

    ``bytes.split`` and ``bytes.lower`` know exactly these six separators and ASCII letters.
    """
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class Memo(dict):
    """A bounded memo of a function of one argument."""

    def __init__(self, function, limit: int = CACHE_WORDS):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


def word_hashes(memo: Memo, tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, tokens), _U, len(tokens))


def hash_memo() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that any bits of the result can serve as a bucket."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


#: Odd multiplier of the rolling word-window hash.
STEP = 0x9E3779B97F4A7C15


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` words; a shorter text is one window, an empty one has none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(width, n)
    out = np.zeros(n - size + 1, _U)
    for k in range(size):
        out *= _U(STEP)
        out += hashes[k : n - size + 1 + k]
    return mix(out + _U(size))
