"""Exact k-means by the Shallot search, on integer vectors.

Every vector remembers its centroid, its second-nearest one, and bounds on the distances to both. A round first moves
the bounds by how far centroids moved; a vector whose upper bound is below its lower bound, or below half the way to
the next centroid, keeps its centroid unseen. Others measure both remembered centroids and start from the closer one:
the neighbours of that centroid are scanned by their distance to it, within a ball that reaches from the vector as far
as the second-best found so far, and shrinks with it. What the ball lets through is compared in 64-bit integers, so
results are exact, ties included; floats only prune, with a margin far above their error.

A round is one pass: a task gives its vectors with their new state and one row of sums per centroid. These sums are
added up by Spark; ``k`` rows reach the driver, and the centroids, ``k`` times ``size`` numbers, go back to the tasks. The
states are written to the shared folder, a table per round, and the table before is deleted.

Defined cases: vectors that are null, of another size, or with null or non-finite components are left out. Components
beyond 2**27 after scaling count as 2**27, so that squared distances fit 64 bits. Null and repeated ids and repeated
rows are vectors of their own (a null id hashes as the empty text; equal hashes go by the components). With fewer vectors
than ``k`` each begins a cluster. An empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import discarded, written

_LIMIT = 1 << 27
_STATE = "vec_id long, body binary, a int, b int, upper double, lower double, n long, sums array<long>"
_ARROW = pa.schema([("vec_id", pa.int64()), ("body", pa.binary()), ("a", pa.int32()), ("b", pa.int32()), ("upper", pa.float64()), ("lower", pa.float64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
#: Relative margin of all float comparisons.
_SLACK = 1e-9


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    gap = x - c
    return np.einsum("ij,ij->i", gap, gap)


class Ring:
    """Centroids with every one's neighbours in the order of their distance."""

    def __init__(self, centroids: np.ndarray):
        self.centroids, k = centroids, len(centroids)
        squared = np.stack([_squared(centroids, c) for c in centroids])
        np.fill_diagonal(squared, -1)
        self.near = np.argsort(squared, axis=1, kind="stable")[:, 1:]
        self.far = np.sqrt(np.take_along_axis(squared, self.near, 1))
        self.half = self.far[:, 0] / 2 if k > 1 else np.full(k, np.inf)

    def search(self, x: np.ndarray, a: np.ndarray, b: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
        """Sets, in place, the nearest and second-nearest centroid of every row of ``x`` and the bounds. Returns how
        many distances to other than the remembered centroids were measured."""
        c, looked = self.centroids, 0
        if len(c) == 1:
            a[:], b[:] = 0, 0
            return looked
        bound = np.maximum(lower, self.half[a]) * (1 - _SLACK)
        rows = np.flatnonzero(~(upper < bound))
        to_a = _squared(x[rows], c[a[rows]])
        upper[rows] = np.sqrt(to_a)
        open_ = ~(upper[rows] < bound[rows])
        rows, to_a = rows[open_], to_a[open_]
        xs, first, second = x[rows], a[rows].copy(), b[rows].copy()
        best, next_ = to_a, _squared(xs, c[second])
        swap = (next_ < best) | ((next_ == best) & (second < first))
        first[swap], second[swap] = second[swap], first[swap]
        best[swap], next_[swap] = next_[swap], best[swap]
        centre, met, from_centre = first.copy(), second.copy(), np.sqrt(best)
        active = np.arange(len(rows))
        for t in range(len(c) - 1):
            reach = (from_centre[active] + np.sqrt(next_[active])) * (1 + _SLACK)
            active = active[self.far[centre[active], t] <= reach]
            if not len(active):
                break
            seen = self.near[centre[active], t]
            new = seen != met[active]
            at, j = active[new], seen[new]
            looked += len(at)
            d = _squared(xs[at], c[j])
            nearest = (d < best[at]) | ((d == best[at]) & (j < first[at]))
            w = at[nearest]
            next_[w], second[w] = best[w], first[w]
            best[w], first[w] = d[nearest], j[nearest]
            closer = ~nearest & ((d < next_[at]) | ((d == next_[at]) & (j < second[at])))
            w = at[closer]
            next_[w], second[w] = d[closer], j[closer]
        a[rows], b[rows], upper[rows], lower[rows] = first, second, np.sqrt(best), np.sqrt(next_)
        return looked


def _matrix(body: pa.Array, size: int) -> np.ndarray:
    joined = b"".join(body.to_pylist())
    return np.frombuffer(joined, "<i4").reshape(-1, size).astype(np.int64)


def _state(names: pa.Array, body: pa.Array, a, b, upper, lower) -> pa.RecordBatch:
    none = pa.nulls(len(a))
    return pa.RecordBatch.from_arrays([names, body, pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(upper), pa.array(lower), none.cast(pa.int64()), none.cast(pa.list_(pa.int64()))], schema=_ARROW)


def _kept(vectors: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """(vec_id, body) of the vectors that take part; ``body`` holds little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            right = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) == size
            batch = batch.filter(pa.array(right))
            # nulls come as not-a-number
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
            whole = np.isfinite(x).all(1)
            ints = np.clip(np.floor(scale * x[whole]), -_LIMIT, _LIMIT).astype("<i4")
            n, zero = len(ints), np.zeros(len(ints), np.int32)
            yield _state(batch.column(0).filter(pa.array(whole)), pa.array([r.tobytes() for r in ints], pa.binary()), zero, zero, np.full(n, np.inf), np.zeros(n))

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(run, _STATE)


def _round(state: DataFrame, centroids: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """The state after one assignment, with rows of sums (``n`` not null). ``moved``: how far centroids have moved since
    the state was made; None if it holds no bounds yet."""
    ring, (k, size) = Ring(centroids), centroids.shape
    others = None if moved is None else np.array([np.delete(moved, j).max(initial=0) for j in range(k)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            x = _matrix(batch.column(1), size)
            a, b = (batch.column(c).to_numpy().astype(np.int64) for c in (2, 3))
            upper, lower = (batch.column(c).to_numpy().copy() for c in (4, 5))
            if others is None:
                b = np.full(len(a), min(1, k - 1), np.int64)
            else:
                upper, lower = upper + moved[a], lower - others[a]
            ring.search(x, a, b, upper, lower)
            order = np.argsort(a, kind="stable")
            first = np.flatnonzero(np.diff(a[order], prepend=-1))
            if len(first):
                sums[a[order][first]] += np.add.reduceat(x[order], first)
            n += np.bincount(a, minlength=k)
            yield _state(batch.column(0), batch.column(1), a, b, upper, lower)
        some = np.flatnonzero(n)
        if len(some):
            none = pa.nulls(len(some))
            yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), none.cast(pa.binary()), pa.array(some, pa.int32()), none.cast(pa.int32()), none.cast(pa.float64()), none.cast(pa.float64()), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], schema=_ARROW)

    return state.filter("n IS NULL").mapInArrow(run, _STATE)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the clusters' means; empty clusters keep their centroid."""
    size, out = centroids.shape[1], centroids.copy()
    totals = state.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(size)]).alias("sums"))
    for r in totals.collect():
        out[r["a"]] = np.array(r["sums"], np.int64) // r["n"]
    return out


@dataclass
class Clustering:
    """``assigned``: vec_id, cluster, distance (squared). ``centroids``: cluster, n, inertia, centroid; one row of each."""

    assigned: DataFrame
    centroids: DataFrame


def cluster(vectors: DataFrame, k: int, *, rounds: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64, scale: int = 256, start_hash: Column | None = None) -> Clustering:
    """``rounds`` times: every vector to its nearest centroid, centroids to the floors of their clusters' means. Then all
    vectors are assigned once more. Centroids start from the ``k`` vectors with the least ``start_hash`` of ``vec_id``."""
    spark = vectors.sparkSession
    state = written(_kept(vectors, id_col, vector_col, size, scale))
    hashed = F.sha2(F.coalesce(F.col("vec_id").cast("string"), F.lit("")), 256) if start_hash is None else start_hash
    least = state.select(hashed.alias("hash"), "body").orderBy("hash", "body").limit(k).collect()
    centroids = np.array([np.frombuffer(r["body"], "<i4") for r in least], np.int64).reshape(-1, size)
    moved = None
    for r in range(rounds + 1 if len(least) else 0):
        after = written(_round(state, centroids, moved))
        discarded(state)
        state = after
        if r < rounds:
            new = _means(state, centroids)
            moved, centroids = np.sqrt(_squared(new, centroids)) * (1 + _SLACK), new

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = batch.column(2).to_numpy().astype(np.int64)
            d = _squared(_matrix(batch.column(1), size), centroids[a])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, pa.int32()), pa.array(d)], names=["vec_id", "cluster", "distance"])

    assigned = written(state.filter("n IS NULL").select("vec_id", "body", "a").mapInArrow(measure, "vec_id long, cluster int, distance long"))
    discarded(state)
    rows = spark.createDataFrame([(j, c.tolist()) for j, c in enumerate(centroids)], "cluster int, centroid array<long>")
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("inertia"))
    return Clustering(assigned, rows.join(sizes, "cluster", "left").select("cluster", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("inertia", F.lit(0)).alias("inertia"), "centroid"))
