"""Removal of repeated byte strings, found by suffix arrays of shards.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in the table. To bring equal
strings together, every window of ``length`` bytes is filed under its anchor: the ``gram``-byte substring with the
least hash. Equal windows have equal anchors at equal places, so an anchor seen once rules its windows out, and the
windows of one anchor make one context of a few hundred bytes. Contexts of anchors seen twice or more go to shards
by anchor; each shard sorts its suffixes by induced sorting, computes permuted common prefixes, and so finds the
window starts that have an equal. Equal contexts are counted first; a shard gets two copies of those at most.

Anchors with more than ``most`` different contexts (a line or passage that very many documents share) are dealt
anew: their windows are filed by narrow ranges of the distance to the anchor, under the hash of the bytes that all
windows of the range share, and in a last step by the whole window. So no shard gathers an unbounded group.

Defined cases: a null text is empty; repeated rows repeat each other's strings; null ids are allowed; matches never
cross documents; other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .scratch import recorded, release, written
from .suffix_array import permuted_lcp, suffix_array
from .text import mix

LENGTH, GRAM, MOST = 400, 128, 256
#: Widths of the ranges that contexts of very frequent anchors are dealt by, one after the other.
RANGES = (16, 1)
_PIECE = 1 << 19
_SHARD = 2 << 20
_U = np.uint64
_BASE = 0xD1342543DE82EF95
_BUCKETS = 1 << 20
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to the power ``n`` at least."""
    size = max(1 << 12, 1 << int(n).bit_length())
    if size not in _tables:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.ones(1, _U)
            while len(p) < size:
                p = np.concatenate((p, p * _U(pow(base, len(p), 1 << 64))))
            out.append(p)
        _tables[size] = tuple(out)
    return _tables[size]


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


def _prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums whose differences, times the inverse power of their start, are hashes of substrings."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
    return total, down


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    size, m = 1, x
    while size * 2 <= width:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    return np.minimum(m[: len(x) - width + 1], m[width - size : width - size + len(x) - width + 1])


def contexts(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Of texts laid end to end (``ends``), below 2**20 bytes in all: (anchor hash, context hash, first start,
    number of starts, place of the anchor after the first start) of each context."""
    if len(data) < length:
        return [np.zeros(0, np.int64)] * 5
    total, down = _prefix_hash(data)
    m = len(data) - gram + 1
    grams = mix((total[gram:] - total[:m]) * down[:m])
    keyed = (grams & ~_U(0xFFFFF)) | np.arange(m, dtype=_U)
    anchor = (_least(keyed, length - gram + 1) & _U(0xFFFFF)).astype(np.int64)
    n = len(anchor)
    bounds = np.concatenate(([0], ends))
    sizes = np.diff(bounds)
    limit = np.repeat(ends, sizes)[:n]
    valid = np.arange(n) + length <= limit
    text = np.repeat(np.arange(len(sizes)), sizes)[:n]
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1] | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return [np.zeros(0, np.int64)] * 5
    stop = np.flatnonzero(valid & ~np.append(valid[1:] & ~new[1:], False)) + 1
    a = anchor[first]
    whole = mix((total[stop - 1 + length] - total[first]) * down[first])
    return grams[a].view(np.int64), whole.view(np.int64), first, stop - first, a - first


def repeated_starts(parts: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """Of each part, those of its first ``starts`` places at which a string starts that starts in another place too."""
    lens = np.array([len(p) for p in parts])
    flat = np.frombuffer(b"\0".join(parts), np.uint8)
    t = np.empty(len(flat) + 1, np.uint16)
    t[:-1] = flat
    t[:-1] += 2
    at = np.concatenate(([0], np.cumsum(lens + 1)[:-1]))
    t[at[1:] - 1], t[-1] = 1, 0
    sa = suffix_array(t, 258)
    lcp = permuted_lcp(t, sa)[sa]
    n = np.minimum(np.array(starts), lens - length + 1).clip(0)
    valid = np.zeros(len(t), bool)
    step = np.zeros(len(t) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    valid = np.cumsum(step)[:-1] > 0
    same = np.cumsum(lcp < length)
    mine = valid[sa]
    count = np.bincount(same[mine], minlength=same[-1] + 1)
    found = np.zeros(len(t), bool)
    found[sa[mine & (count[same] > 1)]] = True
    return [np.flatnonzero(found[b : b + k]) for b, k in zip(at.tolist(), n.tolist())]


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    if not len(x):
        return []
    edge = np.flatnonzero(np.diff(x) != 1)
    return list(zip(x[np.append(0, edge + 1)].tolist(), x[np.append(edge, len(x) - 1)].tolist()))


_OCC = "fp long, ctx long, n long, rel long, lo long, did long, th long, w long"


def _occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[np.ndarray, int, int]] = []
            size = 0
            for k in range(batch.num_rows):
                raw = batch.column(2)[k].as_buffer()
                data = np.frombuffer(raw, np.uint8) if raw is not None and len(raw) >= length else None
                if data is None:
                    continue
                for p in range(0, len(data) - length + 1, _PIECE):
                    part = data[p : p + _PIECE + length - 1]
                    if size + len(part) >= 1 << 20:
                        yield out(batch, held)
                        held, size = [], 0
                    held.append((part, k, p))
                    size += len(part)
            if held:
                yield out(batch, held)

    def out(batch: pa.RecordBatch, held) -> pa.RecordBatch:
        ends = np.cumsum([len(d) for d, _, _ in held])
        fp, ctx, first, n, rel = contexts(np.concatenate([d for d, _, _ in held]), ends, length, gram)
        which = np.searchsorted(ends, first, side="right")
        row, begin = np.array([k for _, k, _ in held])[which], np.array([p for _, _, p in held])[which]
        lo = first - np.concatenate(([0], ends))[which] + begin
        did, th = batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))
        cols = [pa.array(x, pa.int64()) for x in (fp, ctx, n, rel, lo)]
        return pa.RecordBatch.from_arrays([*cols, did, th, pa.array(np.ones(len(fp), np.int64))], names=["fp", "ctx", "n", "rel", "lo", "did", "th", "w"])

    return docs.mapInArrow(run, _OCC)


def _distinct(occ: DataFrame) -> DataFrame:
    """Different contexts of the anchors seen twice or more: one place of each, how often (``w``) and how many the
    anchor has (``g``). Equal contexts are counted first, by a hash of their own and before they are moved, so that no
    anchor's rows meet in one task, however many texts share it."""
    one = lambda *names: [F.first(c).alias(c) for c in names]  # noqa: E731  of one and the same row
    whole = F.xxhash64("fp", "ctx", "n", "rel").alias("whole")
    keys = occ.groupBy(whole, "ctx").agg(*one("fp", "n", "rel", "did", "th", "lo"), F.sum("w").alias("w")).drop("whole")
    anchors = keys.groupBy("fp").agg(F.count(F.lit(1)).alias("g"), F.sum("w").alias("seen")).filter("seen > 1").drop("seen")
    return written(keys.join(anchors, "fp"))


def _with_texts(owners: DataFrame, docs: DataFrame) -> DataFrame:
    """A row per document that owns contexts: its bytes and their list. Texts are thinned out by hash buckets of
    their ids first, of a fixed number, all broadcast."""
    bucket = lambda: F.pmod(F.xxhash64("did", "th"), F.lit(_BUCKETS)).alias("bucket")
    near = docs.withColumn("bucket", bucket()).join(F.broadcast(owners.select(bucket()).distinct()), "bucket", "left_semi").drop("bucket")
    lists = owners.groupBy("did", "th").agg(F.collect_list(F.struct("fp", "ctx", "n", "rel", "w", "lo")).alias("list"))
    return lists.join(near, ["did", "th"]).select("text", "list", "did", "th")


def _cut_out(owned: DataFrame, length: int) -> DataFrame:
    """The bytes of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw, rows = batch.column(0)[k].as_buffer().to_pybytes(), batch.column(1)[k].as_py()
                cols = [pa.array([r[c] for r in rows], pa.int64()) for c in ("fp", "ctx", "n", "w")]
                text = pa.array([raw[r["lo"] : r["lo"] + r["n"] - 1 + length] for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([*cols, text], names=["fp", "ctx", "n", "w", "part"])

    return owned.mapInArrow(run, "fp long, ctx long, n long, w long, part binary")


def _in_shards(parts: DataFrame, length: int) -> DataFrame:
    """(fp, ctx, runs): runs of repeated window starts, counted from the context's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            texts = [r[4] for r in held for _ in range(2 if r[3] > 1 else 1)]
            starts = [r[2] for r in held for _ in range(2 if r[3] > 1 else 1)]
            found = iter(repeated_starts(texts, starts, length))
            rows = []
            for r in held:
                x = next(found)
                if r[3] > 1:
                    next(found)
                if len(x):
                    rows.append((r[0], r[1], [{"lo": lo, "hi": hi} for lo, hi in _runs(x)]))
            cols = list(zip(*rows)) or [[]] * 3
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["fp", "ctx", "runs"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > _SHARD and row[0] != last:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                last = row[0]
                size += len(row[4]) * (2 if row[3] > 1 else 1)
        if held:
            yield flush()

    return parts.repartition("fp").sortWithinPartitions("fp").mapInArrow(run, "fp long, ctx long, runs array<struct<lo: long, hi: long>>")


def _dealt_anew(owned: DataFrame, length: int, width: int) -> DataFrame:
    """Occurrences by ranges of ``width`` distances to the anchor, under the hash of the bytes the range shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = batch.column(0)[k].as_buffer()
                data = np.frombuffer(raw, np.uint8)
                did, th, rows = batch.column(2)[k].as_py(), batch.column(3)[k].as_py(), []
                for r in batch.column(1)[k].as_py():
                    s = 0
                    while s < r["n"]:
                        rel = r["rel"] - s
                        count = min(r["n"] - s, rel % width + 1)
                        top = rel - rel % width  # distances from top to top + width - 1
                        core_from = r["lo"] + r["rel"] - top
                        core = data[core_from : core_from + length - width + 1].tobytes()
                        lo = r["lo"] + s
                        fp = xxhash.xxh3_64_intdigest(core, (r["fp"] ^ (top * 0x9E3779B97F4A7C15)) & (2**64 - 1)) - 2**63
                        ctx = xxhash.xxh3_64_intdigest(data[lo : lo + count - 1 + length].tobytes(), rel) - 2**63
                        rows.append((fp, ctx, count, rel, lo, did, th, r["w"], r["fp"], r["ctx"], s))
                        s += count
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["fp", "ctx", "n", "rel", "lo", "did", "th", "w", "pfp", "pctx", "off"])

    return owned.mapInArrow(run, _OCC + ", pfp long, pctx long, off long")


def _found(occ: DataFrame, docs: DataFrame, length: int, most: int, ranges: tuple[int, ...]) -> DataFrame:
    """(fp, ctx, runs) of all contexts of ``occ`` with repeated starts: one row each."""
    keys = _distinct(occ)
    release(docs.sparkSession)
    cold = keys.filter(F.col("g") <= most) if ranges else keys
    out = _in_shards(_cut_out(_with_texts(cold, docs), length), length)
    hot = keys.filter(F.col("g") > most)
    if not ranges or hot.isEmpty():
        return out
    narrow = written(_dealt_anew(_with_texts(hot, docs), length, ranges[0]))
    found = _found(narrow.drop("pfp", "pctx", "off"), docs, length, most, ranges[1:])
    back = narrow.select("fp", "ctx", "pfp", "pctx", "off").join(found, ["fp", "ctx"])
    moved = F.transform("runs", lambda r: F.struct((r["lo"] + F.col("off")).alias("lo"), (r["hi"] + F.col("off")).alias("hi")))
    return out.unionByName(back.groupBy(F.col("pfp").alias("fp"), F.col("pctx").alias("ctx")).agg(F.flatten(F.collect_list(moved)).alias("runs")))


_SPANS = "array<struct<lo: bigint, hi: bigint>>"


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``spans`` (removed runs of bytes, from and to), ``kept``, the other bytes, and
    ``text``, the whole characters of these. The id may be of any type that has a hash, also a struct of columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    # a row is known by the hashes of its id and of both; rows alike in both are one document that is there twice
    rows = rows.select("id", F.xxhash64("id").alias("did"), F.xxhash64("id", "text").alias("th"), F.col("text").cast("binary").alias("text"))
    keyed = rows.drop("id")
    with recorded() as made:
        occ = written(_occurrences(keyed.select("did", "th", "text"), length, gram))
        found = _found(occ, keyed, length, most, RANGES)
        spans = occ.select("fp", "ctx", "did", "th", F.col("lo").alias("at")).join(found, ["fp", "ctx"])
        lists = written(spans.groupBy("did", "th").agg(F.array_sort(F.collect_list(F.struct("at", "runs"))).alias("list")))
    release(docs.sparkSession, *(t for t in made if t is not lists))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                n_bytes, spans_, kept, whole = [], [], [], []
                for raw, ranges in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    runs: list[list[int]] = []
                    for lo, hi in sorted((c["at"] + r["lo"], c["at"] + r["hi"] + length) for c in ranges for r in c["runs"]):
                        if runs and lo <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], hi)
                        else:
                            runs.append([lo, hi])
                    edges = [0, *(x for run in runs for x in run), len(raw)]
                    pieces = [raw[a:b] for a, b in zip(edges[::2], edges[1::2])]
                    n_bytes.append(len(raw))
                    kept.append(b"".join(pieces))
                    whole.append("".join(p.decode("utf-8", "ignore") for p in pieces))
                    spans_.append([{"lo": a, "hi": b} for a, b in runs])
                kinds = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
                arrays = [part.column(0), pa.array(n_bytes, pa.int64()), pa.array(spans_, kinds), pa.array(kept, pa.binary()), pa.array(whole, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_bytes", "spans", "kept", "text"])

    bucket = F.pmod(F.xxhash64("did", "th"), F.lit(_BUCKETS)).alias("bucket")
    marked = F.broadcast(lists.select(bucket).distinct())
    tagged = rows.withColumn("bucket", bucket)
    schema = StructType([StructField("id", docs.schema[id_col].dataType), *StructType.fromDDL(f"n_bytes long, spans {_SPANS}, kept binary, text string")])
    touched = tagged.join(marked, "bucket", "left_semi").join(lists, ["did", "th"], "left")
    none = F.array().cast(f"array<struct<at: bigint, runs: {_SPANS}>>")
    touched = touched.select("id", "text", F.coalesce("list", none).alias("list")).mapInArrow(cut, schema)
    whole = tagged.join(marked, "bucket", "left_anti").select("id", F.length("text").cast("long").alias("n_bytes"), F.array().cast(_SPANS).alias("spans"), F.col("text").alias("kept"), F.col("text").cast("string").alias("text"))
    return touched.unionByName(whole).withColumnRenamed("id", id_col)
