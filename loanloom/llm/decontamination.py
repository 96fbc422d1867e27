"""Benchmark decontamination by latent semantic retrieval.

Texts are read once and kept as numbers of the benchmark's words, which is all that later passes need. Passages are
TF-IDF vectors over these words; words outside the benchmark only add to a passage's length, at the mean weight. A randomised SVD of the
corpus passages and the benchmark's own gives a latent basis: one pass over all documents sums the products of their
sparse rows with a small dense matrix. A last pass projects sliding windows of every document, of about each item's
size, takes those whose cosine with an item reaches the item's gate, and checks all of these, best first, until one
passes, by the longest common subsequence of words: at least ``exact`` of the item, or ``loose`` of it with
``answer`` of its last part, where the answer stands. A bound by word counts spares most windows that would not pass.

A gate is the cosine that the least passage of the rule would have, ``least_cosine`` at most, so an item whose words are
common in the corpus gets a lower one. Words in more than ``common`` of all passages weigh nothing in the vectors. Items of
which few words weigh anything, or that no gate could tell from other texts, are searched exactly instead: the same
windows of all documents that hold enough of the item's words are checked, whatever their cosine.

The benchmark is the query set: it is taken in blocks of ``block_items`` items, each against all documents.

Defined cases: null and empty texts match nothing; items without a word are skipped; repeated rows are reported
each, of one document and item the window with the greatest cosine that passes, of ties the first; null document ids
are reported as null; an empty benchmark or an empty table of documents gives an empty result.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .dense_sums import per_partition
from .scratch import release, written

PASSAGE = 32
#: Signs that part words, apart from white space.
_SIGNS = b".,;:!?\"'()[]{}|<>*#$%&-_/\\"
_PLAIN = bytes.maketrans(_SIGNS, b" " * len(_SIGNS))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Words without case (A-Z) and signs."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).translate(_PLAIN).split()


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    places: dict = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def widths(sizes: list[int]) -> list[int]:
    """For each item, a window of its size or up to half as much more: few different ones."""
    out = []
    for n in sizes:
        w = 8
        while w < n:
            w = w * 3 // 2 if w & (w - 1) == 0 else w * 4 // 3
        out.append(w)
    return out


class Items:
    """A block of benchmark items and the words they are made of."""

    def __init__(self, rows: list[tuple]):
        found = [(k, plain_words(t)) for k, t in rows]
        self.ids = [k for k, w in found if w]
        self.words = [w for _, w in found if w]
        self.widths = widths([len(w) for w in self.words])
        self.columns = {w: k for k, w in enumerate(sorted({x for w in self.words for x in w}))}
        self.idf = np.zeros(len(self.columns) + 1)
        self.basis = np.zeros((len(self.columns), 0))
        self.gates = np.zeros(len(self.words))
        self.light = np.zeros(len(self.words), bool)

    @property
    def kind(self) -> type:
        return np.uint16 if len(self.columns) < 1 << 16 else np.uint32

    def coded(self, text: str | None) -> bytes:
        """The columns of a text's words, end to end; the last column is that of any other word."""
        split = plain_words(text)
        return np.fromiter(map(self.columns.get, split, repeat(len(self.columns))), self.kind, len(split)).tobytes()

    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.words), len(self.columns)))
        for k, w in enumerate(self.words):
            np.add.at(out[k], [self.columns[x] for x in w], 1)
        return out * self.idf[:-1]


    def set_gates(self, least_cosine: float, share: float) -> None:
        """The cosine that windows must reach, item by item: what is left to a passage that has ``share`` of the item's
        weight, the words lost at a window's edges taken off, and other words for the rest; ``least_cosine`` at most. An item
        whose gate would let everything pass, or of which few words weigh anything, is searched without one."""
        other, few = self.idf[-1] ** 2, np.zeros(len(self.words), bool)
        for k, (own, w) in enumerate(zip(self.words, self.widths)):
            at = np.array([self.columns[x] for x in own])
            _, back, times = np.unique(at, return_inverse=True, return_counts=True)
            weight = self.idf[at] ** 2
            lost = max(0, -(-(max(1, w // 4) - (w - len(own))) // 2))
            held = share * (len(own) - lost) / len(own)
            mass = held * weight.sum() + (w - held * len(own)) * other
            few[k] = (weight > 0).mean() < 0.3
            product = (weight * times[back]).sum()
            found = 0.85 * held * product / max(1e-12, math.sqrt(product * mass))
            self.gates[k] = min(least_cosine, found)
        self.light = (self.gates < 0.05) | few


def _passages(sizes: np.ndarray) -> np.ndarray:
    """The passage of each word: runs of PASSAGE words that end with their text."""
    starts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    first = (place % PASSAGE == 0).astype(np.int64)
    return np.cumsum(first) - 1


def _coded(docs: DataFrame, items: Items) -> DataFrame:
    """(id, words): texts as columns of their words; all that later passes read."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value.coded
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([code(t) for t in batch.column(1).to_pylist()], pa.binary())], names=["id", "words"])

    return docs.mapInArrow(run, StructType([docs.schema["id"], *StructType.fromDDL("words binary")]))


def _parts(column: pa.Array, kind: type) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of an Arrow batch of coded texts: the first row, the words laid end to end, and the sizes."""
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // np.dtype(kind).itemsize
    flat = np.frombuffer(column.buffers()[2], kind) if edges[-1] else np.zeros(0, kind)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + 150_000, "right")) - 1)
        yield start, flat[edges[start] : edges[stop]], np.diff(edges[start : stop + 1])
        start = stop


def _weigh(coded: DataFrame, items: Items, common: float) -> None:
    """Inverse passage frequencies, from all documents."""

    def add(batch: pa.RecordBatch, arrays: list[np.ndarray]) -> None:
        other = len(items.columns)
        for _, at, sizes in _parts(batch.column(0), items.kind):
            if not len(at):
                continue
            lines = -(-sizes // PASSAGE)
            first = np.cumsum(lines) - lines
            table = np.full((int(lines.sum()), PASSAGE), other, items.kind)
            table.reshape(-1)[np.arange(len(at)) + np.repeat(first * PASSAGE - (np.cumsum(sizes) - sizes), sizes)] = at
            table.sort(axis=1)
            new = np.ones(table.shape, bool)
            new[:, 1:] = table[:, 1:] != table[:, :-1]
            arrays[0] += np.bincount(table[new], minlength=other + 1)[:other]
            arrays[1] += len(table)

    frequency, total = per_partition(coded.select("words"), add, [(len(items.columns),), (1,)])
    n = total[0] + len(items.words)
    idf = np.log((n + 1) / (frequency + 1))
    idf[frequency > common * n] = 0.0
    # a word outside the benchmark weighs as one of the benchmark does on the whole: the replaced words of a reworded
    # passage must not outweigh those it kept
    items.idf = np.append(idf, math.sqrt(float((idf[idf > 0] ** 2).mean())) if idf.any() else 1.0)


def _factor(coded: DataFrame, items: Items, rank: int, extra: int, seed: int) -> None:
    """The latent basis: randomised SVD of all passages and, as heavy as these, the benchmark's."""
    spark, columns = coded.sparkSession, len(items.columns)
    rank = min(rank, columns)
    size = min(columns, rank + extra)
    own = items.matrix()

    def product(right: np.ndarray) -> np.ndarray:
        """Gram matrix of the passages times ``right``."""
        light = items.idf.astype(np.float32)
        inside = (items.idf > 0) & (np.arange(columns + 1) < columns)
        shared = spark.sparkContext.broadcast(right.astype(np.float32) * light[:-1, None])

        def add(batch: pa.RecordBatch, arrays: list[np.ndarray]) -> None:
            for _, at, sizes in _parts(batch.column(0), items.kind):
                use = np.flatnonzero(inside[at])
                if not len(use):
                    continue
                passage, at_ = _passages(sizes)[use], at[use]
                new = np.concatenate(([True], passage[1:] != passage[:-1]))
                dense = np.add.reduceat(shared.value[at_], np.flatnonzero(new), axis=0)
                by = np.argsort(at_, kind="stable")
                word = at_[by]
                start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
                arrays[0][word[start]] += np.add.reduceat(dense[(np.cumsum(new) - 1)[by]], start, axis=0) * light[word[start], None]
                arrays[1] += float((dense**2).sum())

        corpus, energy = per_partition(coded.select("words"), add, [(columns, right.shape[1]), (1,)])
        mine = own @ right
        balance = energy[0] / max(1e-9, float((mine**2).sum())) if energy[0] else 1.0
        return corpus + max(1.0, balance) * (own.T @ mine)

    # one pass: the Gram matrix is positive, so its products with a random basis give its leading vectors (Nystrom)
    start, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((columns, size)))
    y = product(start)
    shift = 1e-7 * np.linalg.norm(y)
    y += shift * start
    core = start.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > 1e-12 * values.max(initial=1e-300)
    left, _, _ = np.linalg.svd(y @ vectors[:, keep] / np.sqrt(values[keep]), full_matrices=False)
    items.basis = left[:, :rank].astype(np.float32)


class Passage:
    """What passages have of an item: its words and, of these, the last part, where the answer stands."""

    def __init__(self, own: list[int], columns: int, limits: tuple[float, float, float]):
        self.own, self.tail, (self.exact, self.loose, self.answer) = own, own[-max(1, len(own) // 4) :], limits
        words, self.times = np.unique(own, return_counts=True)
        self.local = np.full(columns + 1, len(words))
        self.local[words] = np.arange(len(words))
        self.least = min(self.exact, self.loose) * len(own) - 1e-9

    def check(self, words: np.ndarray, start: int, w: int) -> tuple[float, float] | None:
        """The shares of the item and of its last part that the window and its margins have in order, if enough."""
        margin = w // 4 + 1
        window = words[max(0, start - margin) : start + w + margin]
        # no common subsequence is longer than what both have of each word
        if np.minimum(np.bincount(self.local[window], minlength=len(self.times) + 1)[:-1], self.times).sum() < self.least:
            return None
        window = window.tolist()
        share = common_subsequence(self.own, window) / len(self.own)
        if share < min(self.exact, self.loose):
            return None
        last = common_subsequence(self.tail, window) / len(self.tail)
        return (share, last) if share >= self.exact or share >= self.loose and last >= self.answer else None


def _search(coded: DataFrame, items: Items, limits: tuple[float, float, float]) -> DataFrame:
    exact, loose, answer = limits
    shared = coded.sparkSession.sparkContext.broadcast(items)
    item_type = pa.int64() if all(isinstance(i, int) for i in items.ids) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it = shared.value
        latent = it.matrix() @ it.basis
        length = np.linalg.norm(latent, axis=1)
        whole = np.linalg.norm(it.matrix(), axis=1)
        # a full match of an item reaches the share of the item that the basis holds
        unit = latent / np.maximum(length**2 / np.maximum(whole, 1e-9), 1e-9)[:, None]
        groups = [(w, np.flatnonzero((np.array(it.widths) == w) & ~it.light)) for w in sorted(set(it.widths))]
        groups = [(w, members) for w, members in groups if len(members)]
        units = {w: np.ascontiguousarray(unit[members].T.astype(np.float32)) for w, members in groups}
        member = np.zeros(len(it.columns) + 1, bool)
        columns = len(it.columns)
        codes = [[it.columns[x] for x in w] for w in it.words]
        passages = [Passage(own, columns, (exact, loose, answer)) for own in codes]
        square = it.idf**2
        within = np.append(square[:-1], 0.0)
        weighed = np.concatenate((it.basis * it.idf[:-1, None].astype(np.float32), np.zeros((1, it.basis.shape[1]), np.float32)))
        # a window's cosine with few items is the sum of its words' own parts of it
        small = {w: len(members) < weighed.shape[1] for w, members in groups}
        tables = {w: weighed @ units[w] if small[w] else weighed for w, _ in groups}
        for batch in batches:
            found: list[tuple] = []
            for base, at, sizes in _parts(batch.column(1), it.kind):
                if not len(at):
                    continue
                mass = np.concatenate(([0.0], np.cumsum(square[at])))
                inner = np.concatenate(([0.0], np.cumsum(within[at])))
                begin = np.cumsum(sizes) - sizes
                words = lambda doc: at[begin[doc] : begin[doc] + sizes[doc]]  # noqa: B023, E731

                def windows(w: int) -> tuple[np.ndarray, ...]:
                    """Text, first word in it, and bounds of all windows."""
                    step = max(1, w // 4)
                    count = np.where(sizes > 0, np.maximum(0, -(-(sizes - w) // step)) + 1, 0)
                    text = np.repeat(np.arange(len(sizes)), count)
                    place = (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)) * step
                    lo = begin[text] + place
                    return text, place, lo, np.minimum(lo + w, (begin + sizes)[text])

                def sums(table: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
                    """Sums of the table's rows over stretches of ``step`` words, and the first stretch of each text."""
                    count = -(-sizes // step)
                    first = np.cumsum(count) - count
                    grid = np.full((int(count.sum()) + 3, step), columns, np.int64)
                    grid.reshape(-1)[np.arange(len(at)) + np.repeat(first * step - begin, sizes)] = at
                    out = np.zeros((len(grid), table.shape[1]), np.float32)
                    for k in range(0, len(grid), 8192):
                        for column in grid[k : k + 8192].T:
                            out[k : k + 8192] += table[column]
                    return out, first

                def latent(lo: int, hi: int, item: int) -> float:
                    z = weighed[at[lo:hi]].sum(0) / np.sqrt(max(mass[hi] - mass[lo], 1e-9))
                    return float(z @ unit[item])

                for item in np.flatnonzero(it.light):
                    own, w = codes[item], it.widths[item]
                    text, place, lo, hi = windows(w)
                    member[:] = False
                    member[own] = True
                    held = np.concatenate(([0], np.cumsum(member[at])))
                    margin = w // 4 + 1
                    held = held[np.minimum(hi + margin, (begin + sizes)[text])] - held[np.maximum(lo - margin, begin[text])]
                    # no common subsequence is longer than the window's words of the item
                    near = np.flatnonzero(held >= min(exact, loose) * len(own) - 1e-9)
                    done = -1
                    for k in near[np.lexsort((place[near], -held[near], text[near]))]:
                        if text[k] == done:
                            continue
                        shares = passages[item].check(words(text[k]), int(place[k]), w)
                        if shares:
                            done = text[k]
                            found.append((base + int(done), it.ids[item], int(place[k]), latent(lo[k], hi[k], item), *shares))
                for w, members in groups:
                    text, place, lo, hi = windows(w)
                    gates = it.gates[members]
                    near = np.flatnonzero(inner[hi] - inner[lo] >= 0.5 * gates.min() ** 2 * (mass[hi] - mass[lo]))
                    near = near[inner[hi[near]] > inner[lo[near]]]
                    if not len(near):
                        continue
                    step = max(1, w // 4)
                    part, first = sums(tables[w], step)
                    at_ = first[text[near]] + place[near] // step
                    score = part[at_] + part[at_ + 1] * (hi[near] - lo[near] > step)[:, None]
                    for k in (2, 3):
                        score += part[at_ + k] * (hi[near] - lo[near] > k * step)[:, None]
                    score /= np.sqrt(np.maximum(mass[hi[near]] - mass[lo[near]], 1e-9))[:, None]
                    cosine = score if small[w] else score @ units[w]
                    asked: dict[tuple[int, int], list[tuple[float, int]]] = {}
                    for x, y in zip(*(v.tolist() for v in np.nonzero(cosine >= gates))):
                        k = near[x]
                        asked.setdefault((int(text[k]), int(members[y])), []).append((-float(cosine[x, y]), int(place[k])))
                    for (doc, item), places in asked.items():
                        for value, start in sorted(places):
                            shares = passages[item].check(words(doc), start, w)
                            if shares:
                                found.append((base + doc, it.ids[item], start, -value, *shares))
                                break
            cols = list(zip(*found)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], item_type), pa.array(cols[2], pa.int64()), *(pa.array(c, pa.float64()) for c in cols[3:])],
                names=["id", "item_id", "start_word", "cosine", "common", "answer"],
            )

    kinds = StructType.fromDDL(f"item_id {'long' if item_type == pa.int64() else 'string'}, start_word long, cosine double, common double, answer double")
    return coded.mapInArrow(run, StructType([coded.schema["id"], *kinds]))


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_items: int = 2000, rank: int = 128, extra: int = 16, common: float = 0.05, least_cosine: float = 0.45, exact: float = 0.8, loose: float = 0.6, answer: float = 0.5, seed: int = 7) -> DataFrame:
    """A row for each document and item found in it: where (``start_word``), the latent cosine, the shares of the
    item (``common``) and of its last part (``answer``) that the passage has in order."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")).dropna()
    blocks = max(1, -(-asked.count() // block_items))
    out = []
    for k in range(blocks):
        block = Items([tuple(r) for r in asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()])
        if not block.ids:
            continue
        coded = written(_coded(rows, block))
        _weigh(coded, block, common)
        block.set_gates(least_cosine, min(exact, loose))
        _factor(coded, block, rank, extra, seed)
        found = written(_search(coded, block, (exact, loose, answer)))
        release(docs.sparkSession, coded)
        out.append(found)
    kinds = StructType([rows.schema["id"], StructField("item_id", asked.schema["item"].dataType), *StructType.fromDDL("start_word long, cosine double, common double, answer double")])
    found = reduce(DataFrame.unionByName, out) if out else docs.sparkSession.createDataFrame([], kinds)
    return found.withColumnRenamed("id", id_col)
