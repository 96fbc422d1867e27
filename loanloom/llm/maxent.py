"""Language-model scores of a hashed maximum-entropy model.

A word has a class (by its ending) and a member number within it (by its hash). The model is
``P(class | h) P(member | class, h) P(word | class, member)``: two softmaxes over hashed features of the history h
(previous word, pair of previous classes, word before the previous one), and the share of the word's own count
in its member, add-``add`` smoothed with room for one unknown word. So it is a proper distribution over all words.

Texts are split once, into a table of word numbers (``numbered``) that counts, gradients and scores read. A word's
number is 59 bits of its hash and 5 bits of class; words of one number are taken for one word.

Training counts words and features over all training texts, starts the weights from the features' shrunk
information about the outcome, and then moves them by gradients (observed less expected feature counts, scaled by
the counts) that every partition sums over its texts; each of ``rounds`` steps takes another share of the texts, all
together take every text. Weights stay within ``_MOST``, so that scores can be held against the sum of their rows'
greatest weights instead of their own maximum.
Scoring gathers weight rows in numpy batches. Word counts are a table: its ``head`` most frequent words are sent to
the scorers, all others are joined.

Defined cases: null and empty texts are the end token alone; an empty training table leaves uniform softmaxes and
no known word; repeated rows are separate texts; null ids are allowed.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dense_sums import per_partition
from .scratch import release, written
from .text import Memo, mix, most_frequent, word_hashes, words

CLASSES, MEMBERS = 32, 32
ROWS1, ROWS2 = 1 << 14, 1 << 15
_PREVIOUS = 1 << 13
_SKIP = ROWS1 - _PREVIOUS - CLASSES * CLASSES
_CHUNK = 32768
_PART = 1 << 17
_MOST = 12.0
END = b""
_U = np.uint64


def number(word: bytes) -> int:
    """Hash and class of a word."""
    c = 0 if word == END else 1 + xxhash.xxh32_intdigest((word.rstrip(b".,;:!?") or word)[-3:]) % (CLASSES - 1)
    return xxhash.xxh3_64_intdigest(word) // CLASSES * CLASSES + c


def read_text(memo: Memo, text: str | None) -> np.ndarray:
    """Numbers of all tokens of a text, its end included; ``memo`` remembers ``number``."""
    return word_hashes(memo, [*words(text), END])


def outcomes(numbers: np.ndarray) -> np.ndarray:
    """Class and member of word numbers, as one."""
    return (numbers % _U(CLASSES) * _U(MEMBERS) + numbers // _U(CLASSES) % _U(MEMBERS)).astype(np.int64)


def numbered(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 5) -> DataFrame:
    """``id_col``, ``words`` (the word numbers of the whole text, 8 bytes each) and ``step`` (a share of the texts by the
    hash of the id, of ``rounds``), as a table written in folders by ``step``: a gradient reads its own folder only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(number)
        for batch in batches:
            body = pa.array([read_text(memo, t.as_py()).tobytes() for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], body], names=[id_col, "step", "words"])

    rows = docs.select(id_col, F.pmod(F.xxhash64(id_col), F.lit(rounds)).alias("step"), F.col(text_col).cast("string").alias("_text"))
    return written(rows.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, step long, words binary"), "step")


def features(numbers: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Rows of the class weights that are active at each token."""
    n, hashes = len(numbers), numbers // _U(CLASSES)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = np.concatenate((np.zeros(1, _U), hashes[:-1]))
    second = np.concatenate((np.zeros(1, _U), before[:-1]))
    c = (numbers % _U(CLASSES)).astype(np.int64)
    c1 = np.concatenate((np.zeros(1, np.int64), c[:-1]))
    c2 = np.concatenate((np.zeros(1, np.int64), c1[:-1]))
    for k, arrays in ((1, (before, c1)), (2, (second, c2))):
        for a in arrays:
            a[place < k] = 0
    r1 = (before % _U(_PREVIOUS)).astype(np.int64)
    r2 = _PREVIOUS + c1 * CLASSES + c2
    r3 = _PREVIOUS + CLASSES * CLASSES + (second % _U(_SKIP)).astype(np.int64)
    return [r1, r2, r3]


def _member_row(row: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (mix((row * CLASSES + c).astype(_U)) % _U(ROWS2)).astype(np.int64)


def _softmax(weights: np.ndarray, most: np.ndarray, bias: np.ndarray, bias_most: np.ndarray, rows: list[np.ndarray], own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of ``own``, the exponentials of all scores and their sums, all less a bound of the row's scores."""
    s = np.take(weights, rows[0], axis=0)
    top = most[rows[0]] + bias_most
    for r in rows[1:]:
        s += np.take(weights, r, axis=0)
        top += most[r]
    s += bias
    s -= top[:, None]
    of_own = s[np.arange(len(own)), own]
    e = np.exp(s, out=s)
    return of_own, e, e @ np.ones(e.shape[1], e.dtype)


def _runs(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows: short ones row by row over all runs at once, long ones each as a product with ones."""
    size = np.diff(np.append(first, len(p)))
    out, place = np.take(p, first, axis=0), np.flatnonzero(size > 1)
    for k in range(1, 8):
        out[place] += np.take(p, first[place] + k, axis=0)
        place = place[size[place] > k + 1]
    ones = np.ones(size.max(initial=0), p.dtype)
    for k in place.tolist():
        out[k] = ones[: size[k]] @ p[first[k] : first[k] + size[k]]
    return out


def _add_rows(total: np.ndarray, at: np.ndarray, p: np.ndarray) -> None:
    if not len(at):
        return
    order = np.argsort(at.astype(np.uint16), kind="stable")
    r = at[order]
    first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
    total[r[first]] += _runs(np.take(p, order, axis=0), first)


@dataclass
class Weights:
    w1: np.ndarray  # ROWS1 x CLASSES
    b1: np.ndarray  # CLASSES
    w2: np.ndarray  # ROWS2 x MEMBERS
    b2: np.ndarray  # CLASSES x MEMBERS

    def __post_init__(self):
        self.w1, self.w2 = (np.clip(w, -_MOST, _MOST).astype(np.float32) for w in (self.w1, self.w2))
        self.most = self.w1.max(1), self.b1.max(), self.w2.max(1), self.b2.max(1)

    def _parts(self, rows: list[np.ndarray], outcome: np.ndarray) -> Iterator[tuple]:
        """By chunks: place, rows and softmax of the class, rows and softmax of the member."""
        most1, top1, most2, top2 = self.most
        for k in range(0, len(outcome), _CHUNK):
            part = slice(k, k + _CHUNK)
            c, m = np.divmod(outcome[part], MEMBERS)
            own = [r[part] for r in rows]
            yield part, own, _softmax(self.w1, most1, self.b1, top1, own, c)
            own = [_member_row(r, c) for r in own]
            yield part, own, _softmax(self.w2, most2, self.b2[c], top2[c], own, m)

    def log_probability(self, rows: list[np.ndarray], outcome: np.ndarray) -> np.ndarray:
        """Natural log of class and member of each token."""
        out = np.zeros(len(outcome))
        for part, _, (s, _, z) in self._parts(rows, outcome):
            out[part] += s - np.log(z)
        return out

    def add_expected(self, rows: list[np.ndarray], outcome: np.ndarray, e1: np.ndarray, e2: np.ndarray) -> None:
        order = np.argsort(rows[0] * CLASSES + outcome // MEMBERS, kind="stable")  # so that a chunk has few different rows
        rows, outcome = [r[order] for r in rows], outcome[order]
        for k, (_, own, (_, p, z)) in enumerate(self._parts(rows, outcome)):
            p *= (1 / z)[:, None]
            for r in own:
                _add_rows(e2 if k % 2 else e1, r, p)


def _observe(rows: list[np.ndarray], outcome: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> None:
    c, m = np.divmod(outcome, MEMBERS)
    for r in rows:
        n1 += np.bincount(r * CLASSES + c, minlength=n1.size).reshape(n1.shape)
        n2 += np.bincount(_member_row(r, c) * MEMBERS + m, minlength=n2.size).reshape(n2.shape)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Parts of an Arrow batch of ``numbered`` texts, of about ``_PART`` tokens: place, numbers, tokens of each text."""
    bodies = batch.column(column)
    sizes = np.array([len(b.as_buffer()) // 8 for b in bodies], np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // _PART)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(sizes)]):
        if end > start:
            body = b"".join(b.as_buffer() for b in bodies[start:end])
            yield slice(start, end), np.frombuffer(body, _U), sizes[start:end]


@dataclass
class Model:
    weights: Weights
    log_room: np.ndarray  # log10 of each outcome's smoothed count of words
    counts: DataFrame  # (word, n): all words by hash
    head: tuple[np.ndarray, np.ndarray]  # the most frequent of them, by hash
    train_tokens: int
    distinct: int
    add: float


def _start(n: np.ndarray, share: np.ndarray, prior: float, damp: float) -> np.ndarray:
    total = n.sum(1, keepdims=True)
    return (damp * np.log((n + prior * share) / ((total + prior) * share))).astype(np.float32)


def train(docs: DataFrame, *, text_col: str = "text", read: bool = False, add: float = 0.1, id_col: str = "doc_id", rounds: int = 5, prior: float = 30.0, damp: float = 0.45, rate: float = 0.6, head: int = 1 << 18) -> Model:
    """Learn from all rows of ``docs``, texts or, with ``read``, rows of ``numbered`` with the same ``rounds``. Each of
    ``rounds`` steps takes the gradient of its own share of the texts, by the hash of the id, so that all together take
    every text once, and copies of a text fall to different steps."""
    texts = (docs if read else numbered(docs, id_col=id_col, text_col=text_col, rounds=rounds)).select("words", "step")
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            w, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(outcomes(w)), pa.array(n.astype(np.int64))], names=["word", "outcome", "n"])

        for batch in batches:
            for _, w, _ in _texts(batch, 0):
                held.append(w)
                size += len(w)
                if size > 2_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    counts = written(texts.select("words").mapInArrow(count, "word long, outcome long, n long").groupBy("word").agg(F.sum("n").alias("n"), F.min("outcome").alias("outcome")))
    per = counts.groupBy("outcome").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tokens, distinct = np.zeros(CLASSES * MEMBERS), np.zeros(CLASSES * MEMBERS)
    for r in per:
        tokens[r["outcome"]], distinct[r["outcome"]] = r["n"], r["v"]
    best = most_frequent(counts, head).select("word", "n").toArrow().to_pandas().sort_values("word")
    shapes = [(ROWS1, CLASSES), (ROWS2, MEMBERS)]

    def observe(batch: pa.RecordBatch, arrays: list[np.ndarray]) -> None:
        for _, w, n in _texts(batch, 0):
            _observe(features(w, n), outcomes(w), *arrays)

    release(spark)  # the sums of a step are of one size for a partition, however few texts it has: none are kept beside the next ones
    n1, n2 = per_partition(texts.select("words"), observe, shapes)
    release(spark)
    smooth = tokens.reshape(CLASSES, MEMBERS) + 1e-3
    p1 = smooth.sum(1) / smooth.sum()
    p2 = smooth / smooth.sum(1, keepdims=True)
    weights = Weights(
        _start(n1, p1[None, :], prior, damp), np.log(p1).astype(np.float32),
        np.zeros((ROWS2, MEMBERS), np.float32), np.log(p2).astype(np.float32),
    )
    # a member row is shared by few classes; the class it mostly serves is the reference its counts are held against
    row_class = np.zeros((ROWS2, CLASSES))
    every = np.arange(ROWS1)
    for c in range(CLASSES):
        np.add.at(row_class[:, c], _member_row(every, np.full(ROWS1, c)), n1[:, c])
    mixed = row_class @ p2 + 1e-9
    weights = Weights(weights.w1, weights.b1, _start(n2, mixed / mixed.sum(1, keepdims=True), prior, damp), weights.b2)

    def move(batch: pa.RecordBatch, arrays: list[np.ndarray]) -> None:
        now = shared.value
        for _, w, n in _texts(batch, 0):
            rows, o = features(w, n), outcomes(w)
            _observe(rows, o, arrays[0], arrays[1])
            now.add_expected(rows, o, arrays[2], arrays[3])

    for k in range(rounds):
        shared = spark.sparkContext.broadcast(weights)
        o1, o2, e1, e2 = per_partition(texts.filter(F.col("step") == k).select("words"), move, shapes * 2)
        shared.destroy()
        release(spark)
        step = rate / (1 + k)
        weights = Weights(
            weights.w1 + step * (o1 - e1) / (o1 + e1 + 5), weights.b1,
            weights.w2 + step * (o2 - e2) / (o2 + e2 + 5), weights.b2,
        )
    room = np.log10(tokens + add * (distinct + 1))
    return Model(weights, room, counts.select("word", "n"), (best["word"].to_numpy(np.int64), best["n"].to_numpy(np.int64)), int(tokens.sum()), int(distinct.sum()), add)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", read: bool = False) -> DataFrame:
    """Per row: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10 of the text).
    With ``read``, ``docs`` are rows of ``numbered``, else texts."""
    docs = docs if read else numbered(docs, id_col=id_col, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.log_room, *model.head))
    kind, add = docs.schema[id_col].dataType.simpleString(), model.add
    schema = f"row long, id {kind}, n_tokens long, known long, by_count double, by_model double, rare array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, room, head, head_n = shared.value
        at = TaskContext.get().partitionId() << 33
        logs = np.log10(np.append(head_n, 0) + add)
        for batch in batches:
            for part, w, n in _texts(batch, 1):
                own, o = w.view(np.int64), outcomes(w)
                place = np.searchsorted(head, own)
                hit = (place < len(head)) & (np.append(head, 0)[np.minimum(place, len(head))] == own)
                ends = np.cumsum(n)
                start = ends - n
                total = lambda x: np.add.reduceat(x, start)
                by_model = total(weights.log_probability(features(w, n), o) / np.log(10) - room[o])
                by_count = total(np.where(hit, logs[np.where(hit, place, 0)], logs[-1]))
                rare = own[~hit]
                offsets = np.concatenate(([0], np.cumsum(total((~hit).astype(np.int64))))).astype(np.int32)
                rows = at + np.arange(len(n))
                at += len(n)
                arrays = [pa.array(rows), batch.column(0)[part.start : part.stop], pa.array(n), pa.array(total(hit.astype(np.int64))), pa.array(by_count), pa.array(by_model), pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare))]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "n_tokens", "known", "by_count", "by_model", "rare"])

    scored = written(docs.select(F.col(id_col).alias("id"), "words").mapInArrow(run, schema))
    rare = scored.select("row", F.explode("rare").alias("word")).join(model.counts, "word")
    more = rare.groupBy("row").agg(F.count(F.lit(1)).alias("k"), F.sum(F.log10(F.col("n") + add) - F.log10(F.lit(add))).alias("s"))
    out = scored.drop("rare").join(more, "row", "left").fillna({"k": 0, "s": 0.0})
    counted = F.col("by_count") + F.col("s")
    room = float(np.log10(model.train_tokens + add * (model.distinct + 1)))
    return out.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.col("k")).alias("n_known"), F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * room).alias("base_score"), (counted + F.col("by_model")).alias("score"),
    )
