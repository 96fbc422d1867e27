"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

Every word of the trusted texts is a word of the model, known by its hash, and every n-gram counts, also those seen
once. Counts of the highest order are summed in shards of n-grams; lower orders count distinct continuations;
discounts come from the counts of counts. In logarithms a text's score is a sum over its tokens: a value of each
word, one of each context, and a gain for every known n-gram. The ``head`` most frequent words and n-grams go to all
tasks as arrays; what a text needs besides is asked of the other values, shard by shard: a task packs its questions
by shard, the answers are summed per text.

A document is rejected if its perplexity exceeds, by more than ``slack``, the ``quantile`` of the trusted documents of
its language that the model was not trained on. Languages with fewer than ``least_docs`` such documents use those of
all languages; without any nothing is rejected, and the threshold is null.

Defined cases: null and empty texts are the end token alone; null languages are one language; repeated rows are
judged one by one; a perplexity equal to the threshold is kept; without trusted text nothing is rejected; null ids are
allowed, and null trusted ids are none; a text is held whole in one task, whatever its length.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .scratch import reads, recorded, release, steady, written
from .text import STEP, hash_memo, least_count, mix, nullable, thinned, word_hashes, words

_U = np.uint64
#: Words are known by this many bits fewer than 64 of their hash: tables of n-grams take less room, and among ten
#: million words about one in six tables has two words that share a number.
_SPARE = _U(16)
#: What stands before and after a text; no word has a blank.
START, END = (_U(xxhash.xxh3_64_intdigest(x)) >> _SPARE for x in (b" start", b" end"))
#: Values in a shard of the model, about.
_SHARD = 1 << 17
#: Languages whose thresholds are broadcast; more are joined.
_FEW = 10_000


def _tokens(texts: list[str | None], memo, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts, each with ``order - 1`` starts before and an end after it; the places of its tokens (words
    and end), and their number for each text."""
    split = [words(t, lower=False) for t in texts]
    h = word_hashes(memo, [w for s in split for w in s]) >> _SPARE
    sizes = np.array([len(s) for s in split], np.int64)
    out = np.full(int(sizes.sum()) + len(split) * order, START, _U)
    begin = np.cumsum(sizes + order) - sizes - order
    out[np.arange(len(h)) + np.repeat(begin + order - 1 - (np.cumsum(sizes) - sizes), sizes)] = h
    out[begin + sizes + order - 1] = END
    tokens = sizes + 1
    ends = np.repeat(begin + order - 1 - (np.cumsum(tokens) - tokens), tokens) + np.arange(int(tokens.sum()))
    return out, ends, tokens


def _key(parts: list[np.ndarray], size: int) -> np.ndarray:
    """The 64-bit number of an n-gram (``size`` words) or of a context (``-size`` words)."""
    x = np.full(len(parts[0]), size * STEP & (1 << 64) - 1, _U)
    for p in parts:
        x *= _U(STEP)
        x += p
    return mix(x)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[slice, list[str | None]]]:
    texts, start, size = batch.column(column).to_pylist(), 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size > 2_000_000 or k - start >= 50_000 or k == len(texts) - 1:
            yield slice(start, k + 1), texts[start : k + 1]
            start, size = k + 1, 0


def discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and more, from the numbers of n-grams with counts 1 to 4."""
    n = [counts.get(k, 0) for k in (1, 2, 3, 4)]
    if min(n) == 0:
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(k * 1.0, max(0.05, k - (k + 1) * y * n[k] / n[k - 1])) for k in (1, 2, 3))


@dataclass
class Model:
    order: int
    unknown: float  # log10 probability of a word that no trusted text has
    word: np.ndarray  # hashes of the most frequent words, sorted
    own: np.ndarray  # log10 probability of each by itself
    context: np.ndarray  # log10 back-off weight of each as a context
    shards: int
    values: DataFrame  # (shard, hi, low, gain): all words, contexts and n-grams, packed
    head: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)


def _discount(c: Column, d: tuple[float, float, float]) -> Column:
    return F.when(c == 1, F.lit(d[0])).when(c == 2, F.lit(d[1])).otherwise(F.lit(d[2]))


def _count(texts: DataFrame, order: int) -> DataFrame:
    """(w0, w1, ..., n): the n-grams of the highest order."""
    names = [f"w{k}" for k in range(order)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = hash_memo(), [], 0

        def out() -> pa.RecordBatch:
            parts = [np.concatenate(x) for x in zip(*held)]
            _, at, n = np.unique(_key(parts, order), return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([*(pa.array(p[at].view(np.int64)) for p in parts), pa.array(n.astype(np.int64))], names=[*names, "n"])

        for batch in batches:
            for _, part in _slices(batch, 0):
                h, ends, _ = _tokens(part, memo, order)
                held.append([h[ends - k] for k in range(order - 1, -1, -1)])
                size += len(ends)
                if size > 4_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return texts.mapInArrow(run, ", ".join(f"{c} long" for c in (*names, "n"))).groupBy(*names).agg(F.sum("n").alias("n"))


_PACKED = "shard long, hi binary, low binary, gain binary"


def _shards(key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and number within the shard, of 40 bits: a shard holds so few values that strangers share one of a
    million million numbers next to never, however large the model is."""
    return (key % _U(shards)).astype(np.int64), (key // _U(shards)) & _U((1 << 40) - 1)


def _by_shard(key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts keys by shard and number, the numbers in this order, the shards met, and where each starts."""
    shard, number = _shards(key, shards)
    by = np.lexsort((number, shard))
    shard = shard[by]
    first = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else np.zeros(0, np.int64)
    return by, number[by], shard[first], first


def _binary(x: np.ndarray, first: np.ndarray) -> pa.Array:
    """``x`` cut at the places ``first``, as bytes."""
    width = x.dtype.itemsize
    offsets = np.append(first, len(x)) * width
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(x).tobytes())])


def _pack(values: DataFrame, size: int, shards: int) -> DataFrame:
    """``values``: (w0, ..., gain) of n-grams (``size`` words) or contexts (``-size`` words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def out() -> pa.RecordBatch:
            parts = [np.concatenate(x) for x in zip(*held)]
            by, number, shard, first = _by_shard(_key([p.view(_U) for p in parts[:-1]], size), shards)
            hi, low, gain = (number >> _U(32)).astype(np.uint8), number.astype(np.uint32), parts[-1][by].astype(np.float32)
            return pa.RecordBatch.from_arrays([pa.array(shard), *(_binary(x, first) for x in (hi, low, gain))], names=["shard", "hi", "low", "gain"])

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
            if rows > 1_000_000:
                yield out()
                held, rows = [], 0
        if rows:
            yield out()

    return values.mapInArrow(run, _PACKED)


def train(trusted: DataFrame, *, text_col: str = "text", order: int = 2, head: int = 1 << 18) -> Model:
    """The model of all rows of ``trusted``; ``head`` bounds what is sent to all tasks, results do not depend on it."""
    with recorded() as made:
        model = _trained(trusted, text_col, order, head)
    release(trusted.sparkSession, *(t for t in made if not reads(model.values, t)))
    return model


def _trained(trusted: DataFrame, text_col: str, order: int, head: int) -> Model:
    spark = trusted.sparkSession
    names = lambda a, b: [f"w{k}" for k in range(a, b)]
    # in the order of their words, n-grams take half the room
    tables = {order: written(_count(trusted.select(F.col(text_col).cast("string").alias("text")), order).sortWithinPartitions(*names(0, order)))}
    release(spark)
    for k in range(order - 1, 0, -1):
        shorter = tables[k + 1].groupBy(*(F.col(f"w{j + 1}").alias(f"w{j}") for j in range(k))).agg(F.count(F.lit(1)).alias("n"))
        tables[k] = written(shorter)
    rates = {k: discounts({r["n"]: r["c"] for r in t.filter("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}) for k, t in tables.items()}

    # words: of their continuation counts, each by itself; an unknown word takes part in what the discounts leave
    lost = _discount(F.col("n"), rates[1])
    all_words, total, free = tables[1].agg(F.count(F.lit(1)), F.sum("n"), F.sum(lost)).first()
    free = (free / total if total else 1.0) / (all_words + 1)
    lower = tables[1].select("w0", ((F.col("n") - lost) / F.lit(float(total or 1)) + F.lit(free)).alias("p"))
    packed, heads = [], {}
    word_table = None
    sizes = all_words + sum(tables[k].count() for k in range(2, order + 1))
    shards = max(8, 1 << math.ceil(math.log2(1 + sizes / _SHARD)))
    for k in range(2, order + 1):
        grams, d = tables[k], rates[k]
        held = F.col("n") - _discount(F.col("n"), d)
        stats = grams.groupBy(*names(0, k - 1)).agg(F.sum("n").alias("total"), F.sum(_discount(F.col("n"), d)).alias("lost"))
        stats = written(stats.select(*names(0, k - 1), "total", (F.col("lost") / F.col("total")).alias("gamma")))
        low = lower.select(*(F.col(f"w{j}").alias(f"w{j + 1}") for j in range(k - 1)), F.col("p").alias("low"))
        if k == 2:
            each = lower.join(stats, "w0", "full").select("w0", "p", "total", "gamma")
            word_table = written(each)
            edges = F.col("w0").isin(*(int(x.view(np.int64)) for x in (START, END)))
            top = word_table.filter(edges | (F.col("total") >= least_count(word_table.filter("total is not null"), head, "total")))
            near = lambda c, *more: F.broadcast(top.select(F.col("w0").alias(c), *more))
            tagged = grams.join(near("w0", "total", "gamma"), "w0", "left").join(near("w1", F.col("p").alias("low")), "w1", "left")
            there = F.col("total").isNotNull() & F.col("low").isNotNull()
            rows = tagged.filter(there).unionByName(tagged.filter(~there).select("w0", "w1", "n").join(stats, "w0").join(low, "w1"))
        else:
            rows = grams.join(stats, names(0, k - 1)).join(low, names(1, k))
        rows = rows.withColumn("p", held / F.col("total") + F.col("gamma") * F.col("low"))
        rows = rows.withColumn("gain", F.log10("p") - F.log10("gamma") - F.log10("low"))
        if k < order:
            rows = written(rows.select(*names(0, k), "n", "p", "gain"))
            lower = rows.select(*names(0, k), "p")
        packed.append(written(_pack(rows.select(*names(0, k), "gain"), k, shards)))
        if k > 2:
            packed.append(written(_pack(stats.select(*names(0, k - 1), F.log10("gamma").alias("gain")), 1 - k, shards)))
        best = rows.filter(F.col("n") >= least_count(tables[k], head)).select(*names(0, k), "gain").toArrow()
        parts = [best.column(c).to_numpy() for c in names(0, k)]
        keys = _key([p.view(_U) for p in parts], k)
        by = np.argsort(keys)
        heads[k] = (keys[by], best.column("gain").to_numpy()[by])
        release(spark, tables.pop(k))
    unknown = math.log10(free)
    if word_table is None:  # order 1
        word_table = written(lower.withColumns({"total": F.lit(1), "gamma": F.lit(1.0)}))
        top = word_table.filter(F.col("w0") == int(END.view(np.int64)))
    # a word is a token, and then the context of the next one: one answer is the sum of both
    both = (F.log10("p") - F.lit(unknown) + F.log10("gamma")).alias("gain")
    packed.append(written(_pack(word_table.filter("p is not null and gamma is not null").select("w0", both), 1, shards)))
    best = top.toArrow().to_pandas().sort_values("w0", key=lambda w: w.astype("int64").to_numpy().view(_U))
    own, context = (np.log10(best[c].fillna(d).to_numpy(float)) for c, d in (("p", 10.0**unknown), ("gamma", 1.0)))
    return Model(order, unknown, best["w0"].to_numpy(np.int64).view(_U), own, context, shards, reduce(DataFrame.unionByName, packed), heads)


def perplexity(docs: DataFrame, model: Model, *keep: str, text_col: str = "text", rounds: int = 2) -> DataFrame:
    """The columns ``keep`` with ``n_tokens`` and ``perplexity``. Texts are read ``rounds`` times, and each time ask
    another part of the shards, so that no more than one part's questions lie on disk at once."""
    docs = steady(docs.select(*keep, F.col(text_col).cast("string").alias("_text")))
    shared = docs.sparkSession.sparkContext.broadcast((model.order, model.unknown, model.word, model.own, model.context, model.head))
    shards = model.shards  # an even number, so that a key's round follows from its shard
    if shards % rounds:
        raise ValueError("rounds must divide the number of shards")
    own = [StructField(c, nullable(docs.schema[c].dataType)) for c in keep]
    kinds = StructType([*StructType.fromDDL("shard long, kind int, base long, row long"), *own, *StructType.fromDDL("n_tokens long, sum double, hi binary, low binary, gain binary")])
    scored = StructType(kinds.fields[2 : 6 + len(keep)])
    answered = StructType([*scored.fields, *StructType.fromDDL("n long, gain binary").fields])
    held = len(keep)

    def ask(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        """A row for each text (kind 1), in the first round, and one for each shard that texts of a slice ask (kind 2)."""
        order, unknown, word, own, context, head = shared.value
        memo, at = hash_memo(), TaskContext.get().partitionId() << 33
        for batch in batches:
            for part, texts in _slices(batch, held):
                h, ends, tokens = _tokens(texts, memo, order)
                place = np.searchsorted(word, h)
                hit = (place < len(word)) & (np.append(word, _U(0))[np.minimum(place, len(word))] == h)
                place[~hit] = len(word)
                text = np.repeat(np.arange(len(tokens), dtype=np.uint16), tokens)
                first = turn == 0  # only then are the arrays' values summed, and all n-grams looked up in them
                value = np.append(own, unknown)[place[ends]] if first else None
                asked = [(_key([h[ends[~hit[ends]]]], 1), text[~hit[ends]])]
                for size in range(1, order):
                    if size > 1:
                        asked.append((_key([h[ends - k] for k in range(size, 0, -1)], -size), text))
                    elif first:
                        value += np.append(context, 0.0)[place[ends - 1]]
                    key, of = _key([h[ends - k] for k in range(size, -1, -1)], size + 1), text
                    if not first:
                        mine = key % _U(rounds) == _U(turn)
                        key, of = key[mine], of[mine]
                    top, gain = head[size + 1]
                    there = np.searchsorted(top, key)
                    known = (there < len(top)) & (np.append(top, _U(0))[np.minimum(there, len(top))] == key)
                    if first:
                        value[known] += gain[there[known]]
                    asked.append((key[~known], of[~known]))
                n = len(tokens)
                rows = at + np.arange(n)
                keeps = [c[part.start : part.stop] for c in batch.columns[:held]]
                start = np.cumsum(tokens) - tokens
                blank = pa.nulls(n, pa.binary())
                if first:
                    yield pa.RecordBatch.from_arrays([pa.array(rows % shards), pa.array(np.ones(n, np.int32)), pa.array(np.full(n, at)), pa.array(rows), *keeps, pa.array(tokens), pa.array(np.add.reduceat(value, start)), blank, blank, blank], schema=wire)
                key, of = (np.concatenate(x) for x in zip(*asked))
                mine = key % _U(rounds) == _U(turn)
                key, of = key[mine], of[mine]
                by, number, shard, edge = _by_shard(key, shards)
                n = len(shard)
                hi, low = (number >> _U(32)).astype(np.uint8), number.astype(np.uint32)
                none = [pa.nulls(n, c.type) for c in batch.columns[:held]]
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(np.full(n, 2, np.int32)), pa.array(np.full(n, at)), pa.nulls(n, pa.int64()), *none, pa.array(np.full(n, len(tokens))), pa.nulls(n, pa.float64()), *(_binary(x, edge) for x in (hi, low, of[by]))], schema=wire)
                at += len(tokens)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of texts as they are, and the sums of answers for texts."""
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        now, number, gain = -1, None, None
        sums: dict[int, np.ndarray] = {}
        size = 0

        def out(like: pa.RecordBatch) -> pa.RecordBatch:
            n = len(sums)
            blank = [pa.nulls(n, c.type) for c in like.columns[3 : 6 + held]]
            gains = pa.array([v.astype(np.float32).tobytes() for v in sums.values()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), *blank, pa.array([len(v) for v in sums.values()], pa.int64()), gains], schema=part)

        for batch in batches:
            rows = batch.filter(pa.array(batch.column(1).to_numpy() == 1))
            none = [pa.nulls(rows.num_rows, t.type) for t in list(part)[-2:]]
            yield pa.RecordBatch.from_arrays([*rows.columns[2 : 6 + held], *none], schema=part)
            shard, kind, base, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 4 + held))
            hi, low, more = (batch.column(k) for k in (6 + held, 7 + held, 8 + held))
            for k in np.flatnonzero(kind != 1):
                x = np.frombuffer(low[k].as_buffer(), np.uint32) + (np.frombuffer(hi[k].as_buffer(), np.uint8).astype(_U) << _U(32))
                if shard[k] != now:
                    parts, now, number = [], shard[k], None
                if kind[k] == 0:
                    parts.append((x, np.frombuffer(more[k].as_buffer(), np.float32)))
                    continue
                if number is None:
                    number, gain = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, _U), np.zeros(0, np.float32))
                    by = np.argsort(number, kind="stable")
                    number, gain, parts = number[by], np.append(gain[by].astype(float), 0.0), []
                place = np.searchsorted(number, x)
                place[(place < len(number)) & (np.append(number, _U(1 << 50))[place] != x)] = len(number)
                own = int(base[k])
                if own not in sums:
                    sums[own] = np.zeros(int(n[k]))
                    size += int(n[k])
                sums[own] += np.bincount(np.frombuffer(more[k].as_buffer(), np.uint16), gain[place], int(n[k]))
                if size > 4_000_000:
                    yield out(batch)
                    sums, size = {}, 0
        if sums:
            yield out(batch)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with the sums of their answers, which come just before them."""
        base, total = -1, None
        for batch in batches:
            at, row = batch.column(0).to_numpy(), batch.column(1).fill_null(-1).to_numpy()
            value = batch.column(3 + held).fill_null(0.0).to_numpy().copy()
            edges = np.flatnonzero(np.diff(at)) + 1
            for i, j in zip([0, *edges], [*edges, len(at)]):
                if i < j and at[i] != base:
                    base, total = int(at[i]), None
                texts = i + int((row[i:j] < 0).sum())
                for gain in batch.column(5 + held)[i:texts]:
                    gain = np.frombuffer(gain.as_buffer(), np.float32).astype(float)
                    total = gain if total is None else total + gain
                if total is not None:
                    value[texts:j] += total[row[texts:j] - base]
            columns = [*batch.columns[: 3 + held], pa.array(value)]
            yield pa.RecordBatch.from_arrays(columns, schema=result).filter(pa.array(row >= 0))

    wire, part, result = (to_arrow_schema(t) for t in (kinds, answered, scored))
    none = [F.lit(None).cast(nullable(docs.schema[c].dataType)).alias(c) for c in keep]
    parts = []
    for turn in range(rounds):
        asking = docs.mapInArrow(partial(ask, turn=turn), kinds)
        values = model.values.filter(F.col("shard") % rounds == turn)
        values = values.select("shard", F.lit(0).alias("kind"), *(F.lit(0).cast("long").alias(c) for c in ("base", "row")), *none, F.lit(0).cast("long").alias("n_tokens"), F.lit(0.0).alias("sum"), "hi", "low", "gain")
        asking = values.unionByName(asking)
        parts.append(written(asking.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(answer, answered)))
        release(docs.sparkSession)
    out = reduce(DataFrame.unionByName, parts).repartition("base").sortWithinPartitions("base", "row").mapInArrow(add, scored)
    return out.select(*keep, "n_tokens", F.pow(F.lit(10.0), F.least(-F.col("sum") / F.col("n_tokens"), F.lit(300.0))).alias("perplexity"))


def judged(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = (), order: int = 2, quantile: float = 0.99, slack: float = 1.15, held_out: int = 5, least_docs: int = 100) -> DataFrame:
    """Per row: id, language, ``n_tokens``, ``perplexity``, ``threshold`` (null: none), ``kept`` and the columns
    ``keep`` of ``docs``.

    ``trusted``: ids of trusted documents. One of ``held_out`` of them, by hash, sets the thresholds; the others
    train the model.
    """
    spark = docs.sparkSession
    own = [f"own_{k}" for k in range(len(keep))]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(o) for c, o in zip(keep, own)))
    ids = trusted.select(F.col(id_col).alias("id")).dropna().distinct().withColumn("held", F.pmod(F.xxhash64("id"), F.lit(held_out)) == 0)
    train_ids = ids.filter(~F.col("held"))
    with recorded() as made:
        texts = written(thinned(rows.select("id", "text"), train_ids, "id").join(train_ids, "id", "left_semi").select("text"))
        release(spark)
        model = train(texts, order=order)
        release(spark, texts)
        scores = written(perplexity(rows, model, "id", "lang", *own))
    release(spark, *(t for t in made if t is not scores))
    calm = scores.join(ids.filter("held").select("id"), "id", "left_semi")
    bound = F.percentile_approx("perplexity", quantile, 10_000) * slack
    each = written(calm.groupBy("lang").agg(bound.alias("one"), F.count(F.lit(1)).alias("c")).filter(F.col("c") >= least_docs).drop("c"))
    every = calm.agg(bound).first()[0]
    out = scores.join(F.broadcast(each) if each.count() <= _FEW else each, "lang", "left").withColumn("threshold", F.coalesce("one", F.lit(every).cast("double")))
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept")
    return out.select(F.col("id").alias(id_col), "lang", "n_tokens", "perplexity", "threshold", kept, *(F.col(o).alias(c) for c, o in zip(keep, own)))
