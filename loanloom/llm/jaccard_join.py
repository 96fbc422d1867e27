"""Exact n-gram Jaccard self-join by grouped prefixes.

A document's set holds its distinct word shingles, as 64-bit hashes. Sets are put in one global order, shingles of
rarer hash buckets first; two sets with similarity of at least ``t`` then share a shingle among their first
``n - ceil(t n) + 1``. Documents with equal sets are one class, classes with equal size and prefix one group, and
only groups meet in the prefix index.

Where many classes share a prefix shingle, not all pairs are made. Each is verified against one pivot of the
shingle, the one whose own prefix is most frequent, and those near it are linked by it. What is left are pairs of
different components, of which one is not near the pivot: their shared prefix shingles are counted in blocks, and
only pairs with as many as linked sets must share are verified. No link between components is lost.

Defined cases: null and empty texts have empty sets and are linked with nothing; rows with one id count as one
node; a null id is carried without links; other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .scratch import cut, recorded, release, written
from .text import hash_memo, shingles, thinned, word_hashes, words

#: Size of the table of shingle frequencies that orders prefixes: 2**bits counts, whatever the input.
SKETCH_BITS, _BLOCK = 20, 4096


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _sets(texts: list[str | None], memo, width: int) -> Iterator[np.ndarray]:
    for text in texts:
        yield np.unique(shingles(word_hashes(memo, words(text)), width))


def frequencies(docs: DataFrame, width: int = 5, bits: int = SKETCH_BITS) -> np.ndarray:
    """Documents per hash bucket of shingles, over all documents."""
    shift, size = np.uint64(64 - bits), 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, table = hash_memo(), np.zeros(size, np.uint32)
        for batch in batches:
            held, n = [], 0
            for s in _sets(batch.column(0).to_pylist(), memo, width):
                held.append(s >> shift)
                n += len(s)
                if n > 1_000_000:
                    table += np.bincount(np.concatenate(held).astype(np.int64), minlength=size).astype(np.uint32)
                    held, n = [], 0
            if held:
                table += np.bincount(np.concatenate(held).astype(np.int64), minlength=size).astype(np.uint32)
        blocks = table.reshape(-1, _BLOCK)
        some = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([blocks[k].tobytes() for k in some], pa.binary())], names=["block", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_BLOCK, np.uint64)
        for raw in pdf["counts"]:
            total += np.frombuffer(raw, np.uint32)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "counts": [np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()]})

    sums = docs.select("text").mapInArrow(count, "block long, counts binary").groupBy("block").applyInPandas(add, "block long, counts binary")
    table = np.zeros((size // _BLOCK, _BLOCK), np.uint32)
    for r in sums.collect():
        table[r["block"]] = np.frombuffer(r["counts"], np.uint32)
    return table.reshape(-1)


def profiles(docs: DataFrame, order, width: int, t: Fraction, bits: int = SKETCH_BITS) -> DataFrame:
    """Per document: set size, two hashes of the set, one of the prefix, and the prefix itself."""
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, table = hash_memo(), order.value
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                n, k1, k2, pk, prefix = [], [], [], [], []
                for s in _sets(part.column(1).to_pylist(), memo, width):
                    raw = s.tobytes()
                    n.append(len(s))
                    k1.append(xxhash.xxh3_64_intdigest(raw, 1) - (1 << 63))
                    k2.append(xxhash.xxh3_64_intdigest(raw, 2) - (1 << 63))
                    first, usual = s[:0], 0
                    if len(s):
                        size = len(s) - math.ceil(t * len(s)) + 1
                        often = table[(s >> shift).astype(np.int64)]
                        best = np.lexsort((s, often))[:size]
                        first, usual = s[best], min(1023, int(16 * np.log2(1.0 + often[best]).mean()))
                    # the group's number: least for prefixes of frequent shingles, as an original has among its copies
                    pk.append((1023 - usual) << 53 | xxhash.xxh3_64_intdigest(np.sort(first).tobytes(), len(s)) >> 11)
                    prefix.append(first.view(np.int64))
                flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
                offsets = np.concatenate(([0], np.cumsum([len(p) for p in prefix]))).astype(np.int32)
                arrays = [part.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(pk, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "k1", "k2", "pk", "prefix"])

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 long, pk long, prefix array<long>")


def _verified(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(a, b, both, either): sizes of intersection and union of the sets of two classes, from the texts of their
    least ids. Texts of other ids are mostly left where they are."""
    pairs = pairs.select("a", "b").distinct()
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = written(thinned(docs, ids, "doc_id").join(ids, "doc_id", "left_semi"))
    side = lambda c, t: texts.select(F.col("doc_id").alias(c), F.col("text").alias(t))
    joined = pairs.join(side("a", "ta"), "a").join(side("b", "tb"), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, v = hash_memo(), None, None
        for batch in batches:
            both, either = [], []
            for x, k, y in zip(batch.column(2), batch.column(1).to_pylist(), batch.column(3)):
                if k != held:  # rows come in the order of b
                    held, v = k, next(_sets([y.as_py()], memo, width))
                u = next(_sets([x.as_py()], memo, width))
                small, large = (u, v) if len(u) <= len(v) else (v, u)
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                same = int((large[at] == small).sum()) if len(large) else 0
                both.append(same)
                either.append(len(u) + len(v) - same)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())], names=["a", "b", "both", "either"])

    out = written(joined.mapInArrow(run, "a long, b long, both long, either long"))
    release(docs.sparkSession, texts)
    return out


#: Classes of a chunk, the unit in which classes with common shingles meet.
_CHUNK = 256


def _across(rows: DataFrame, found: DataFrame, t: Fraction) -> DataFrame:
    """Pairs (a, b) of different components that may still be linked.

    Of two sets in the global order, what the prefixes do not share can only lie in the longer of the two suffixes, so
    linked sets share at least ``needed`` prefix shingles. Classes are put into chunks with others of their usual
    pivot; a class meets a chunk if enough of its prefix occurs in the chunk at all, and the shared shingles of the
    classes are counted there, chunk against block of classes. Only pairs with enough of them are returned.
    """
    num, den = t.numerator, t.denominator
    placed = rows.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    mixed = placed.groupBy("tok").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("tok")
    each = placed.join(mixed, "tok", "left_semi").groupBy("cls", "n", "component").agg(F.collect_set("tok").alias("toks"), F.mode("pivot").alias("home"), F.max(~F.col("near")).alias("far"))
    sizes = each.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / _CHUNK).alias("chunks"))
    each = written(each.join(sizes, "home").withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks"))).drop("chunks"))

    spans = each.groupBy("home", "chunk").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    where = each.select(F.explode("toks").alias("tok"), "home", "chunk").distinct()
    meets = each.filter("far").select("cls", "n", F.explode("toks").alias("tok")).join(where, "tok").groupBy("cls", "n", "home", "chunk").agg(F.count(F.lit(1)).alias("u"))
    suffix = lambda n: F.ceil(n * num / den) - 1
    need = lambda n: F.ceil((F.col("n") + n) * num / (num + den)) - F.greatest(suffix(F.col("n")), suffix(n)) - 1
    lo, hi = F.greatest("least", F.ceil(F.col("n") * num / den)), F.least("most", F.floor(F.col("n") * den / num))
    meets = meets.join(spans, ["home", "chunk"]).filter((lo <= hi) & (F.col("u") >= F.least(need(lo), need(hi)))).select("cls", "home", "chunk")
    many = meets.groupBy("home", "chunk").agg(F.ceil(F.count(F.lit(1)) / (4 * _CHUNK)).alias("blocks"))
    asked = each.select("cls", "n", "component", "toks").join(meets, "cls").join(many, ["home", "chunk"])
    asked = asked.groupBy("home", "chunk", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block")).agg(F.collect_list(F.struct("cls", "n", "component", "toks")).alias("xs"))
    chunks = each.groupBy("home", "chunk").agg(F.collect_list(F.struct("cls", "n", "component", "toks")).alias("ys"))

    def flat(rows_: list[dict]) -> tuple[np.ndarray, ...]:
        toks = [np.array(r["toks"], np.int64) for r in rows_]
        ids, n, component = (np.array([r[c] for r in rows_], np.int64) for c in ("cls", "n", "component"))
        return ids, n, component, np.concatenate(toks), np.repeat(np.arange(len(rows_)), [len(x) for x in toks])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for xs, ys in zip(batch.column(0), batch.column(1)):
                x_id, x_n, x_comp, x_tok, x_at = flat(xs.as_py())
                y_id, y_n, y_comp, y_tok, y_at = flat(ys.as_py())
                by = np.argsort(y_tok, kind="stable")
                y_tok, y_at = y_tok[by], y_at[by]
                pairs: dict[str, list[np.ndarray]] = {"a": [], "b": []}
                for lo_ in range(0, len(x_id), 64):
                    part = (x_at >= lo_) & (x_at < lo_ + 64)
                    tok, at = x_tok[part], x_at[part] - lo_
                    first, last = np.searchsorted(y_tok, tok, "left"), np.searchsorted(y_tok, tok, "right")
                    size = last - first
                    place = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum())) if len(size) else np.zeros(0, np.int64)
                    shared = np.bincount(np.repeat(at, size) * len(y_id) + y_at[place], minlength=64 * len(y_id)).reshape(64, -1)[: len(x_id) - lo_]
                    n = x_n[lo_ : lo_ + 64, None]
                    alpha = -(-(n + y_n) * num // (num + den))
                    suffix_ = -(-np.maximum(n, y_n) * num // den) - 1
                    ok = (shared >= np.maximum(alpha - suffix_, 1)) & (x_comp[lo_ : lo_ + 64, None] != y_comp) & (np.minimum(n, y_n) * den >= np.maximum(n, y_n) * num)
                    i, j = np.nonzero(ok)
                    u, v = x_id[i + lo_], y_id[j]
                    pairs["a"].append(np.minimum(u, v))
                    pairs["b"].append(np.maximum(u, v))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in pairs.values()], names=["a", "b"])

    out = written(asked.join(chunks, ["home", "chunk"]).select("xs", "ys").mapInArrow(count, "a long, b long").distinct())
    release(rows.sparkSession, each)
    return out


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, numerator: int = 80, denominator: int = 100) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``class_id`` (least id with the same set) and ``component_id``.

    Two documents link when ``denominator * intersection >= numerator * union``.
    """
    docs, t = _source(docs, id_col, text_col), Fraction(numerator, denominator)
    with recorded() as made:
        light, classes, found = _linked(docs, width, t)
    release(docs.sparkSession, *(x for x in made if x is not light and x is not classes))
    named = light.join(classes.drop("pk"), ["n", "k1", "k2"], "left")
    out = named.join(found.withColumnRenamed("node", "cls"), "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("cls", "doc_id").alias("class_id"), F.coalesce("component", "cls", "doc_id").alias("component_id"))


def _linked(docs: DataFrame, width: int, t: Fraction) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their sets' hashes, classes of equal sets, and the components of linked classes."""
    spark, numerator, denominator = docs.sparkSession, t.numerator, t.denominator
    order = spark.sparkContext.broadcast(frequencies(docs, width))
    release(spark)
    profile = written(profiles(docs, order, width, t))
    light = written(profile.drop("prefix"))
    classes = light.filter("n > 0 and doc_id is not null").groupBy("n", "k1", "k2", "pk").agg(F.min("doc_id").alias("cls"))
    classes = written(classes)
    groups = classes.groupBy("n", "pk").agg(F.min("cls").alias("gid"))
    members = classes.join(groups, ["n", "pk"]).select("cls", "gid", "n")

    # the prefix index of groups, each under a number; only shingles of two groups or more can give pairs
    number = F.col("pk").alias("g")
    index = profile.filter("n > 0 and doc_id is not null").select(F.explode("prefix").alias("tok"), number)
    shared = written(index.groupBy("tok").agg(F.min("g").alias("p"), F.max("g").alias("q")).filter("p < q").drop("q"))
    release(spark)  # all prefixes were moved for it, and are moved again to be joined: not both at once
    index = index.join(shared, "tok").distinct()
    gids = groups.select(number, "gid")
    # classes of one group meet under all shingles of their prefix
    several = classes.groupBy("n", "pk").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(number)
    own = profile.filter("n > 0 and doc_id is not null").select(number, "prefix").join(several, "g").select(F.explode("prefix").alias("tok"), "g", F.col("g").alias("p")).distinct()
    index = index.select("tok", "g", "p").unionByName(own)
    index = written(index.join(gids, "g").join(gids.select(F.col("g").alias("p"), F.col("gid").alias("pivot")), "p").select("tok", "gid", "pivot"))

    alone = members.filter("cls <> gid").select(F.col("cls").alias("a"), F.col("gid").alias("b"))
    n_of = lambda a, n: members.select(F.col("cls").alias(a), F.col("n").alias(n))
    star = index.filter("gid <> pivot").select("gid", "pivot").distinct().join(members, "gid").select(F.col("cls").alias("a"), F.col("pivot").alias("b"), F.col("n").alias("na"))
    star = star.join(n_of("b", "nb"), "b").filter(_sizes("na", "nb", numerator, denominator)).select("a", "b")
    pairs = cut(star.unionByName(alone).distinct())
    release(spark, profile)

    first = _verified(pairs, docs, width)
    linked = lambda v: v.filter(F.col("both") * denominator >= F.col("either") * numerator).select("a", "b")

    # every class in its shingles' buckets, with its distance to the pivot; null where sizes alone part them
    far = (first.select(F.col("a").alias("cls"), F.col("b").alias("pivot"), (1 - F.col("both") / F.col("either")).alias("d")))
    rows = index.join(members, "gid").select("tok", "cls", "n", "pivot").join(far, ["cls", "pivot"], "left")
    rows = rows.withColumn("d", F.when(F.col("cls") == F.col("pivot"), F.lit(0.0)).otherwise(F.col("d")))
    reach = 1 - numerator / denominator
    rows = written(rows.withColumn("near", F.coalesce(F.col("d") <= reach - 1e-9, F.lit(False))))
    release(spark, index)

    edges = linked(first)
    found = components(edges)
    rest = _across(rows, found, t)
    if not rest.isEmpty():
        found = components(edges.unionByName(linked(_verified(rest, docs, width))))

    return light, classes, found


def _sizes(a: str, b: str, numerator: int, denominator: int):
    return F.least(a, b) * denominator >= F.greatest(a, b) * numerator


def kept_ids(joined: DataFrame) -> DataFrame:
    """One id of each component: the smallest."""
    return joined.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
