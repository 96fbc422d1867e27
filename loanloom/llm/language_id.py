"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its ``profile_size`` most frequent letter n-grams over all training texts.
A document's own most frequent n-grams are compared with each profile by the out-of-place distance: the sum of
the differences of rank, or ``profile_size`` where the profile lacks the n-gram.

Defined cases: null texts and texts without a letter are ``und`` with score 0; rows with null text or language are
not learned from; ties of rank go by the n-gram's code, ties of distance by the language's name; an empty training
table makes every text ``und``. Whole texts are used.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Code points are folded to this many bits in an n-gram's code.
_BITS, _SPACE = 20, 32
_FOLD: np.ndarray | None = None


def _fold() -> np.ndarray:
    """By code point: lower-case letters as they are, everything else a space."""
    global _FOLD
    if _FOLD is None:
        table = np.full(0x110000, _SPACE, np.int64)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD = table
    return _FOLD


def ngrams(text: str | None, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the n-grams of 1 to ``longest`` letters; words stand between single spaces."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = _fold()[raw]
    c = np.concatenate(([_SPACE], c, [_SPACE]))
    c = c[np.concatenate(([True], (c[1:] != _SPACE) | (c[:-1] != _SPACE)))]
    if len(c) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space, code, parts = c == _SPACE, c.copy(), [c[c != _SPACE]]
    inner = np.zeros(len(c), bool)
    for n in range(2, longest + 1):
        m = len(c) - n + 1
        if m <= 0:
            break
        code = (code[:m] << _BITS) | c[n - 1 :]
        inner = inner[:m] | (space[n - 2 : n - 2 + m] if n > 2 else False)  # no space but at the ends
        parts.append(code[~inner])
    codes, counts = np.unique(np.concatenate(parts), return_counts=True)
    return codes, counts.astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, best first; ties by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))[:size]]


def profiles(training: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = 3, profile_size: int = 400) -> dict[str, list[int]]:
    """By language, the codes of its profile. Counts cover all rows; the result has ``profile_size`` codes a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, dict[int, int]] = {}

        def out() -> pa.RecordBatch:
            rows = [(lang, g, n) for lang, t in total.items() for g, n in t.items()]
            cols = list(zip(*rows)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["lang", "gram", "n"])

        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                counts = total.setdefault(lang, {})
                for k in range(0, len(texts), 64):
                    for g, n in zip(*(x.tolist() for x in ngrams("\n".join(texts[k : k + 64]), longest))):
                        counts[g] = counts.get(g, 0) + n
            if sum(map(len, total.values())) > 400_000:
                yield out()
                total.clear()
        yield out()

    source = training.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    sums = source.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    best = sums.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= profile_size)
    out: dict[str, list[int]] = {}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["place"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def identify(docs: DataFrame, known: dict[str, list[int]], *, id_col: str = "doc_id", text_col: str = "text", longest: int = 3, profile_size: int = 400) -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score``: how much nearer the best language is than the next, 0 to 1."""
    langs = sorted(known)
    codes = np.array(sorted({g for grams in known.values() for g in grams}), np.int64)
    places = np.full((len(langs), len(codes) + 1), -1, np.int64)
    for k, lang in enumerate(langs):
        places[k, np.searchsorted(codes, np.array(known[lang], np.int64))] = np.arange(len(known[lang]))

    def distances(text: str | None) -> np.ndarray | None:
        own, counts = ngrams(text, longest)
        if not len(own) or not langs:
            return None
        top = ranked(own, counts, profile_size)
        at = np.searchsorted(codes, top)
        at[(at == len(codes)) | (codes[np.minimum(at, len(codes) - 1)] != top)] = len(codes)
        place = places[:, at]
        off = np.where(place < 0, profile_size, np.abs(place - np.arange(len(top))))
        return off.sum(1) / (len(top) * profile_size)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for text in batch.column(1).to_pylist():
                d = distances(text)
                if d is None:
                    names.append("und")
                    scores.append(0.0)
                    continue
                order = np.argsort(d, kind="stable")
                names.append(langs[order[0]])
                second = d[order[1]] if len(order) > 1 else 1.0
                scores.append(float(min(1.0, max(0.0, (second - d[order[0]]) / second if second > 0 else 0.0))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
