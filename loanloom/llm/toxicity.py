"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, look-alike letters of other scripts, digits that stand for letters) to words of
plain letters between single spaces. The lexicon holds whole words and word beginnings whose log-odds between
toxic and other labelled documents are high and whose counts are no accident; an Aho-Corasick automaton finds all
entries in one pass. Exception phrases, two words around an entry that are mostly harmless, cancel the matches they
cover. The sum of weights, and the sum normalised by length, go through a logistic curve fitted on at most
``fit_rows`` labelled documents; the counts behind the lexicon cover all of them.

The automaton goes to every task, so it holds the ``held`` strongest entries and most frequent exceptions. Further
ones stay in tables: a document's words that may be among them (by a bit for each hash bucket) are joined with these
tables, which gives the same sums as a larger automaton.

Defined cases: null and empty texts match nothing and get the curve's value for no match; null labels are not
learned from; repeated labels count each time; with no toxic label every score is the base rate (0 for no labels).
"""
from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written
from .text import Memo

#: Look-alikes of Latin letters, and digits or signs written for letters.
LOOKS = {"а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
BEGINNINGS = (4, 5, 6)
#: Hash buckets with a bit each, for what only a join can decide.
_BUCKETS = 1 << 22
#: Parts into which the joins deal a frequent word.
_SALTS = 32


class _Folding(dict):
    def __missing__(self, code: int) -> str:
        c = chr(code)
        low = LOOKS.get(c.lower()) or DIGITS.get(c)
        if low is None:
            base = [LOOKS.get(x, x) for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x)]
            low = "".join(x if x.isalpha() else " " for x in base)
            if unicodedata.combining(c) or unicodedata.category(c) == "Cf":
                low = ""
        if len(self) < 50_000:
            self[code] = low
        return low


_FOLDING = _Folding()


def folded(text: str | None) -> str:
    """``" word word ... "``"""
    return f" {' '.join((text or '').translate(_FOLDING).split())} "


def forms(word: str) -> list[str]:
    """The entries that match a word: ``" word "`` and beginnings as ``" wor"``."""
    whole = [f" {word} "] if len(word) > 2 else []
    return whole + [" " + word[:n] for n in BEGINNINGS if len(word) >= n]


def features(text: str | None) -> set[str]:
    return {f for w in set(folded(text).split()) for f in forms(w)}


class _Marks:
    """Says of a string whether it may be in a table; never no if it is."""

    def __init__(self, table: DataFrame, column: str):
        at = table.select(F.pmod(F.xxhash64(column), F.lit(_BUCKETS)).cast("int").alias("at")).distinct()
        bits = np.zeros(_BUCKETS, np.uint8)
        bits[at.toArrow().column(0).to_numpy()] = 1
        self.packed, self.bits = np.packbits(bits).tobytes(), None

    def __getstate__(self) -> dict:
        return {"packed": self.packed, "bits": None}

    def __contains__(self, value: str) -> bool:
        if self.bits is None:
            self.bits = np.unpackbits(np.frombuffer(self.packed, np.uint8)).tobytes()
        return self.bits[xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 42) % _BUCKETS] == 1


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-20.0, 0.0, 0.0)
    #: What the automaton does not hold: marks of entries and of exceptions.
    more: _Marks | None = None
    more_exceptions: _Marks | None = None

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for entry, w in self.weights.items():
            a.add_word(entry, (len(entry), w))
        for phrase in self.exceptions:
            a.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(a):
            a.make_automaton()
        return a

    def measure(self, automaton, text: str | None) -> tuple[float, float]:
        """Sum of weights, and that sum by the root of the number of words."""
        if not len(automaton):
            return 0.0, 0.0
        s = folded(text)
        found = [(end - size + 1, end, w) for end, (size, w) in automaton.iter(s)]
        if not found:
            return 0.0, 0.0
        free = [(a, b) for a, b, w in found if w is None]
        total = sum(w for a, b, w in found if w is not None and not any(x <= a and b <= y for x, y in free))
        return total, total / math.sqrt(max(1, s.count(" ") - 1))

    def hits(self, automaton) -> Memo:
        """Of each word its entries as (entry, weight); without weight if the entry may be outside the automaton."""

        def of(word: str) -> list[tuple[str, float | None]]:
            found = [(f" {word} "[end - size + 1 : end + 1], w) for end, (size, w) in automaton.iter(f" {word} ") if w is not None] if len(automaton) else []
            known = {f for f, _ in found}
            return found + [(f, None) for f in forms(word) if self.more is not None and f not in known and f in self.more]

        return Memo(of)

    def sure_and_open(self, hits: Memo, exceptions: set[str], text: str | None) -> tuple[float, list[dict], int]:
        """Sum of the weights that are certain, the matches that tables decide, and the number of words."""
        words = folded(text).split()
        total, left_open = 0.0, []
        for k, word in enumerate(words):
            found = hits[word]
            if not found:
                continue
            before = f"{words[k - 1]} {word}" if k else None
            after = f"{word} {words[k + 1]}" if k + 1 < len(words) else None
            if before in exceptions or after in exceptions:
                continue
            covered = self.more_exceptions is not None and any(p is not None and p in self.more_exceptions for p in (before, after))
            for f, w in found:
                if w is None or covered:
                    left_open.append({"feature": f, "weight": w, "before": before, "after": after})
                else:
                    total += w
        return total, left_open, len(words)


@dataclass
class Tables:
    """A lexicon's entries (feature, weight) and exceptions (feature) that the automaton does not hold."""

    entries: DataFrame | None = None
    exceptions: DataFrame | None = None


def _sums(training: DataFrame, found, toxic_col: str) -> DataFrame:
    """(feature, n0, n1): documents of either label in which ``found(text)`` has the feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(set(n[0]) | set(n[1]))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([n[0][k] for k in keys], pa.int64()), pa.array([n[1][k] for k in keys], pa.int64())], names=["feature", "n0", "n1"])

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n[y].update(found(text))
                if len(n[0]) + len(n[1]) > 300_000:
                    yield out()
                    n[0].clear()
                    n[1].clear()
        yield out()

    return training.select("text", toxic_col).mapInArrow(count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def admitted(counts: DataFrame, n0: int, n1: int, least_odds: float, chance: float) -> DataFrame:
    """(feature, weight, evidence) of (feature, n0, n1): entries whose log-odds reach ``least_odds`` and whose toxic
    documents would be so many by accident with a probability of ``chance`` at most, by Chernoff's bound; without
    those of which an admitted shorter beginning says as much, give or take 1."""
    q, n, b = n1 / (n0 + n1), F.col("n0") + F.col("n1"), F.col("n1") / (F.col("n0") + F.col("n1"))
    other = F.when(F.col("n0") > 0, F.col("n0") * F.log((1 - b) / F.lit(max(1 - q, 1e-300)))).otherwise(0.0)
    weight = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    strong = counts.select("feature", weight.alias("weight"), (b * n * F.log(b / q) + other).alias("evidence"))
    strong = written(strong.filter((F.col("weight") >= least_odds) & (F.col("evidence") >= -math.log(chance))))
    begins = F.array_compact(F.array(*(F.when(F.length("feature") > k + 1, F.substring("feature", 1, k + 1)) for k in BEGINNINGS)))
    shorter = strong.select(F.col("feature").alias("begin"), F.col("weight").alias("says"))
    said = strong.select("feature", "weight", F.explode(begins).alias("begin")).join(shorter, "begin").filter("says >= weight - 1")
    return strong.join(said.select("feature").distinct(), "feature", "left_anti")


class _Candidates:
    """A text's features among the marked ones."""

    def __init__(self, marks: _Marks):
        self.marks = marks

    def __call__(self, text: str) -> set[str]:
        memo = self.__dict__.setdefault("memo", Memo(self.marks.__contains__))
        return {f for f in features(text) if memo[f]}


class _Around:
    """The pairs of words around an entry."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __call__(self, text: str) -> set[str]:
        if "hits" not in self.__dict__:
            self.hits = self.lexicon.hits(self.lexicon.automaton())
        w = folded(text).split()
        return {f"{w[k]} {w[k + 1]}" for h, x in enumerate(w) if self.hits[x] for k in (h - 1, h) if 0 <= k < len(w) - 1}


def _split(table: DataFrame, rank: str, held: int) -> tuple[list, DataFrame | None]:
    """The ``held`` rows of the highest ``rank`` (ties by feature), and a table of the others if there are any."""
    table = written(table)
    first = table.orderBy(F.desc(rank), "feature").limit(held).collect()
    if len(first) < held or table.count() == held:
        return first, None
    names = table.sparkSession.createDataFrame([(r["feature"],) for r in first], "feature string")
    return first, written(table.join(names, "feature", "left_anti"))


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of two features with a small ridge, by Newton's steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(3)
        step = np.linalg.solve(h, a.T @ (y - p) - 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def learn(training: DataFrame, *, text_col: str = "text", toxic_col: str = "toxic", least_odds: float = 3.0, chance: float = 0.001, least_docs: int = 4, held: int = 200_000, fit_rows: int = 20_000) -> tuple[Lexicon, Tables]:
    """A lexicon from labelled texts. Three passes count; the curve is fitted on at most ``fit_rows`` rows.

    An entry must occur in ``least_docs`` toxic documents and pass ``admitted``; an exception must occur in
    ``least_docs`` harmless documents and four times as often, by share, as in toxic ones. Neither is asked for a
    share of the corpus, so that what is rare counts alike at every size. ``held`` bounds the automaton, not the
    lexicon.
    """
    rows = training.select(F.col(text_col).cast("string").alias("text"), F.col(toxic_col).cast("int").alias("toxic")).dropna().filter("toxic in (0, 1)")
    rows = written(rows)
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n1:
        return Lexicon({}, [], (-20.0, 0.0, 0.0)), Tables()
    toxic = written(_sums(rows.filter("toxic = 1"), features, "toxic").filter(F.col("n1") >= least_docs).select("feature", "n1"))
    clean = _sums(rows.filter("toxic = 0"), _Candidates(_Marks(toxic, "feature")), "toxic").select("feature", "n0")
    counts = toxic.join(clean, "feature", "left").na.fill(0, ["n0"])
    strongest, entries = _split(admitted(counts, n0, n1, least_odds, chance), "evidence", held)
    lexicon = Lexicon({r["feature"]: r["weight"] for r in strongest})
    lexicon.more = _Marks(entries, "feature") if entries is not None else None
    harmless = _sums(rows, _Around(lexicon), "toxic").filter((F.col("n0") >= least_docs) & (F.col("n0") * n1 > 4 * F.col("n1") * n0))
    common, exceptions = _split(harmless.select("feature", "n0"), "n0", held)
    lexicon.exceptions = sorted(r["feature"] for r in common)
    lexicon.more_exceptions = _Marks(exceptions, "feature") if exceptions is not None else None
    tables = Tables(entries, exceptions)
    share = min(1.0, fit_rows / (n0 + n1))
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000)).limit(fit_rows)
    data = measured(sample, lexicon, tables, "toxic").select("toxic", "total", "dense").toPandas()
    if data["toxic"].nunique() == 2:
        lexicon.curve = _fit(data[["total", "dense"]].to_numpy(float), data["toxic"].to_numpy(float))
    else:
        rate = n1 / (n0 + n1)
        lexicon.curve = (math.log(rate / (1 - rate)) if rate < 1 else 20.0, 0.0, 0.0)
    return lexicon, tables


def measured(docs: DataFrame, lexicon: Lexicon, tables: Tables, *keep: str, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``total`` and ``dense``, the lexicon's sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            pairs = [lexicon.measure(automaton, t) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array([a for a, _ in pairs], pa.float64()), pa.array([b for _, b in pairs], pa.float64())], names=[*keep, "total", "dense"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    text = F.col(text_col).cast("string").alias("_text")
    if lexicon.more is None and lexicon.more_exceptions is None:
        return docs.select(*keep, text).mapInArrow(run, f"{kinds}, total double, dense double")
    match = "struct<feature: string, weight: double, before: string, after: string>"
    kind = pa.list_(pa.struct([("feature", pa.string()), ("weight", pa.float64()), ("before", pa.string()), ("after", pa.string())]))

    def run_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, exceptions = lexicon.hits(lexicon.automaton()), set(lexicon.exceptions)
        for batch in batches:
            found = [lexicon.sure_and_open(hits, exceptions, t) for t in batch.column(len(keep) + 2).to_pylist()]
            sums = [pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], kind), pa.array([x[2] for x in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep) + 2], *sums], names=[*keep, "_a", "_b", "_sure", "_open", "_words"])

    # What is left open depends on the text alone, so copies are asked once.
    a, b = F.xxhash64("_text").alias("_a"), F.xxhash64(F.lit(1), "_text").alias("_b")
    rows = docs.select(*keep, text).select(*keep, a, b, "_text")
    rows = written(rows.mapInArrow(run_open, f"{kinds}, _a long, _b long, _sure double, _open array<{match}>, _words long"))
    asked = rows.filter(F.size("_open") > 0).groupBy("_a", "_b").agg(F.first("_open").alias("_open"))
    asked = asked.select("_a", "_b", F.explode("_open").alias("m")).select("_a", "_b", "m.*").withColumn("_salt", F.pmod("_a", F.lit(_SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    if tables.entries is not None:
        entries = tables.entries.select("feature", F.col("weight").alias("_weight")).withColumn("_salt", salts)
        asked = asked.join(entries, ["feature", "_salt"], "left").withColumn("weight", F.coalesce("weight", "_weight")).filter("weight is not null")
    if tables.exceptions is not None:
        for side in ("before", "after"):
            asked = asked.join(tables.exceptions.select(F.col("feature").alias(side)).withColumn("_salt", salts), [side, "_salt"], "left_anti")
    extra = asked.groupBy("_a", "_b").agg(F.sum("weight").alias("_extra")).withColumn("_salt", salts)
    own = F.pmod(F.xxhash64(*keep), F.lit(_SALTS)).cast("int")
    total = F.col("_sure") + F.coalesce("_extra", F.lit(0.0))
    out = rows.filter(F.size("_open") > 0).withColumn("_salt", own).join(extra, ["_a", "_b", "_salt"], "left")
    closed = rows.filter(F.size("_open") == 0).withColumn("_extra", F.lit(0.0))
    names = [*keep, "_sure", "_extra", "_words"]
    return out.select(names).unionByName(closed.select(names)).select(*keep, total.alias("total"), (total / F.sqrt(F.greatest("_words", F.lit(1)))).alias("dense"))


def score(docs: DataFrame, model: tuple[Lexicon, Tables], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5)."""
    lexicon, tables = model
    a, b, c = lexicon.curve
    z = F.lit(a) + F.lit(b) * F.col("total") + F.lit(c) * F.col("dense")
    out = measured(docs, lexicon, tables, id_col, text_col=text_col).withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0)))))
    return out.select(id_col, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
