"""Quality rules: one table of thresholds compiled into a Spark projection, built-in functions only.

Defined cases: null and empty texts have no words, all counts are 0 and the base rule (too few words) fails them;
repeated rows are judged one by one; other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (statistic, divisor or None, least or None, most or None): a ratio outside its bounds rejects the document.
RULES: list[tuple[str, str | None, float | None, float | None]] = [
    ("n_words", None, 10, None),
    ("word_chars", "n_words", 1.5, 14.0),
    ("n_symbols", "n_words", None, 0.2),
    ("n_dup_lines", "n_lines", None, 0.5),
    ("n_stop", "n_words", 0.02, None),
]
#: Frequent function words of the languages the rules are meant for.
STOP_WORDS = ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are", "this", "or", "an", "at", "from", "de", "la", "le", "les", "et", "des", "en", "un", "une", "du", "que", "qui", "dans", "est", "par", "pour", "au", "sur", "el", "los", "del", "las", "se", "con", "no", "su", "al", "lo", "y", "der", "die", "und", "das", "von", "den", "zu", "ist", "mit", "sich", "auf", "ein", "eine", "für", "im", "dem", "nicht", "auch"]
_SPACE = "[\\x20\\x09-\\x0D]"


def _duplicated(h: Column, width: int) -> Column:
    """Words in windows whose hash occurs twice or more; ``h``: hashes of the windows, by start."""
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    starts = lambda s: F.array_sort(
        F.filter(
            F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])),
            lambda x: x.isNotNull(),
        )
    )
    # every start covers the words up to the next one, at most a window
    covered = lambda d: F.aggregate(F.transform(d, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(d, k + 1) - x, F.lit(width)))), F.lit(0), lambda a, b: a + b)
    # one-element arrays name the intermediate arrays, so each is made once
    return F.get(F.transform(F.transform(F.array(pairs), starts), covered), F.lit(0))


def statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """Per document: word, character, symbol, line, stop-word and repetition counts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    has_word = lambda s: F.length(F.regexp_replace(s, f"{_SPACE}+", "")) > 0
    split = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id",
        "text",
        F.filter(F.split("text", f"{_SPACE}+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), has_word).alias("lines"),
    )
    w = F.col("words")
    counted = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", f"{_SPACE}+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop"),
        F.when(F.size("words") >= width, F.transform(F.sequence(F.lit(0), F.size("words") - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    repeats = F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0)).otherwise(_duplicated(F.col("windows"), width))
    return counted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop", repeats.cast("long").alias("n_repeat_words"))


def compiled(rules=RULES) -> Column:
    """True if every rule holds; a ratio by 0 breaks none."""
    held = F.lit(True)
    for name, by, least, most in rules:
        value = F.col(name).cast("double")
        if by:
            value = F.when(F.col(by) > 0, value / F.col(by))
        for bound, ok in ((least, lambda v, b: v >= b), (most, lambda v, b: v <= b)):
            if bound is not None:
                held = held & F.coalesce(ok(value, F.lit(float(bound))), F.lit(True))
    return held


def judged(docs: DataFrame, rules=RULES, **columns) -> DataFrame:
    """The statistics with ``base_failed`` and the verdict ``kept``."""
    stats = statistics(docs, **columns)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compiled(rules))
