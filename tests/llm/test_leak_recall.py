"""Reworded leaks against the rule itself, window by window, where one item or many are held by half of all documents."""
from __future__ import annotations

import random

import pytest

from loanloom.llm import decontamination as dc


def _word(rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))


def _passes(words: list[str], item: list[str]) -> bool:
    w = dc.widths([len(item)])[0]
    step, margin = max(1, w // 4), w // 4 + 1
    for s in range(0, max(1, len(words) - w + step), step):
        window = words[max(0, s - margin) : s + w + margin]
        share, last = dc.common_subsequence(item, window) / len(item), dc.common_subsequence(item[-15:], window) / 15
        if share >= 0.8 or share >= 0.6 and last >= 0.5:
            return True
    return False


@pytest.mark.parametrize(("replaced", "held"), [(0.3, 1), (0.38, 1), (0.38, 40)])
def test_recall_of_reworded_leaks(spark, replaced, held):
    rng = random.Random(5)
    vocabulary = [_word(rng) for _ in range(4000)]
    items = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(40)]
    rows = []
    for k in range(100):
        text = [rng.choice(vocabulary) if rng.random() < 0.5 else _word(rng) for _ in range(400)]
        if k < 50:
            copy = items[k % held][:]
            for i in rng.sample(range(60), int(60 * replaced)):
                copy[i] = _word(rng)
            at = rng.randrange(400)
            text[at:at] = copy
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.leaks(docs, bench).collect()}
    want = {(k, i) for k, t in rows for i, x in enumerate(items) if len(set(t.split()) & set(x)) >= 30 and _passes(t.split(), x)}
    assert len(want) > 40 and len(want & got) >= 0.95 * len(want) and got <= want
