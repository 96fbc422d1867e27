"""The toxicity lexicon against plain counting, with an automaton that holds all and one that holds hardly any."""
import math
import random

import pytest

from loanloom.llm import toxicity

RUDE = ["idiot", "idiotic", "moron", "scumbag", "dolt", "dolt", "dolt", "dolt"]


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(3)
    plain = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}x" for k in range(80)]
    rows = []
    for k in range(600):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 40))]
        toxic = int(k % 6 == 0)
        if toxic and k % 30:
            w.insert(rng.randint(0, len(w)), rng.choice(RUDE))
        if not toxic and k % 120 == 1:
            w += ["the", "dolt", "bird"]
        rows.append((" ".join(w), toxic))
    return rows + [(rows[0][0], 1)] * 40 + [(None, 1), ("", 0), ("idiot", None)]


def brute(rows, chance=0.001, least_odds=3.0, least_docs=4):
    rows = [(t, y) for t, y in rows if t is not None and y is not None]
    n1 = sum(y for _, y in rows)
    n0, q = len(rows) - n1, n1 / len(rows)
    count = {}
    for t, y in rows:
        for w in {f for x in set(toxicity.folded(t).split()) for f in toxicity.forms(x)}:
            count.setdefault(w, [0, 0])[y] += 1
    strong = {}
    for f, (a, b) in count.items():
        n = a + b
        gain = (b * math.log(b / n / q) if b else 0) + (a * math.log(a / n / (1 - q)) if a else 0)
        odds = math.log((b + 0.5) / (n1 + 1)) - math.log((a + 0.5) / (n0 + 1))
        if b >= least_docs and odds >= least_odds and gain >= -math.log(chance):
            strong[f] = odds
    weights = {f: v for f, v in strong.items() if not any(n + 1 < len(f) and strong.get(f[: n + 1], -1e9) >= v - 1 for n in toxicity.BEGINNINGS)}
    pairs = {}
    for t, y in rows:
        w = toxicity.folded(t).split()
        hit = [any(f in weights for f in toxicity.forms(x)) for x in w]
        for p in {f"{w[k]} {w[k + 1]}" for k in range(len(w) - 1) if hit[k] or hit[k + 1]}:
            pairs.setdefault(p, [0, 0])[y] += 1
    return weights, {p for p, (a, b) in pairs.items() if a >= least_docs and a * n1 > 4 * b * n0}


def total(text, weights, exceptions):
    w = toxicity.folded(text).split()
    free = lambda k: any(0 <= j < len(w) - 1 and f"{w[j]} {w[j + 1]}" in exceptions for j in (k - 1, k))
    return sum(weights.get(f, 0.0) for k, x in enumerate(w) if not free(k) for f in toxicity.forms(x))


ASKED = [(1, "you idiot and MORON"), (2, "the dolt bird sang"), (3, "a dolt"), (4, None), (5, ""), (6, "1d1ot " * 3), (6, "1d1ot " * 3), (None, "scumbag"), (7, "waax " * 20000 + "moron"), (8, "the dolt the dolt bird idiotic")]


@pytest.mark.parametrize("held", [200_000, 2, 1])
def test_counts_sums_and_exceptions(spark, labelled, held):
    weights, exceptions = brute(labelled)
    assert {"the dolt", "dolt bird"} <= exceptions and len(weights) > 3
    model = toxicity.learn(spark.createDataFrame(labelled, "text string, toxic int").repartition(5), held=held)
    lexicon, tables = model
    got = dict(lexicon.weights) | ({r["feature"]: r["weight"] for r in tables.entries.collect()} if tables.entries is not None else {})
    assert got == pytest.approx(weights) and len(lexicon.weights) == min(held, len(weights))
    more = [r["feature"] for r in tables.exceptions.collect()] if tables.exceptions is not None else []
    assert sorted(lexicon.exceptions + more) == sorted(exceptions)
    docs = spark.createDataFrame(ASKED, "doc_id long, text string")
    out = toxicity.measured(docs, lexicon, tables, "doc_id").collect()
    want = sorted((str(k), total(t, weights, exceptions)) for k, t in ASKED)
    assert [k for k, _ in want] == sorted(str(r["doc_id"]) for r in out)
    assert [x for _, x in sorted((str(r["doc_id"]), r["total"]) for r in out)] == pytest.approx([x for _, x in want])
    for r in out:
        if r["doc_id"] == 7:
            assert r["dense"] == pytest.approx(r["total"] / math.sqrt(20001))
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect() if r["doc_id"] in (1, 2, 5)} == {1: 1, 2: 0, 5: 0}


def test_rare_entries_count_at_every_size(spark):
    """Four documents make an entry, among a hundred toxic ones and among thousands."""
    for n in (100, 4000):
        rows = [(f"plain words {'dreadword' if k < 4 else 'rude'}", 1) for k in range(n)] + [("plain words here", 0)] * (n * 5)
        lexicon, _ = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"))
        assert any(f.strip() and "dreadword".startswith(f.strip()) for f in lexicon.weights)
