"""The whole pipeline against a second one in plain Python, written for small inputs."""
from __future__ import annotations

import collections
import json
import random

import numpy as np
import xxhash
from test_leak_recall import _passes
from test_operators import _kneser_ney

PLAIN = [f"w{k}" for k in range(400)]


def _documents():
    """Texts of few words, junk, copies and near copies, a passage in many texts, leaks whole and reworded."""
    rng = random.Random(21)
    say = lambda n: " ".join(rng.choice(PLAIN) for _ in range(n))
    rows = [say(rng.randint(60, 160)) for _ in range(90)]
    trusted = set(range(60))
    rows += [" ".join(f"zq{rng.randrange(10**9)}" for _ in range(80)) for _ in range(12)]
    for t in rows[:8]:
        w = t.split()
        w[len(w) // 2] = "changed"
        rows += [t, t, " ".join(w), " ".join(w[:-1])]
    passage = say(70)
    rows += [f"{say(rng.randint(20, 50))} {passage} {say(rng.randint(20, 50))}" for _ in range(9)] + [passage, f"{passage} {passage}"]
    items = [[f"q{rng.randrange(300)}" if rng.random() < 0.2 else rng.choice(PLAIN) for _ in range(60)] for _ in range(5)]
    for k, item in enumerate(items[:4]):
        w = item[:]
        for i in rng.sample(range(60), 9 * (k % 2)):
            w[i] = rng.choice(PLAIN)
        rows += [f"{say(50 + k)} {' '.join(w)} {say(40)}"]
    return [*rows, None, "", "w1", "w1 w2 w3 w4 w5 w6"], trusted, items


def _perplexity(p, text):
    w = ["<s>", *(text or "").split(), "</s>"]
    return 10 ** -np.mean([np.log10(p(w[i], (w[i - 1],))) for i in range(1, len(w))])


def _kept_by_quality(docs, trusted):
    held = {k for k in trusted if xxhash.xxh64_intdigest(int(k).to_bytes(8, "little"), 42) in _fifth}
    p, _ = _kneser_ney([docs[k] for k in trusted - held], 2)
    bound = 1.15 * sorted(_perplexity(p, docs[k]) for k in held)[int(np.ceil(0.99 * len(held))) - 1]
    return {k: t for k, t in docs.items() if _perplexity(p, t) <= bound}


class _Fifth:
    """Hashes that are multiples of five when taken as signed numbers."""

    def __contains__(self, h: int) -> bool:
        return (h - (1 << 64) if h >> 63 else h) % 5 == 0


_fifth = _Fifth()


def _one_of_each(docs):
    sets = {}
    for k, t in docs.items():
        w = (t or "").lower().split()
        sets[k] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    root = {k: k for k in docs}
    find = lambda x: x if root[x] == x else find(root[x])
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: t for k, t in docs.items() if find(k) == k}


def _without_repeats(docs, length=200):
    count = collections.Counter(t[i : i + length] for t in docs.values() for i in range(len(t or "") - length + 1))
    out = {}
    for k, t in docs.items():
        gone = set()
        for i in range(len(t or "") - length + 1):
            if count[t[i : i + length]] > 1:
                gone.update(range(i, i + length))
        rest = "".join(c for i, c in enumerate(t) if i not in gone) if gone else t
        if not gone or rest:
            out[k] = rest
    return out


def test_pipeline_against_plain_python(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    texts, trusted, items = _documents()
    rows = [(k, t, "en" if k % 3 else None, "s", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k in trusted), 0) for k in range(len(rows))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    whole = dict(enumerate(texts))
    want = [_kept_by_quality(whole, trusted)]
    want.append(_one_of_each(want[-1]))
    want.append(_without_repeats(want[-1]))
    want.append({k: t for k, t in want[-1].items() if not any(_passes((t or "").split(), x) for x in items)})
    sizes = [len(whole), *map(len, want)]
    assert all(a > b for a, b in zip(sizes, sizes[1:]) if (a, b) != (sizes[2], sizes[3])), sizes
    assert want[2] != {k: want[1][k] for k in want[2]}

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), kept in zip(corpus_pipeline.STAGES, want):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        got = {r["doc_id"]: r for r in docs.collect()}
        assert {k: r["text"] for k, r in got.items()} == kept, (name, json.dumps(sorted(set(got) ^ set(kept))))
        assert all(r["n_chars"] == len(r["text"] or "") and r["lang"] == ("en" if k % 3 else None) for k, r in got.items())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(want[-1])
    for k, t in want[-1].items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert b"".join(bytes(p["ids"]) for p in sorted(pieces[k], key=lambda p: p["start"])) == ids
    for s in sequences.values():
        s = sorted(s, key=lambda p: p["offset"])
        assert [p["offset"] for p in s] == [sum(q["length"] for q in s[:i]) for i in range(len(s))] and sum(p["length"] for p in s) <= 4096
