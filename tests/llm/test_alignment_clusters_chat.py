"""Operators 11 to 13 against brute force, and on odd rows."""
from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers as known
import pytest
from pyspark.sql import functions as F

from loanloom.llm import centroid_clustering, chat_format, token_alignment

A, B = known.path("byte_bpe_50k.json"), known.path("piece_bpe_32k.model")
ODD = ["", None, " ", "\n", "a", " a", "a  b", "a \n b", "\n\na\n\nb\n", "x\ty <|endoftext|> <s> </s> <unk> <0x41> z", "▁", "日本語 テキスト 🙂🙂 ok", "it's we'll I'd", "no break ls", "ﬁ Å Å é", "a\r\nb\x0bc\x1cd\x85e", "12345 67890 12,5", "dup dup dup dup", "dup dup dup dup", "tail \n", "tail\t", "a\x00b", "   lead", "trail   ", "a " * 50, "zz\n" * 9, "x" * 300]


def aligned(texts: list[str | None]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    t, sp, letters = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), token_alignment.byte_letters()
    t.encode_special_tokens = True
    names, docs, pairs = {i: c for c, i in t.get_vocab().items()}, [], Counter()
    for text in texts:
        a, b = (t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        raw_a = [bytes(letters[c] for c in names[i]) for i in a]
        raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            docs.append(None)
            continue
        at = lambda raw: list(itertools.pairwise(itertools.accumulate(map(len, raw), initial=0)))
        spans_a, spans_b = at(raw_a), at(raw_b)
        links = [(x, y) for x, (s, e) in zip(a, spans_a) for y, (u, v) in zip(b, spans_b) if s < v and u < e]
        cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups = [(0 if k == 0 else cuts[k - 1], c) for k, c in enumerate(cuts)]
        inside = lambda ids, spans, s, e: ",".join(str(i) for i, (u, v) in zip(ids, spans) if s <= u and v <= e)
        docs.append((len(a), len(b), links, ";".join(f"{inside(a, spans_a, *g)}|{inside(b, spans_b, *g)}" for g in groups), len(groups)))
        pairs.update(set(links))
    top = Counter()
    for (x, _), n in pairs.items():
        top[x] = max(top[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (d[0], d[1], d[4], len(d[2]), sum(pairs[p] == top[p[0]] for p in d[2]), sum(pairs[p] for p in d[2]), d[3]) for d in docs]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy(F.length("text")).limit(60).collect()
    return ODD + [r["text"] for r in rows] + [rows[30]["text"]] * 20


@pytest.mark.parametrize("bounds", [{}, {"run_links": 300, "fan_in": 2, "stretch": 40}])
def test_alignment_equals_brute_force(spark, texts, bounds):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_a", F.lit("x")).repartition(4)
    got = {r[0]: tuple(r[1:]) for r in token_alignment.align(docs, A, B, **bounds).collect()}
    assert [got[k] for k in range(len(texts))] == aligned(texts)


def test_alignment_digests_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], "doc_id long, text string")
    text = token_alignment.align(docs, A, B).select("doc_id", F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("").alias("g"), "count_sum").collect()
    digest = token_alignment.align(docs, A, B, digest=True).select("doc_id", F.col("groups").alias("g"), "count_sum").collect()
    assert Counter(text) == Counter(digest) and len(text) == 4 and {r["count_sum"] for r in text if r["doc_id"] != 2} == {3 * 2}
    assert token_alignment.align(docs.limit(0), A, B).count() == 0


def test_ranks_code_as_the_whole_tokenizer():
    side, rng = token_alignment.ByteLevel(A), random.Random(7)
    assert side.ranks is not None
    signs = "abcdeéßüñ  \t'\"0123,.!?-_()#<|>🙂日本 "
    for _ in range(3000):
        chunk = "".join(rng.choice(signs) for _ in range(rng.randint(1, 30)))
        assert side.code(chunk) == side.whole.encode(chunk, add_special_tokens=False).ids


def test_heap_merge_sums_equal_pairs():
    rng = np.random.default_rng(3)
    runs = [np.unique(rng.integers(0, 40_000, n)) for n in (0, 1, 30_000, 20_000, 9000)]
    merged = list(token_alignment.heap_merged([token_alignment.framed(r, np.full(len(r), 1 + k)) for k, r in enumerate(runs)]))
    pairs, counts = (np.concatenate(x) for x in zip(*merged))
    want = Counter()
    for k, r in enumerate(runs):
        want.update({int(p): 1 + k for p in r})
    assert dict(zip(pairs.tolist(), counts.tolist())) == want and (np.diff(pairs) > 0).all()


def lloyd(rows: list[tuple], k: int, rounds: int, scale: int = 256) -> tuple[dict, np.ndarray]:
    x = np.array([np.floor(scale * np.array(v, np.float64)) for _, v in rows]).astype(np.int64)
    start = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"2:{rows[i][0]}".encode()).hexdigest(), x[i].tolist()))[:k]
    c = x[start]
    for r in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        near = d.argmin(1)
        if r < rounds:
            c = np.stack([x[near == j].sum(0) // max(1, (near == j).sum()) if (near == j).any() else c[j] for j in range(len(c))])
    return {rows[i][0]: (int(near[i]), int(d[i, near[i]])) for i in range(len(rows))}, c


@pytest.mark.parametrize(("n", "k", "size", "spread"), [(700, 12, 8, 1.0), (300, 40, 3, 0.02), (5, 9, 4, 1.0), (40, 1, 4, 1.0)])
def test_clusters_equal_plain_rounds(spark, n, k, size, spread):
    rng = np.random.default_rng(n)
    rows = [(i, (spread * rng.normal(size=size) + rng.integers(0, 3)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(n // 3)]  # a hot vector
    odd = [(-1, None), (-2, []), (-3, [1.0] * (size + 1)), (-4, [float("nan")] * size), (-5, [float("inf")] + [0.0] * (size - 1)), (-6, [None] + [0.0] * (size - 1))]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("a", F.lit(1)).repartition(3)
    found = centroid_clustering.cluster(vectors, k, size=size, start_hash=F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256))
    want, centroids = lloyd(rows, k, 5)
    assert {r["vec_id"]: (r["cluster"], r["distance"]) for r in found.assigned.collect()} == want
    assert {r["cluster"]: (r["centroid"], r["inertia"]) for r in found.centroids.collect()} == {j: (c.tolist(), sum(d for m, d in want.values() if m == j)) for j, c in enumerate(centroids)}


def test_search_measures_few_centroids():
    rng = np.random.default_rng(5)
    c = rng.integers(-4000, 4000, (200, 16))
    x = (c[rng.integers(0, 200, 4000)] + rng.integers(-300, 300, (4000, 16))).astype(np.int64)
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    a, b = d.argmin(1), np.zeros(4000, np.int64)
    looked = centroid_clustering.Ring(c).search(x, a.copy(), b, np.full(4000, np.inf), np.zeros(4000))
    assert looked < 4000 * 200 / 2  # the ball leaves out most centroids
    second = np.partition(d, 1, axis=1)[:, 1]
    upper, lower = np.sqrt(d[np.arange(4000), a]), np.sqrt(second)
    assert centroid_clustering.Ring(c).search(x, a.copy(), b, upper, lower) == 0  # bounds alone settle them


def test_clusters_of_nothing_and_of_the_largest(spark):
    rows = [(None, [3e38] * 4), (1, [-3e38] * 4), (1, [0.0] * 4), (1, [0.0] * 4)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert centroid_clustering.cluster(vectors.limit(0), 3, size=4).assigned.count() == 0
    found = centroid_clustering.cluster(vectors, 4, size=4)
    assert found.assigned.count() == 4 and found.assigned.agg(F.sum("distance")).first()[0] == 0


BITS = ["<|im_start|>", "<|im_end|>", "\n", "<", "|", "\\", "a", "<\\|", "im_end|>", "<|", "assistant", "\\n", "\\b", "\\p", "é🙂", "$1", "", " "]


def test_chats_read_back(spark):
    rng, rows = random.Random(1), []
    made = lambda n: "".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))
    for c in range(300):
        rows += [(c, t, rng.choice(["user", "assistant", "system", made(4), None]), rng.choice([made(12), made(3), None])) for t in range(rng.randint(1, 4))]
    rows += [(None, None, None, None), (None, 1, "assistant", "x" * 200_000)] + [(-7, 0, "user", "twice")] * 2
    chats = chat_format.chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("k", F.lit(1)))
    formatted = {r["conv_id"]: r for r in chats.collect()}
    read = {r["conv_id"]: r for r in chat_format.read_back(chats).collect()}
    assert all(r["identical"] for r in formatted.values())
    for conv, turns in itertools.groupby(rows, lambda r: r[0]):
        turns = [(r or "", t or "") for _, _, r, t in turns]
        assert [tuple(t) for t in read[conv]["turns"]] == turns
        assert read[conv]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
        whole = formatted[conv]["formatted"]
        assert read[conv]["formatted_chars"] == len(whole)
        for m in formatted[conv]["loss"]:
            assert whole[: m["start"]].endswith(f"{chat_format.START}assistant\n") and whole[m["start"] + m["length"] :].startswith(chat_format.END)


def test_plain_chats_stay_plain(spark):
    chats = spark.createDataFrame([(1, 0, "user", "a < b | c \\ <|x|>"), (1, 1, "assistant", "<|im_end|>")], "conv_id long, turn long, role string, text string")
    out = chat_format.chat(chats)
    assert out.first()["formatted"] == "<|im_start|>user\na < b | c \\ <|x|><|im_end|>\n<|im_start|>assistant\n<\\|im_end|><|im_end|>\n"
    assert chat_format.chat(chats.limit(0)).count() == 0
    assert not any(w in out._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Arrow", "Pandas"))


def test_broken_chats_do_not_parse(spark):
    broken = ["x", "<|im_start|>user<|im_end|>\n", "<|im_start|>user\na<|im_start|>b<|im_end|>\n", "<|im_start|>user\na<|im_end|>", "<|im_start|>user\na<|im_end|>\ntail"]
    rows = spark.createDataFrame([(x,) for x in broken + [""]], "f string").select(chat_format.parsed(F.col("f")).alias("t")).collect()
    assert [r["t"] for r in rows] == [None] * 5 + [[]]
