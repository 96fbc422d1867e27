"""Every operator on small fixtures: brute force, round trips, and the defined cases."""
import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.llm import decontamination, graph, html_extract, jaccard_join, kneser_ney, language_id, maxent, packing, quality_rules, suffix_dedup, toxicity
from loanloom.llm.suffix_array import permuted_lcp, suffix_array
from loanloom.llm.text import Memo

DOCS = "doc_id long, text string, lang string, _bucket string, id string"
WORDS = [f"w{k}" for k in range(60)]


def _text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [_text(rng, rng.randint(3, 200)) for _ in range(30)]
    out = list(base)
    for t in base[:12]:
        out.append(t)  # a copy
        w = t.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    passage = _text(rng, 120)
    out += [f"{_text(rng, 20)} {passage} {_text(rng, 20)}" for _ in range(5)]
    return [*out, None, "", "   \n\t ", "one two", "é ü  x", "a" * 1500, "ab" * 700]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en", "x", "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_suffix_array_against_sorting():
    rng = random.Random(1)
    for size in (2, 3, 5, 250, 3000):
        for n in (1, 2, 7, 60):
            t = np.array([rng.randint(1, size - 1) for _ in range(n)] + [0], np.int64)
            sa = suffix_array(t, size)
            assert list(sa) == sorted(range(n + 1), key=lambda i: list(t[i:]))
            lcp = permuted_lcp(t.astype(np.uint16), sa)
            for a, b in zip(sa[1:], sa):
                k = next((k for k in range(n + 1) if max(a, b) + k > n or t[a + k] != t[b + k]), 0)
                assert lcp[a] == k


@pytest.mark.parametrize("most", [1, 256])
def test_repeated_strings_against_brute_force(docs, texts, most):
    length = 100
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, length=length, gram=32, most=most).collect()}
    assert len(got) == len(texts)
    for k, r in enumerate(raw):
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = True
        assert got[k]["n_bytes"] == len(r) and bytes(got[k]["kept"]) == np.frombuffer(r, np.uint8)[~gone].tobytes()
        assert sum(s["hi"] - s["lo"] for s in got[k]["spans"]) == gone.sum()


def test_jaccard_components_against_brute_force(spark, docs, texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r for r in jaccard_join.join(docs).collect()}
    assert [got[k]["component_id"] for k in range(len(sets))] == [find(k) for k in range(len(sets))]
    assert [got[k]["n_shingles"] for k in range(len(sets))] == [len(s) for s in sets]


def test_jaccard_near_copies_of_near_copies(spark):
    """Chains and groups whose members are not all near one pivot."""
    rng = random.Random(9)
    rows, base = [], [f"b{k}" for k in range(80)]
    for k in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        rows.append((k, " ".join(w)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(76)} for _, t in rows]
    root = list(range(60))
    find = lambda x: x if root[x] == x else find(root[x])
    for i in range(60):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k] for k in range(60)] == [find(k) for k in range(60)]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5)], "a long, b long")
    assert {(r["node"], r["component"]) for r in graph.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7), (9, 7)}
    assert graph.components(edges.limit(0)).count() == 0


def test_packing_round_trip(docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    pieces = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in packing.pack(docs, path, window=64, open_windows=3).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for k, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert b"".join(bytes(p["ids"]) for p in sorted(pieces[k], key=lambda p: p["start"])) == ids
        assert all(p["doc_tokens"] == len(ids) // 4 for p in pieces[k])
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 64


def test_quality_rules_against_brute_force(docs, texts):
    import re

    got = {r["doc_id"]: r for r in quality_rules.judged(docs).collect()}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count, covered = collections.Counter(grams), set()
        for i, g in enumerate(grams):
            if count[g] > 1:
                covered.update(range(i, i + 5))
        assert (got[k]["n_words"], got[k]["word_chars"], got[k]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(covered))
        assert got[k]["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_word_numbers_do_not_depend_on_what_is_remembered():
    texts = [None, "", " ".join(f"w{k % 97}" for k in range(400)), "A b a", " ".join(f"x{k}." for k in range(90))]
    whole, small = Memo(maxent.number), Memo(maxent.number, 60)
    want = [maxent.read_text(whole, t) for t in texts]
    for t, w in zip(texts, want):
        assert np.array_equal(maxent.read_text(small, t), w)
    assert [len(w) for w in want] == [1, 1, 401, 4, 91] and want[3][0] == want[3][2] and len(set(want[2])) == 98


def test_sums_of_runs_and_bounded_softmax():
    rng = np.random.default_rng(3)
    for size in (0, 1, 7, 500):
        at, p, got = rng.integers(0, 40, size) ** 2 % 37, rng.random((size, 32), np.float32), np.zeros((37, 32))
        want = got.copy()
        np.add.at(want, at, p)
        maxent._add_rows(got, at, p)
        assert np.allclose(got, want, rtol=1e-4)
    w, b = (rng.random((50, 32)) * 24 - 12).astype(np.float32), np.log(rng.random(32) ** 30 + 1e-12).astype(np.float32)
    rows = [rng.integers(0, 50, 300) for _ in range(3)]
    s, e, z = maxent._softmax(w, w.max(1), b, b.max(), rows, np.arange(300) % 32)
    exact = sum(w[r].astype(float) for r in rows) + b
    exact -= np.log(np.exp(exact - exact.max(1)[:, None]).sum(1))[:, None] + exact.max(1)[:, None]
    assert np.allclose(s - np.log(z), exact[np.arange(300), np.arange(300) % 32], atol=1e-3) and np.allclose(e / z[:, None], np.exp(exact), atol=1e-5)


def test_maxent_is_a_distribution_and_counts_are_exact(spark, docs, texts):
    model = maxent.train(docs, head=5)
    got = {r["doc_id"]: r for r in maxent.score(docs, model).collect()}
    tokens = [(t or "").encode().lower().split() + [b""] for t in texts]
    count = collections.Counter(w for t in tokens for w in t)
    n, v = sum(count.values()), len(count)
    for k, t in enumerate(tokens):
        assert got[k]["base_score"] == pytest.approx(sum(np.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
        assert got[k]["n_known"] == len(t) == got[k]["n_tokens"] and got[k]["train_tokens"] == n
    rows = [np.array([r]) for r in (3, 9000, 9600)]
    total = sum(np.exp(model.weights.log_probability([np.repeat(r, maxent.CLASSES * maxent.MEMBERS) for r in rows], np.arange(maxent.CLASSES * maxent.MEMBERS))))
    assert total == pytest.approx(1, abs=1e-4)
    assert sum(got[k]["score"] for k in got) > sum(got[k]["base_score"] for k in got)


def _kneser_ney(texts, order):
    """P(word | history) of an interpolated modified Kneser-Ney model, by the book."""
    grams = {order: collections.Counter()}
    for t in texts:
        w = ["<s>"] * (order - 1) + (t or "").split() + ["</s>"]
        grams[order].update(tuple(w[i - order + 1 : i + 1]) for i in range(order - 1, len(w)))
    for k in range(order - 1, 0, -1):
        grams[k] = collections.Counter(g[1:] for g in grams[k + 1])
    rates = {k: kneser_ney.discounts(collections.Counter(c.values())) for k, c in grams.items()}
    cut = lambda k, n: rates[k][min(n, 3) - 1]
    followed = {k: collections.defaultdict(list) for k in grams}
    for k, c in grams.items():
        for g, n in c.items():
            followed[k][g[:-1]].append(n)

    def p(w, h):
        k = len(h) + 1
        own = followed[k].get(h)
        if k == 1:
            return max(grams[1][(w,)] - cut(1, grams[1][(w,)]) if (w,) in grams[1] else 0, 0) / sum(own) + sum(cut(1, n) for n in own) / sum(own) / (len(own) + 1)
        if not own:
            return p(w, h[1:])
        n = grams[k].get((*h, w), 0)
        return ((n - cut(k, n)) if n else 0) / sum(own) + sum(cut(k, x) for x in own) / sum(own) * p(w, h[1:])

    return p, [g[0] for g in grams[1]]


@pytest.mark.parametrize("order", [2, 3])
def test_kneser_ney_against_brute_force(spark, order):
    rng = random.Random(3)
    texts = [_text(rng, rng.randint(0, 40)) for _ in range(80)] + [None, "", "w1 w1 w1 w1"]
    p, vocabulary = _kneser_ney(texts, order)
    for history in (("<s>",) * (order - 1), tuple(WORDS[: order - 1]), ("never",) * (order - 1)):
        assert sum(p(w, history) for w in [*vocabulary, "unseen"]) == pytest.approx(1)
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    asked = [*texts, "never seen", "w1 never w2", _text(rng, 300)]
    for head in (4, 1 << 18):  # few or all values come from arrays
        model = kneser_ney.train(rows, order=order, head=head)
        out = kneser_ney.perplexity(spark.createDataFrame([(k, t) for k, t in enumerate(asked)], "doc_id long, text string"), model, "doc_id")
        got = {r["doc_id"]: r for r in out.collect()}
        for k, t in enumerate(asked):
            w = ["<s>"] * (order - 1) + (t or "").split() + ["</s>"]
            logs = [np.log10(p(w[i], tuple(w[i - order + 1 : i]))) for i in range(order - 1, len(w))]
            assert got[k]["n_tokens"] == len(logs) and got[k]["perplexity"] == pytest.approx(10 ** -np.mean(logs), rel=1e-5)


def test_quality_thresholds(spark):
    """Each language's own quantile, that of all languages where there are few trusted texts, ties kept."""
    rng = random.Random(14)
    rows = [(k, _text(rng, 30), "en") for k in range(300)] + [(300 + k, _text(rng, 30), "de") for k in range(20)] + [(400, "zz yy", None), (401, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = kneser_ney.judged(docs, docs.filter("doc_id < 320").select("doc_id"), least_docs=20, quantile=0.5, slack=1.0).collect()
    held = {r["doc_id"] for r in docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).collect() if r["doc_id"] < 320}
    own = sorted(r["perplexity"] for r in out if r["doc_id"] in held and r["lang"] == "en")
    each = {r["lang"]: r["threshold"] for r in out}
    assert each["en"] == own[(len(own) + 1) // 2 - 1] and each["de"] == each["und"] is not None
    assert all(r["kept"] == (r["perplexity"] <= r["threshold"]) for r in out) and any(r["perplexity"] == r["threshold"] for r in out)
    assert all(r["kept"] and r["threshold"] is None for r in kneser_ney.judged(docs, docs.select("doc_id").limit(0)).collect())


def test_quality_classifier_keeps_trusted_and_rejects_junk(spark):
    rng = random.Random(4)
    good = [(k, _text(rng, 60), "en") for k in range(400)]
    junk = [(1000 + k, " ".join(f"zz{rng.random()}" for _ in range(60)), "en") for k in range(20)]
    docs = spark.createDataFrame(good + junk + [(2000, None, None)], "doc_id long, text string, lang string")
    out = {r["doc_id"]: r["kept"] for r in kneser_ney.judged(docs, docs.filter("doc_id < 400"), least_docs=10).collect()}
    assert not any(out[1000 + k] for k in range(20)) and sum(out[k] for k in range(400)) >= 395 and len(out) == 421


def test_toxicity_learns_words_and_look_alikes(spark):
    rng = random.Random(6)
    rows = [(_text(rng, 30) + (" you idiot " if k % 5 == 0 else " "), int(k % 5 == 0)) for k in range(300)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"))
    asked = [(1, "what an IDIOT"), (2, "w1 w2 w3"), (3, "such an 1d1оt"), (4, None), (5, "")]
    out = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(asked, "doc_id long, text string"), lexicon).collect()}
    assert [out[k]["predicted"] for k in range(1, 6)] == [1, 0, 1, 0, 0]


def test_language_by_rank_order(spark):
    train = [("the cat and the dog of the house " * 5, "en"), ("der Hund und die Katze in dem Haus " * 5, "de"), (None, "fr"), ("x", None)]
    known = language_id.profiles(spark.createDataFrame(train, "text string, lang string"))
    asked = [(1, "the house and the cat"), (2, "die Katze und der Hund"), (3, "12 34"), (4, None), (5, "")]
    out = {r["doc_id"]: r for r in language_id.identify(spark.createDataFrame(asked, "doc_id long, text string"), known).collect()}
    assert [out[k]["lang_pred"] for k in range(1, 6)] == ["en", "de", "und", "und", "und"] and all(0 <= r["score"] <= 1 for r in out.values())


def test_leaks_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(8)
    own = [f"q{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(own) for _ in range(30))) for k in range(6)]
    clean = [(k, _text(rng, 150)) for k in range(60)]
    leaked = [(100 + k, f"{_text(rng, 50)} {t.upper()} {_text(rng, 50)}") for k, t in items]
    changed = []
    for k, t in items:
        w = t.split()
        w[5], w[15] = "other", "words"
        changed.append((200 + k, f"{_text(rng, 40)} {' '.join(w)} {_text(rng, 10)}"))
    docs = spark.createDataFrame(clean + leaked + changed + [(900, None)], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()}
    assert got == {(b + k, k) for k in range(6) for b in (100, 200)}
    assert decontamination.leaks(docs, bench.limit(0)).count() == 0


def test_leaks_behind_a_better_looking_decoy(spark):
    """A scrambled item has the greater cosine; the passage with other words in it is the leak."""
    rng = random.Random(11)
    item = [f"q{k}" for k in range(30)]
    scrambled = item[::-1]
    passage = list(item)
    for k in (4, 9, 14, 19):
        passage[k] = f"other{k}"
    clean = [(k, _text(rng, 150)) for k in range(60)]
    long = f"{_text(rng, 64)} {' '.join(scrambled)} {_text(rng, 300)} {' '.join(passage)} {_text(rng, 100)}"
    docs = spark.createDataFrame([*clean, (100, long), (101, f"{_text(rng, 64)} {' '.join(scrambled)}")], "doc_id long, text string")
    got = decontamination.leaks(docs, spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")).collect()
    assert [r["doc_id"] for r in got] == [100] and got[0]["start_word"] > 300


def test_leaks_of_common_words(spark):
    """An item copied into a third of all rows, and one of words that every document has."""
    rng = random.Random(12)
    hot, usual = " ".join(f"q{k}" for k in range(30)), " ".join(WORDS[k] for k in rng.sample(range(60), 24))
    rows = [(k, _text(rng, 120)) for k in range(90)]
    rows += [(100 + k, f"{_text(rng, 50)} {hot} {_text(rng, 40)}") for k in range(47)]
    rows += [(200, f"{_text(rng, 75)} {usual} {_text(rng, 20)}"), (201, usual), (202, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(0, hot), (1, usual), (2, " ".join(f"rare{k}" for k in range(30)))]
    for asked in (items, items[:1], items[1:2]):
        got = sorted((r["item_id"], r["doc_id"]) for r in decontamination.leaks(docs, spark.createDataFrame(asked, "item_id long, text string")).collect())
        assert got == sorted([(0, 100 + k) for k in range(47) if items[0] in asked] + [(1, k) for k in (200, 201) if items[1] in asked])


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(50):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(a, b) == table[-1][-1]


PAGE = """<html><body><header><a href=x>Home</a></header><nav><ul><li><a href=1>one</a><li><a href=2>two</a></ul></nav>
<article><h1>Title &amp; more</h1><p>A long   paragraph<br>of text that goes on for a while, with a <a href=q>link</a> in it.<p>Another &eacute;.<div class="ad">Buy now!</div></article>
<section id="comments"><div class=comment>Nice post, thank you.</div></section><footer>(c)</footer><script>var a="<p>";</script></body></html>"""


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "no markup < here")] + [(k, "u", PAGE) for k in range(5, 30)], "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in html_extract.extract(pages, html_extract.learn(pages)).collect()}
    assert out[1] == "Title & more\nA long paragraph of text that goes on for a while, with a link in it.\nAnother é." and out[2] == out[3] == ""


def test_skipped_elements_without_an_end():
    blocks = lambda page: [b for _, b in html_extract.parse(page).blocks]
    assert blocks("<html><head><title>t</title><meta charset=u><body><p>one</p><p>two</body></html>") == ["one", "two"]
    assert blocks("<head><link rel=x><style>p {}</style><p>one<p>two") == ["one", "two"]
    assert blocks("<head><title>t</title></head><p>one") == ["one"]
    for tag in ("svg", "iframe", "object", "canvas", "template", "select", "noscript"):
        assert blocks(f"<article><{tag} a='b'/><p>one</p><{tag}>gone <b>x</b></{tag}><p>two</p></article>") == ["one", "two"]
        assert blocks(f"<div><{tag}>gone</div><p>one") == ["one"]
    assert blocks("<p>one<svg><svg><g/></svg>gone</svg><p>two") == ["one", "two"]
    assert blocks("<p>one<script/><p>two<script>if (a < b) '<p>'</script><p>three") == ["one", "two", "three"]


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    parent = np.array([-1, 0, 0, 1, 1, 2])
    unary, pair = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    total = np.zeros((6, 2))
    for code in range(64):
        y = [(code >> k) & 1 for k in range(6)]
        w = np.exp(sum(unary[k, y[k]] for k in range(6)) + sum(pair[y[parent[k]], y[k]] for k in range(1, 6)))
        for k in range(6):
            total[k, y[k]] += w
    assert html_extract.marginals(unary, pair, parent) == pytest.approx(total[:, 1] / total.sum(1))


def test_empty_tables(spark, none):
    import public_tokenizers

    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert jaccard_join.join(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert quality_rules.judged(none).count() == 0
    assert maxent.score(none, maxent.train(none)).count() == 0
    assert kneser_ney.judged(none, none.select("doc_id")).count() == 0
    assert language_id.identify(none, language_id.profiles(none)).count() == 0
    assert toxicity.score(none, toxicity.learn(none.select("text", F.lit(1).alias("toxic")))).count() == 0


def test_null_and_repeated_ids(spark):
    text = " ".join(WORDS)
    docs = spark.createDataFrame([(None, text), (None, None), (1, text), (1, text), (2, "short")], "doc_id long, text string")
    joined = jaccard_join.join(docs).collect()
    assert len(joined) == 5 and {r["component_id"] for r in joined if r["doc_id"] == 1} == {1}
    assert suffix_dedup.remove_repeats(docs, length=60, gram=16).filter(F.size("spans") > 0).count() == 3
    assert quality_rules.judged(docs).count() == 5


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packed":
            assert after.columns == docs.columns
        docs = after
        seen.append(docs.count())
    assert all(a >= b for a, b in zip(seen, seen[1:-1])) and seen[-1] > 0


def test_stages_on_odd_rows(spark):
    """Null and repeated ids, null and empty texts, repeated rows, signs cut in two, columns with clashing names."""
    import corpus_pipeline as cp

    rng = random.Random(21)
    words = [f"word{k}" for k in range(5000)]
    long = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, once = " ".join(rng.choice(words) for _ in range(60)), long(120)
    kinds = "doc_id long, text string, lang string, source string, n_chars long, _bucket string, bucket string, `key` string, node string, rest string, missing boolean, id string, row long"
    more = ("b", "c", "d", "e", "f", True, "g", 7)
    row = lambda i, t: (i, t, "en", "s", len(t or ""), *more)
    a, b = f"\ufffd {long(70)} {passage} {long(70)}", f"{long(70)} {passage} é{long(70)}"
    rows = [row(1, once), row(1, once), row(2, once), row(None, once), row(3, a), row(4, b), row(5, None), row(6, ""), row(None, None), row(7, long(80)), row(7, long(90))]
    docs = spark.createDataFrame(rows, kinds)
    near = cp.near_duplicates(spark, docs, "")
    assert near.columns == docs.columns
    near = near.collect()
    ids = collections.Counter(r["doc_id"] for r in near)
    assert ids == {1: 1, 3: 1, 4: 1, 5: 1, 6: 1, None: 1, 7: 1} and all(r["_bucket"] == "b" and r["row"] == 7 for r in near)
    cut = cp.repeated_strings(spark, spark.createDataFrame(near, kinds), "")
    assert cut.columns == docs.columns
    cut = {r["doc_id"]: r for r in cut.collect() if r["doc_id"] is not None}
    assert cut[5]["text"] is None and cut[6]["text"] == "" and cut[1]["text"] == once and cut[3]["n_chars"] == len(cut[3]["text"])
    assert cut[3]["text"].startswith("\ufffd ") and passage[20:-20] not in cut[3]["text"] + cut[4]["text"] and a[:100] in cut[3]["text"] and b[-100:] in cut[4]["text"]
    # one row of an id holds an item of the benchmark, the other stays
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").filter("length(text) > 150").first()["text"]
    leaky = spark.createDataFrame([row(1, f"{once} {item} {long(50)}"), row(1, once), row(None, once), row(None, None)], kinds)
    left = cp.benchmark_leaks(spark, leaky, "/root/testdata/sf0.001").collect()
    assert sorted(r["text"] or "" for r in left) == ["", once, once]
    for stage in (cp.near_duplicates, cp.repeated_strings):
        assert stage(spark, docs.limit(0), "").count() == 0
    for stage in (cp.quality, cp.benchmark_leaks):
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0


def test_leaks_where_all_or_few_documents_leak(spark):
    rng = random.Random(31)
    item = " ".join(f"i{k}" for k in range(30))
    clean = lambda n: [_text(rng, 100) for _ in range(n)]
    for leaking, others in ((20, 0), (20, 20), (1, 0), (20, 200)):
        texts = [f"{_text(rng, 40)} {item} {_text(rng, 40)}" for _ in range(leaking)] + clean(others)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r["doc_id"] for r in decontamination.leaks(docs, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()}
        assert got == set(range(leaking))
