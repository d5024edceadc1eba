"""Spelling variants, exact top-k and ranked search against brute force, with odd rows."""

import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from curatrix.llm import ranked_search, spelling, topk

ALPHABET = "abcdeàÿ×"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_force(docs, damage=97):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    found, forms = {}, {}
    for w, k in n.items():
        others = [o for o in n if near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        forms[w] = best if best is not None and n[best] >= 2 * k else None
        found[w] = len(others)
    out = []
    for w, k in n.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, k, found[w], n.get(forms[w])))
    return sorted(out, key=lambda r: r[0])


def odd_words():
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list(ALPHABET), rng.integers(4, 9))) for _ in range(12)] + ["aaaaa", "aaaaaa", "aaaaaaa", "ababababab", "x" * 3000, "x" * 3001, "Größe", "GRÖßE"]
    texts = []
    for _ in range(250):
        words = []
        for w in rng.choice(base, 6):
            w = str(w)
            for _ in range(rng.integers(0, 3)):
                at, c = int(rng.integers(0, len(w))), str(rng.choice(list(ALPHABET)))
                w = [w, w[:at] + c + w[at + 1 :], w[:at] + w[at + 1 :], w[:at] + c + w[at:]][rng.integers(0, 4)]
            words.append(w if rng.random() < 0.8 else w.upper() if w.isascii() else w)
        texts.append(" ".join(words) + rng.choice([".", "1", "\n", "\U0001f600", "Ā"]))
    rows = [(i % 90, t) for i, t in enumerate(texts)]
    return [*rows, *rows[:20], (None, texts[0]), (None, None), (1, None), (2, ""), (3, "!? 12"), (4, "aaaaa " * 5000), (5, "kettl " * 3 + "kettle " * 8 + "kettles " * 16)]


@pytest.mark.parametrize("damage", [97, 2, 0])
def test_spelling_variants(spark, damage):
    rows = odd_words()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = sorted((tuple(r) for r in spelling.variants(spark, docs, damage=damage).collect()), key=lambda r: r[0])
    want = variants_by_force(rows, damage)
    assert got == want
    assert len({r[2] for r in want}) > 5
    assert damage or ("kettl", "kettle", "kettles", 3, 1, 8) in want


def test_near_words_of_all_places(spark):
    """Each single edit of words that hold one bigram several times."""
    words = {"abababab", "aaaaa", "abcde", "aabaabaab"}
    for w in list(words):
        for i in range(len(w) + 1):
            words |= {w[:i] + c + w[i:] for c in "abz"} | {w[:i] + c + w[i + 1 :] for c in "abz"} | {w[:i] + w[i + 1 :]}
    words = sorted(w for w in words if len(w) >= 5)
    counted = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = {tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(spelling.rare_bigrams(counted)).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spark, docs).count() == 0
    assert spelling.variants(spark, spark.createDataFrame([(1, "abcde abcde")], docs.schema)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark, docs, least_length=3)


def top_by_force(rows, every, k):
    once = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            once[i] = max(once.get(i, v), v)
    whole = {i: [math.floor(Fraction(x) * 256) for x in v] for i, v in once.items()}
    out = []
    for q in sorted(i for i in whole if i % every == 0):
        scores = [(-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q]
        out += [(q, n + 1, i, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("shard", [7, 4096])
def test_top_k(spark, shard):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 256]) for i in range(-20, 200)]  # many ties
    rows += [(i, [float(x) for x in rng.normal(size=6)]) for i in range(200, 400)] + [(i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.1]) for i in range(400, 460)]
    rows += [(500, [0.0] * 6), (550, [0.25]), (551, []), (600, None), (650, [None] * 6), (700, [float("nan")] * 6), (750, [1.0, float("inf")]), (None, [1.0] * 6), (10, [9.0] * 6), (10, [9.0] * 6)]
    table = spark.createDataFrame([(i, v, "q", 3) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int").repartition(4)
    got = [tuple(r) for r in topk.top_k(spark, table, every=10, shard=shard, block=9).orderBy("query_id", "rank").collect()]
    assert got == top_by_force(rows, 10, 5)


def test_top_k_of_numbers_beyond_doubles(spark):
    rows = [(0, [1e8, 3.0]), (1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [1e8 + 1, 1.0]), (4, [1e8, 2.0]), (10, [1.0, 1.0])]
    got = [tuple(r) for r in topk.top_k(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=10).orderBy("query_id", "rank").collect()]
    assert got == top_by_force(rows, 10, 5)


def test_top_k_of_few(spark):
    kind = "vec_id long, embedding array<float>"
    assert topk.top_k(spark, spark.createDataFrame([], kind)).count() == 0
    assert topk.top_k(spark, spark.createDataFrame([(50, [1.0])], kind)).count() == 0
    assert [tuple(r) for r in topk.top_k(spark, spark.createDataFrame([(50, [1.0]), (1, [-1.0])], kind)).collect()] == [(50, 1, 1, -65536)]


def test_threshold_stops_early():
    """In lists with few large components most vectors are never scored."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.pareto(1.5, (4000, 4)) * 100)
    lists, w = topk.SortedLists(np.arange(4000), x), np.array([3.0, 1.0, 0.0, 2.0])
    ids, scores, scored = lists.top(w, 5, None)
    assert scored < 1000
    assert scores.tolist() == sorted((x @ w).tolist(), reverse=True)[:5] and (x[ids] @ w).tolist() == scores.tolist()


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ranked_by_force(docs, items, k=10):
    counted = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted({(i, t or "") for i, t in items}, key=str):
        wanted, scores = Counter(TERM.findall(lowered(text))), []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * total) // length
            s = sum(r * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, r in wanted.items() if t in c)
            scores += [(-s, i is None, i or 0)] if s > 0 else []
        out += [(item, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("postings", "most_terms"), [(2_000_000, 200_000), (50, 3)])
def test_ranked(spark, monkeypatch, postings, most_terms):
    monkeypatch.setattr(ranked_search, "POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "RANGE", 16)
    rng = np.random.default_rng(3)
    words = ["alpha", "Beta", "gäm", "Ä", "don't", "x1", "日本", "e", "z" * 200, " q", "k_l"]
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 12), p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.04, 0.02, 0.02, 0.02]))) for i in range(300)]
    docs += [*docs[:30], (None, docs[0][1]), (None, docs[1][1]), (7, None), (8, ""), (9, " !? "), (10, "alpha " * 20000), (400, "rare")]
    items = [(1, "alpha beta beta"), (2, "gäm ä 日本 don"), (3, "alpha"), (4, ""), (5, None), (6, "unknown"), (7, "rare"), (1, "rare alpha"), (3, "alpha"), (None, "x1 K l"), (9, "z" * 200 + " ZZZ " + "e " * 3000)]
    table = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id long, text string, n int, rank string").repartition(3)
    asked = spark.createDataFrame([(i, t, "t") for i, t in items], "item_id long, text string, doc_id string")
    got = ranked_search.ranked(spark, table, asked, most_terms=most_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked_by_force(docs, items)


def test_ranked_without_rows(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.ranked(spark, docs.limit(0), items).count() == 0
    assert ranked_search.ranked(spark, docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in ranked_search.ranked(spark, docs, items).collect()] == ranked_by_force([(1, "a b")], [(1, "a")])


def test_max_score_reads_few_documents():
    """Frequent terms of small weight bring no documents once k better ones are known."""
    n = 20_000
    common, rare = np.arange(n), np.arange(0, n, 500)
    owner, terms = np.concatenate([common, rare]), np.concatenate([np.zeros(n, np.int64), np.ones(len(rare), np.int64)])
    shard = ranked_search.Shard(np.rec.fromarrays([np.zeros(n, bool), common], names="none,id"), np.full(n, 10), owner, terms, np.ones(len(owner), np.int64), np.array([5, 6000]), n, 10 * n)
    rows, scores, read = shard.search(np.array([0, 1]), np.array([1, 1]), 1, 10)
    assert set(rows) <= set(rare) and len(rows) >= 10 and len(set(scores)) == 1
    assert read < n / 2
