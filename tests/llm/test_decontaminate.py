"""Decontamination against brute force that compares every alignment, without seeds."""

import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import decontaminate

WORDS = [f"w{k}" for k in range(4000)]


def brute(docs, items):
    """Best (agreeing, compared) of each (doc_id, item_id, alignment) that leaks."""
    cut = lambda t: [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    out = {}
    for (d, text), (i, item) in itertools.product(docs, items):
        a, b = cut(text), cut(item)
        size, least = min(20, len(b)), 100 if len(b) < 8 else 75
        for at in range(1 - len(b), len(a)) if b else ():
            same = np.array([0 <= at + k < len(a) and a[at + k] == b[k] for k in range(len(b))], int)
            best = max(same[k : k + size].sum() for k in range(len(b) - size + 1))
            if best * 100 >= size * least:
                out[d, i, at] = max(out.get((d, i, at), (0, 0)), (int(best), size))
    return out


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit("clash")).withColumn("key", F.lit(1)).repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(2)).withColumn("I", F.lit(3))
    rows = decontaminate.leaks(spark, d, b).collect()
    assert len({(r.doc_id, r.item_id, r.doc_token) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id, r.doc_token): (r.agreeing, r.compared) for r in rows}


def test_masks_lose_no_pattern_of_substitutions():
    masks = [sum(1 << k for k, bit in enumerate(m) if bit == "1") for m in decontaminate.MASKS]
    for n in range(decontaminate.SHORT, decontaminate.WINDOW + 1):
        wrong = n - math.ceil(n * decontaminate.AGREE / 100)
        patterns = np.array([sum(1 << k for k in c) for c in itertools.combinations(range(n), wrong)])
        hit = np.zeros(len(patterns), bool)
        for m in masks:
            for at in range(n - m.bit_length() + 1):
                hit |= patterns & (m << at) == 0
        assert hit.all(), n


@pytest.fixture(scope="module")
def tables():
    rng = np.random.default_rng(1)
    items = [(k, " ".join(rng.choice(WORDS, n))) for k, n in enumerate([8, 9, 11, 12, 14, 16, 19, 20, 21, 30, 40, 40, 60])]
    items += [(50, "w1 w2"), (51, "W7, w8! w9 w10 w11 w12 w13"), (52, None), (53, " ,"), (3, items[3][1]), (3, " ".join(rng.choice(WORDS, 25))), (None, " ".join(rng.choice(WORDS, 15)))]
    docs = [(0, None), (1, ""), (2, "... ---"), (3, "w1 w2"), (4, "x w2 w1 W1-w2 y"), (5, "w7 w8 w9 w10 w11 w12 w13"), (6, "w7 w8 w9 w10 w11 w12")]
    for k in range(300):
        text = items[int(rng.integers(0, len(items)))][1] or "none"
        words = text.split()
        lost = round(len(words) * rng.choice([0, 0.1, 0.2, 0.25, 0.25, 0.3]))
        at = rng.choice(len(words), lost, replace=False) if k % 2 else np.arange(len(words))[int(rng.integers(0, 4)) :: int(rng.choice([3, 4, 5]))]
        for p in at:
            words[p] = f"q{k}"
        head, tail = (list(rng.choice(WORDS, int(rng.integers(0, 200)))) for _ in range(2))
        docs.append((100 + k, " ".join([*head, *words[int(rng.integers(0, 2)) * int(rng.integers(0, 8)) :], *tail])))
    return docs + docs[-3:], items


@pytest.mark.parametrize("bound", [None, 0])
def test_equals_brute_force(spark, tables, monkeypatch, bound):
    docs, items = tables
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if bound is not None:  # the way of large tables: nothing is broadcast
        for name in ("BROADCAST_SEEDS", "BROADCAST_KEYS", "BROADCAST_BYTES"):
            monkeypatch.setattr(decontaminate, name, -1)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        want = brute(docs, items)
        assert len(want) > 100 and found(spark, docs, items) == want
        leaking = {d for d, _, _ in want}
        kept = decontaminate.clean(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in leaking)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_texts_that_share_an_id_in_either_order(spark):
    rng = np.random.default_rng(2)
    item, other = (" ".join(rng.choice(WORDS, 20)) for _ in range(2))
    partial = " ".join(item.split()[:12] + ["q"] * 8)
    docs, items = [(1, partial), (1, item), (None, other), (None, "clean text")], [(1, item), (1, other + " and more"), (2, other)]
    want = brute(docs, items)
    assert {(1, 1, 0), (None, 1, 0), (None, 2, 0)} <= set(want)
    for d in (docs, docs[::-1]):
        for i in (items, items[::-1]):
            assert found(spark, d, i) == want
            kept = decontaminate.clean(spark, spark.createDataFrame(d, "doc_id long, text string").coalesce(1), spark.createDataFrame(i, "item_id long, text string"))
            assert sorted((r.text for r in kept.collect())) == sorted([partial, "clean text"])


def test_long_texts(spark):
    rng = np.random.default_rng(3)
    item = " ".join(rng.choice(WORDS, 24))
    docs = [(1, " ".join(rng.choice(WORDS, 150_000)) + " " + item + " end"), (2, "x" * 100_000 + " " + item), (3, item + " " + "é" * 70_000), (4, "a " * 60_000)]
    items = [(1, item), (2, "a " * 30)]
    got = found(spark, docs, items)
    assert got[1, 1, 150_000] == got[2, 1, 1] == got[3, 1, 0] == (20, 20)
    # a window of the item lies within the text from 10 tokens less than a window before its start to as many after its end
    assert {(d, i) for d, i, _ in got} == {(1, 1), (2, 1), (3, 1), (4, 2)} and sum(d == 4 for d, _, _ in got) == 60_000 - 14 - 15 + 30


def test_seeds_carry_no_texts(spark):
    """Shuffled and kept seeds are three numbers, so their bytes grow with the text, not with its square."""
    rows = spark.createDataFrame([(1, list(range(5000)))], "item long, h array<long>")
    seeds = decontaminate._seeds(rows, ["item"], list(enumerate(decontaminate.MASKS)))
    assert seeds.columns == ["item", "at", "seed"] and seeds.count() == sum(5000 - len(m) + 1 for m in decontaminate.MASKS)
    assert seeds.select("seed").distinct().count() == seeds.count()
