"""The exact Jaccard join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import setjoin

RNG = random.Random(3)


def plain(rows, t, n, chars):
    sets = {}
    for k, x in rows:
        u = list(" ".join((x or "").split())) if chars else [w.decode() for w in (x or "").encode().split()]
        if u:
            sets[k] = frozenset([tuple(u)] if len(u) < n else [tuple(u[i : i + n]) for i in range(len(u) - n + 1)])
    out = []
    for k, _ in rows:
        own = sets.get(k)
        near = [j for j, s in sets.items() if j != k and own and len(own & s) >= t * len(own | s) - 1e-12]
        out.append((k, min(j for j, s in sets.items() if s == own) if own else k, len(near)))
    return sorted(out)


def text(n, words=30):
    return " ".join(f"w{RNG.randint(0, words)}" for _ in range(n))


def family(base, copies, edits):
    words = base.split()
    out = []
    for _ in range(copies):
        w = list(words)
        for _ in range(RNG.randint(0, edits)):
            w[RNG.randrange(len(w))] = f"e{RNG.randint(0, 9)}"
        out.append(" ".join(w))
    return out


def table(spark):
    passage = text(30)
    texts = [text(RNG.randint(1, 60)) for _ in range(60)] + [f"{passage} {text(25)}" for _ in range(30)] + [f"{passage} {text(3)}" for _ in range(15)]
    texts += family(text(50, 10**6), 40, 2) + family(text(12, 10**6), 20, 1) + ["same text here again now and then"] * 25 + [None, "", "  ", "one", "one", "one two", "日本 語 é", "é x y z w v", "x " * 4000]
    RNG.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("t,chars", [(0.8, False), (0.5, False), (0.9, True)])
def test_links_equal_all_pairs(spark, t, chars):
    rows = table(spark)
    df = spark.createDataFrame(rows, "id long, text string").withColumn("rep", F.lit("x")).withColumn("size", F.lit(1)).repartition(5)
    got = sorted(tuple(r) for r in setjoin.linked(df, "id", "text", t, 5, chars).collect())
    assert got == plain(rows, t, 5, chars)
    assert sum(n for _, _, n in got) > 500
    assert setjoin.linked(df.limit(0), "id", "text").count() == 0


def test_large_buckets_are_dealt_into_blocks(spark):
    """More sets than a block in one bucket: every pair is a candidate once, in units that no bucket's size bounds."""
    n = 3 * setjoin.BLOCK // 2
    reps = spark.createDataFrame([(i, 10, [1, 2, 100 + i]) for i in range(n)], "rep long, size long, first array<long>")
    pairs, homes = setjoin.candidates(reps, 0.7)
    assert pairs.count() == n * (n - 1) // 2 == pairs.filter("u < v").count() and homes.count() == n


def test_pairs_carry_their_similarity(spark):
    rows = [(0, "a b c d e f g h i j"), (1, "a b c d e f g h i k"), (2, "a b c d e f g h i j l"), (3, "z")]
    every, pairs = setjoin.links(spark.createDataFrame(rows, "id long, text string"), "id", "text", 0.5)
    assert sorted((r.u, r.v, round(r.jaccard, 6)) for r in pairs.collect()) == [(0, 1, round(5 / 7, 6)), (0, 2, round(6 / 7, 6)), (1, 2, round(5 / 8, 6))]
    assert every.count() == 4


def test_prefix_holds_what_it_must():
    rng = np.random.default_rng(0)
    order = np.sort(rng.choice(1000, 50, replace=False))
    rank = rng.permutation(50)
    for _ in range(300):
        a = np.unique(rng.choice(1000, rng.integers(1, 40)))
        b = np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * 0.9))), rng.choice(1000, rng.integers(0, 3))]))
        if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            assert len(np.intersect1d(setjoin.prefix(a, 0.8, order, rank), setjoin.prefix(b, 0.8, order, rank)))
    assert list(setjoin.prefix(np.arange(10), 0.8, np.arange(8), np.arange(8))) == [8, 9, 0]


def test_overlaps_one_by_one_and_by_tiles(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(setjoin, "TILE", 64)
    sets = [np.unique(rng.integers(0, 400, rng.integers(0, 60))) for _ in range(30)]
    u, v = map(np.array, zip(*[(i, j) for i in range(30) for j in range(i)]))
    want = [len(set(sets[i]) & set(sets[j])) for i, j in zip(u, v)]
    assert setjoin.overlaps(sets, u, v).tolist() == want and setjoin.overlaps(sets, u[:9], v[:9]).tolist() == want[:9]
