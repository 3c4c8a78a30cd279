"""The metric partition against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import metric


def rows_of(rng, groups, each, dims, spread):
    centres = rng.normal(size=(groups, dims))
    x = np.repeat(centres, each, axis=0) + rng.normal(size=(groups * each, dims)) * spread
    return [(int(i), [float(v) for v in e]) for i, e in zip(rng.permutation(len(x)), x)]


def plain(rows, t):
    out = {}
    for n in {len(e) for _, e in rows if e}:
        own = [(i, e) for i, e in rows if e and len(e) == n and all(v is not None and np.isfinite(v) for v in e) and any(e)]
        if own:
            m = np.array([e for _, e in own], dtype=np.float64)
            m /= np.linalg.norm(m, axis=1, keepdims=True)
            s = m @ m.T
            out |= {(own[a][0], own[b][0]): s[a, b] for a, b in zip(*np.nonzero(s >= t)) if own[a][0] < own[b][0]}
    return out


@pytest.mark.parametrize("t,block", [(0.9, 1024), (0.5, 16), (0.2, 40)])
def test_pairs_equal_all_pairs(spark, monkeypatch, t, block):
    monkeypatch.setattr(metric, "BLOCK", block)
    rows = rows_of(np.random.default_rng(1), 12, 20, 16, 0.3)
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [1.0, 2.0]), (2004, [2.0, 4.0]), (2005, [float("nan")] * 16), (2006, [None] * 16), (2007, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("w", F.lit("x")).withColumn("id", F.lit(0)).repartition(3)
    want = plain(rows, t)
    got = metric.pairs(df, t).collect()
    assert len(got) == len(want) and {(r.u, r.v) for r in got} == set(want) and all(abs(r.similarity - want[r.u, r.v]) < 1e-9 for r in got)
    n = {}
    for a, b in want:
        n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    near = {r.vec_id: r for r in metric.neighbours(df, t).collect()}
    assert len(near) == len(rows) and all(near[i].n_links == n.get(i, 0) for i, _ in rows)
    assert near[1005].class_id == min(rows[0][0], 1000) and near[2001].class_id == 2001
    assert metric.pairs(df.limit(0), t).count() == 0 and metric.neighbours(df.limit(0), t).count() == 0


def test_clusters_are_not_compared_with_all(spark, monkeypatch):
    """The pairs that units compare are far fewer than all pairs, and no unit holds more than two blocks."""
    monkeypatch.setattr(metric, "BLOCK", 64)
    rows = rows_of(np.random.default_rng(2), 40, 50, 16, 0.1)
    df = spark.createDataFrame(rows, "id long, e array<double>").withColumn("w", F.lit(1).cast("long"))
    cells = metric.partition(df, 0.9, 16)
    sizes = metric.units(df, cells, 16).groupBy("cell", "a", "b").agg(F.count_if("left").alias("l"), F.count_if(~F.col("left")).alias("r")).collect()
    own = sum(s.l * (s.l - 1) // 2 if s.b == -1 - s.a else s.l * s.r for s in sizes)
    assert own < len(rows) ** 2 / 2 / 4 and max(max(s.l, s.r) for s in sizes) < 2 * 64
