"""Running values over groups that are dealt to many tasks."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import segments

RNG = random.Random(6)


def rows_of(n, values, hot=0.9):
    return [(i, 7 if RNG.random() < hot else RNG.choice([1, None, 3]), RNG.choice(values)) for i in range(n)]


def plain(rows, empty="view"):
    out, streak, last = {}, {}, {}
    for i, who, value in rows:
        streak[who] = streak.get(who, 0) + 1 if value == empty else 0
        out[i] = (streak[who], who not in last or last[who] != value)
        last[who] = value
    return out


@pytest.mark.parametrize("values", [["view", "buy"], ["view"] * 40 + ["buy"], ["view"], [None, "view"]])
def test_a_hot_user_over_many_tasks(spark, values):
    """One user has nine of ten rows; runs reach over several ranges, some ranges are all empty."""
    rows = rows_of(900, values)
    want = plain(rows)
    df = spark.createDataFrame(rows, "ord long, who long, kind string").repartition(3)
    got = segments.streaks(df, F.col("kind") == "view", ["who"], ["ord"], ranges=8)
    assert {r.ord: r.streak for r in got.collect()} == {i: s for i, (s, _) in want.items()} and got.columns == ["ord", "who", "kind", "streak"]
    assert {r.ord: r.changed for r in segments.changed(df, F.col("kind"), ["who"], ["ord"], ranges=8).collect()} == {i: c for i, (_, c) in want.items()}
    per = segments.dealt(df, ["who"], ["ord"], 8).groupBy(segments.PART).count().collect()
    assert len(per) == 8 and max(r["count"] for r in per) < 300
    assert segments.streaks(df.limit(0), F.col("kind") == "view", ["who"], ["ord"]).count() == 0


def test_seeded_samples(spark):
    from millrace.operators import score as sc

    import hashlib

    rows = [(i, f"h{i}", "ab"[i % 9 == 0]) for i in range(300)]
    df = spark.createDataFrame(rows, "ord long, h string, style string").repartition(7)
    order = lambda r: (hashlib.md5(f"5:{r[1]}".encode()).hexdigest(), r[1])
    assert sorted(r.ord for r in sc.seeded_sample(df, 20, 5, F.col("h")).collect()) == sorted(r[0] for r in sorted(rows, key=order)[:20])
    got = sc.seeded_sample(df, 20, 5, F.col("h"), ["style"]).collect()
    want = [r[0] for s in "ab" for r in sorted((r for r in rows if r[2] == s), key=order)[:20]]
    assert sorted(r.ord for r in got) == sorted(want)
