"""Streams with state against their batch twins, over restarts, silent sources and repeated batches."""

import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources import versions
from millrace.streaming import guards

RNG = random.Random(2)


@pytest.fixture(autouse=True)
def store(spark):
    guards.stateful(spark)


def run(spark, tmp_path, parts, make):
    out = str(tmp_path / "out")
    guards.replay(parts, str(tmp_path / "log"), out, str(tmp_path / "state"), make)
    return spark.read.parquet(out)


def parts_of(spark, rows, kind, n=3):
    size = -(-len(rows) // n)
    return [spark.createDataFrame(rows[i : i + size], kind).repartition(3) for i in range(0, len(rows), size)]


def test_first_rows_over_batches(spark, tmp_path):
    rows = [(i, RNG.choice(["a", "b", None, ""]) if i % 2 else "hot", RNG.choice(["x", None])) for i in range(300)]
    keys = {"prompt": F.col("prompt"), "style": F.col("style")}
    got = run(spark, tmp_path, parts_of(spark, rows, "ord long, prompt string, style string"), lambda s: guards.first_rows(s, keys, 5))
    seen, want = {}, []
    for i, p, s in rows:
        n = seen[p or "", s or ""] = seen.get((p or "", s or ""), 0) + 1
        if n <= 5:
            want.append((i, p, s, n))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_keys_that_rest_start_anew(spark, tmp_path):
    kind = "ord long, prompt string"
    log = str(tmp_path / "log")
    spark.createDataFrame([(i, "k") for i in range(3)], kind).coalesce(1).write.mode("append").parquet(log)
    rows = guards.first_rows(spark.readStream.schema(kind).parquet(log), {"prompt": F.col("prompt")}, 2, forget_ms=3000)
    q = rows.writeStream.format("memory").queryName("rested").option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="300 milliseconds").start()

    def until(n):
        end = time.time() + 60
        while time.time() < end and spark.table("rested").count() < n:
            assert q.isActive, q.exception()
            time.sleep(0.3)
        return sorted(r.ord for r in spark.table("rested").collect())

    try:
        assert until(2) == [0, 1]
        time.sleep(5)
        spark.createDataFrame([(i, "k") for i in range(3, 6)], kind).coalesce(1).write.mode("append").parquet(log)
        assert until(4) == [0, 1, 3, 4]
    finally:
        q.stop()


def test_changes_over_batches(spark, tmp_path):
    rows = [(i, RNG.randint(0, 3) if i % 2 else 9, RNG.choice(["a", "b", None])) for i in range(200)]
    got = run(spark, tmp_path, parts_of(spark, rows, "ord long, who long, value string"), lambda s: guards.changes(s, ["who"], F.col("value")))
    last, want = {}, []
    for i, who, value in rows:
        if who not in last or last[who] != value:
            want.append(i)
        last[who] = value
    assert sorted(r.ord for r in got.collect()) == want


EVENTS = "session string, ord long, kind string, data string"


def test_streams_become_one(spark, tmp_path):
    a = [(f"s{i}", k, "column_done" if k == 4 else "token", f"a{k}") for i in range(6) for k in range(5)]
    b = [(f"s{i}", 10 + k, "error" if k == 1 and i < 4 else "token", None) for i in range(5) for k in range(2)]
    kept = {"a": a, "b": b}
    logs = {n: str(tmp_path / n) for n in kept}
    for cut in (0, 1):
        for n, rows in kept.items():
            half = [r for i, r in enumerate(rows) if i % 2 == cut]
            spark.createDataFrame(half, EVENTS).write.mode("append").parquet(logs[n])
        merged = guards.fan_in({n: spark.readStream.schema(EVENTS).parquet(p) for n, p in logs.items()}, None)
        merged.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = sorted(map(repr, spark.read.parquet(str(tmp_path / "out")).collect()))
    twin = sorted(map(repr, guards.fanned_in({n: spark.createDataFrame(r, EVENTS) for n, r in kept.items()}).collect()))
    assert got == twin and sum("'done'" in r for r in got) == 4


def test_a_silent_session_is_pinged_until_it_is_done(spark, tmp_path):
    logs = {n: str(tmp_path / n) for n in "ab"}
    for p in logs.values():
        spark.createDataFrame([], EVENTS).write.mode("append").parquet(p)
    spark.createDataFrame([("s", 0, "token", "x")], EVENTS).write.mode("append").parquet(logs["a"])
    merged = guards.fan_in({n: spark.readStream.schema(EVENTS).parquet(p) for n, p in logs.items()}, 300)
    q = merged.writeStream.format("memory").queryName("merged").option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="200 milliseconds").start()

    def until(kind, n):
        end = time.time() + 90
        while time.time() < end and spark.table("merged").filter(F.col("kind") == kind).count() < n:
            assert q.isActive, q.exception()
            time.sleep(0.3)
        return spark.table("merged").filter(F.col("kind") == kind).count()

    try:
        assert until("ping", 2) >= 2
        for n, p in logs.items():
            spark.createDataFrame([("s", 5, "column_done", n)], EVENTS).write.mode("append").parquet(p)
        assert until("done", 1) == 1
        pings = spark.table("merged").filter("kind = 'ping'").count()
        time.sleep(3)
        assert spark.table("merged").filter("kind = 'ping'").count() == pings
    finally:
        q.stop()


def test_alerts_are_applied_once(spark, tmp_path):
    path, log = str(tmp_path / "alerts"), str(tmp_path / "log")
    batches = [
        [("a", 1, 3, False, "x" * 100), ("b", 2, 2, False, "few"), ("c", 3, 5, False, None)],
        [("a", 4, 4, False, "again"), ("c", 5, 0, True, None)],
        [("c", 4, 9, False, "late"), ("d", 6, 3, False, "d"), ("b", 7, 1, True, None)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, guards.REPORT).coalesce(1).write.mode("append").parquet(log)
        guards.keep_alerts(spark.readStream.schema(guards.REPORT).parquet(log), path, str(tmp_path / "state")).awaitTermination()
    want = [("a", "again", 4), ("d", "d", 3)]
    assert sorted(tuple(r) for r in guards.open_alerts(spark, path).collect()) == want
    # The last batch again, as after a failure between its commit and the stream's own: nothing changes.
    before, tag = versions.current(spark, path), versions.tag_of(spark, path)
    assert tag == "2"
    (tmp_path / "state" / "commits" / "2").unlink()
    (tmp_path / "state" / "commits" / ".2.crc").unlink(missing_ok=True)
    guards.keep_alerts(spark.readStream.schema(guards.REPORT).parquet(log), path, str(tmp_path / "state")).awaitTermination()
    assert versions.current(spark, path) == before
    guards.end_run(spark, path)
    assert guards.open_alerts(spark, path).count() == 0 and versions.tag_of(spark, path) == tag
