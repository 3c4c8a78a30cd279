"""What the findings of round 3 named, each on a table on which the code before them failed."""

import datetime as dt
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.functions import parse
from millrace.functions import signals as sg
from millrace.operators import aggregates as ag
from millrace.operators import dedup as dd
from millrace.operators import metric
from millrace.operators import search as se
from millrace.operators import setjoin
from millrace.plans import catalogue, q_signals
from millrace.streaming import guards

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_sums_at_a_limit(spark, tmp_path):
    """a mean that is a whole number of hundredths falls to neither side by the order of rows."""
    values = [87.38, 24.61, 37.35, 35.61, 14.7, 82.53, 57.82]
    rows = [(i, dt.datetime(2024, 1, 1), u, "view", x, "{}") for u, order in enumerate((values, values[::-1], sorted(values))) for i, x in enumerate(order)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    got = catalogue.QUERIES["progress_estimate"](spark, str(tmp_path)).collect()
    assert {(r.percent, r.remaining) for r in got} == {(50, round(sum(values)))}
    odd = spark.createDataFrame([(1, 1e300), (1, 1.0), (2, float("nan")), (2, 1.0), (3, None), (4, 1e-13), (4, 2.0)], "k int, x double")
    assert [repr(r.s) for r in odd.groupBy("k").agg(ag.exact_sum(F.col("x")).alias("s")).orderBy("k").collect()] == ["1e+300", "nan", "None", "2.0000000000001"]


def test_reasons_are_the_ten_most_frequent(spark):
    """not three of them."""
    sf = "/root/testdata/sf0.001"
    got = [r.key for r in catalogue.QUERIES["reasons_topn"](spark, sf).collect()]
    each = q_signals.kept(spark, sf).select(F.explode("rejected_by").alias("key")).distinct().collect()
    assert len(got) > 3 and set(got) == {r.key for r in each}


def test_vectors_move_few_times(spark):
    """where no cell can be ruled out a vector moves once for each large block, not once for each thousand vectors."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(list(enumerate(rng.normal(size=(20_000, 16)).tolist())), "id long, e array<double>").withColumn("w", F.lit(1).cast("long"))
    cells = metric.partition(df, 0.4, 16)
    assert metric.units(df, cells, 16).count() < 8 * 20_000


def test_edges_are_computed_once(spark):
    """the rounds of a greedy choice read edges that were stored once."""
    asked = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            asked.add(len(b))
            yield b

    edges = spark.createDataFrame([(i, i + 1) for i in range(9)], "u long, v long").mapInPandas(run, "u long, v long")
    got = dd.greedy_keep(spark.range(12).withColumnRenamed("id", "ord"), edges).filter("kept").collect()
    assert sorted(r.ord for r in got) == [0, 2, 4, 6, 8, 10, 11] and asked.value == 9


def counted(df, asked):
    """df, whose rows are added to asked whenever they are computed."""

    def run(batches):
        for b in batches:
            asked.add(len(b))
            yield b

    return df.mapInPandas(run, df.schema)


def test_texts_are_signed_once(spark, monkeypatch):
    """each run of the index signs its own texts. F9, F12: insertion computes signatures once, and a row's signature is the plain one."""
    sign, asked = dd.signatures, spark.sparkContext.accumulator(0)
    monkeypatch.setattr(dd, "signatures", lambda rows, *more: sign(counted(rows.select("ord", "answer"), asked), *more))
    catalogue.QUERIES["dup_index_near"](spark, "/root/testdata/sf0.001").collect()
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert asked.value == n
    kept, pairs = dd.insert_in_order(dd.signatures(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "ord long, answer string"), "answer"))
    assert (sorted(kept.collect()), pairs.collect()) == ([(1, True), (2, False), (3, True)], [(1, 2)]) and asked.value == n + 3


def test_pieces_hold_few_bytes(spark):
    """texts become objects a megabyte at a time."""
    texts = ["x" * 400_000] * 7 + [None, "y" * 3_000_000, ""]
    got = list(dd.pieces(pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], names=["ord", "text"]), 1))
    assert [b.num_rows for b in got] == [2, 2, 2, 2, 1, 1] and [x for b in got for x in b.column(1).to_pylist()] == texts


def test_record_hash_is_that_of_sorted_json(spark):
    """whatever signs the texts have; Python reads the sampling alone."""
    texts = ["".join(map(chr, range(0x300))) + " ퟿\U0001f600\\n\"", "", None, 'a"b\\', "\x0b", "\x00\x1f"]
    rows = [(i, x, texts[-1 - i], m) for i, x in enumerate(texts) for m in ("thinking", "nothinking", None)]
    df = spark.createDataFrame(rows, "i int, x string, y string, m string")
    sampling = F.when(F.col("i") % 2 == 0, '{"top_p":0.80,"a":[1,2.50,"é"]}')
    hashed = df.select("*", sampling.alias("s"), parse.record_hash(F.col("y"), F.col("x"), F.col("m"), sampling, F.lit(""), F.lit(None).cast("string"), F.col("y")).alias("h"))
    for r in hashed.collect():
        body = {"prompt": r.y, "answer": r.x, "mode": r.m, "sampling": json.loads(r.s) if r.s else None, "system_prompt": "", "config_hash": None} | ({"thinking_trace": r.y} if r.m == "thinking" else {})
        assert r.h == "sha256-" + hashlib.sha256(json.dumps(body, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    plan = df.select(parse.record_hash(F.col("y"), F.col("x"), F.col("m"), sampling, F.lit(""), F.lit("c"), F.col("y")))._jdf.queryExecution().executedPlan().toString()
    assert "run(" in plan and not re.search(r"run\([^)]*\b[xy]#", plan)


def test_texts_are_objects_a_piece_at_a_time(spark):
    """a batch of long texts isn't turned into objects whole."""
    texts = pa.array(["x" * 400_000] * 7 + [None, "y" * 3_000_000, ""])
    assert [len(p) for p in parse.pieces(texts)] == [2, 2, 2, 2, 1, 1]
    df = spark.createDataFrame([("abcdabcd",), ("",), ("abcabc",)], "x string").coalesce(1)
    assert [r[0] for r in df.select(parse.repeat_share(F.col("x"))).collect()] == [0.4, 0.0, 0.0]
    assert df.limit(0).select(parse.repeat_share(F.col("x"))).collect() == []


def test_terms_are_counted_without_a_shuffle(spark):
    """F8, F16: a document's terms are counted in its own task."""
    rows = [(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["é", "b"])]
    got = se.counts(spark.createDataFrame(rows, "doc long, tokens array<string>").coalesce(1))
    assert {r.doc: (r.dl, {(x.term, x.tf) for x in r.terms}) for r in got.collect()} == {1: (3, {("a", 2), ("b", 1)}), 2: (0, set()), 3: (0, set()), 4: (2, {("é", 1), ("b", 1)})}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_texts_of_unlike_sets_stay_where_they_are(spark, monkeypatch):
    """sets that share a passage at their prefix and nothing else are ruled out by their bits; only texts that may be linked move to be verified."""
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    rows = [(i, f"{words('p', 40)} {words(f'x{i}_', 60)}") for i in range(12)] + [(100 + i, f"{words('q', 80)} z{i}") for i in range(3)]
    moved, shared = [], setjoin._shared
    monkeypatch.setattr(setjoin, "_shared", lambda work, *more: moved.append(work.select(F.sum(F.size("texts"))).first()[0]) or shared(work, *more))
    got = setjoin.linked(spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "id long, text string"), "id", "text", 0.8)
    assert {(r.id, r.n_links) for r in got.collect()} == {(i, 2 if i >= 100 else 0) for i, _ in rows} and 3 <= moved[0] <= 6


def test_bits_rule_out_no_link():
    """rows of bits, of one or different lengths, differ in no more bits than their sets in shingles."""
    rng = np.random.default_rng(7)
    for _ in range(300):
        a = np.unique(rng.integers(-(1 << 62), 1 << 62, rng.integers(1, 3000)))
        b = np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * rng.random())), replace=False), rng.integers(-(1 << 62), 1 << 62, rng.integers(0, 900))]))
        assert setjoin.apart(setjoin.bits(a), setjoin.bits(b)) <= len(np.setxor1d(a, b))
    assert setjoin.apart(setjoin.bits(a), setjoin.bits(a)) == 0


def test_changes_send_narrow_rows_and_state_together(spark, monkeypatch, tmp_path):
    """of a conversation's turns no texts move to be compared, and keys' states travel with their rows, not one call a key."""
    seen, changes = [], guards.changes

    def watched(stream, *more):
        out = changes(stream, *more)
        seen.append((stream.columns, out._jdf.queryExecution().logical().toString()))
        return out

    monkeypatch.setattr(guards, "changes", watched)
    texts = [(1, 0, "a"), (1, 1, "ab"), (1, 2, "xy"), (1, 4, None), (1, 5, "abc"), (2, 0, None), (2, 4, "ab"), (2, 6, "a"), (2, 7, "abc")]
    spark.createDataFrame([(c, t, "user", x) for c, t, x in texts], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.ord >> 32) for r in catalogue.QUERIES["changes_stream"](spark, str(tmp_path)).collect()}
    assert got == {(1, 0), (1, 1), (1, 5), (2, 0), (2, 6)}
    assert all("text" not in columns and "WithState" in plan and "TransformWithState" not in plan for columns, plan in seen)


def test_words_of_made_up_data_are_found_as_bytes(spark):
    """the words of the pattern are looked for one by one, and found where it finds them."""
    texts = [*[f"a {w} b" for w in sg.VIRTUAL_WORDS], "仮想デ－タ", "架 空", "(例", "（例)", "推測", "サンプル データ", "", None, "架", "空架空"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, answer string")
    found = sg.evaluate(df, ["VIRT-DATA"])
    got = {r.i: (r.signals[0].hard, r.signals[0].raw) for r in found.collect()}
    want = {i: re.search(sg.VIRTUAL_DATA, x or "") for i, x in enumerate(texts)}
    assert got == {i: (m is not None, m and m.group()) for i, m in want.items()} and sum(m is not None for m in want.values()) == len(sg.VIRTUAL_WORDS) + 1
    assert "RLIKE" not in found._jdf.queryExecution().optimizedPlan().toString().upper()
