"""Edge cases of the operators, and order-sensitive ones against plain Python."""

import json
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import parse
from millrace.functions import signals as sg
from millrace.functions import text as t
from millrace.operators import aggregates as ag
from millrace.operators import dedup as dd
from millrace.operators import incremental as inc
from millrace.operators import score as sc
from millrace.operators import search as se
from millrace.operators import variants as va
from millrace.plans import catalogue
from millrace.sources import readers, sinks
from millrace.streaming import live

SF = "/root/testdata/sf0.001"
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


def signal(spark, code, limits=None, **fields):
    kinds = {"tools": "array<string>", "tool_calls": "array<struct<name:string>>", "suspected_unparsed_tool_calls": "array<string>"}
    row = {"answer": "", "mode": "thinking"} | fields
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in row))
    return sg.evaluate(df, [code], limits).first().signals[0]


@pytest.mark.parametrize("n,hard", [(29, True), (30, False), (2015, False), (4000, False), (4001, True)])
def test_length_limits(spark, n, hard):
    assert signal(spark, "LEN-A", answer="x" * n).hard is hard


def test_thinking_signals_are_neutral_elsewhere(spark):
    for mode in ("nothinking", None):
        assert signal(spark, "LEN-T", mode=mode).score == 1.0
        assert not signal(spark, "RATIO-TA", mode=mode).hard


@pytest.mark.parametrize("tt,hard,score", [(5, False, 0.5), (4, True, 0.5), (50, False, 1.0), (300, False, 1.0), (1000, False, 0.5), (1001, True, 0.5)])
def test_ratio(spark, tt, hard, score):
    s = signal(spark, "RATIO-TA", answer="a" * 100, thinking_trace="t" * tt)
    assert (s.hard, s.score) == (hard, score)


@pytest.mark.parametrize(
    "reason,answer,hard",
    [("length", "Done.", True), ("stop", "no end", False), (None, "# Title", True), (None, "| a | b", True), (None, "and so,", True), (None, "語" * 200, False), (None, "語" * 201, True), ("tool_loop_exhausted", "# T", False), ("error", "fine.  ", False), (None, "", True)],
)
def test_truncation(spark, reason, answer, hard):
    assert signal(spark, "TRUNC", answer=answer, finish_reason=reason).hard is hard


def test_language_counts_scripts_not_punctuation(spark):
    assert signal(spark, "LANG-JA", answer="これは　日本語です。").score == 1.0
    assert signal(spark, "LANG-JA", answer="。！？").hard
    assert signal(spark, "LANG-JA", answer="$$$かな").score == pytest.approx(2 / 5)


@pytest.mark.parametrize("text,run", [("", 0), ("abc", 1), ("aaaab", 4), ("😀😀😀", 3)])
def test_longest_run(spark, text, run):
    assert one(spark, text, sg.longest_run) == run


@given(st.text(alphabet="abあ😀", max_size=40))
@FEW
def test_repeat_share_agrees(spark, s):
    grams = [s[i : i + 4] for i in range(len(s) - 3)]
    want = sum(grams.count(g) > 1 for g in grams) / len(grams) if grams else 0.0
    assert one(spark, s, parse.repeat_share) == pytest.approx(want)
    got = one(spark, s, dd.shingles)
    x = " ".join(s.split())
    assert sorted(got) == sorted({x[i : i + 5] for i in range(len(x) - 4)} or {x})


@pytest.mark.parametrize("short", [0, 40, parse.SHORT])
def test_triples_are_what_a_pattern_finds(monkeypatch, short):
    monkeypatch.setattr(parse, "SHORT", short)
    rng = random.Random(short)
    found = 0
    for _ in range(3000):
        s = "".join(rng.choice("ab😀") for _ in range(rng.randrange(40)))
        if rng.random() < 0.3:
            s = s[: rng.randrange(9)] + s[:7] * rng.choice((2, 3)) + s[-5:]
        want = re.search(r"(?s)(.{4,})\1\1", s) is not None
        found += want
        assert parse._tripled(s) == want, s
    assert found > 100


def test_classes_name_their_low_characters():
    assert t.one_of(r"a-c\x{fe}-\x{101}\x{fffd}") == r"\x{61}\x{62}\x{63}\x{fe}\x{ff}\x{100}-\x{101}\x{fffd}-\x{fffd}"
    assert t.one_of(sg.JAPANESE) == sg.JAPANESE


def test_screening_signals(spark):
    assert signal(spark, "END-WELL", answer="x ```code```").score == 1.0
    assert signal(spark, "END-WELL", answer="x ```code.").hard
    assert signal(spark, "CTRL-CHAR", answer="a\x7f").raw == "ctrl:127"
    assert signal(spark, "CTRL-CHAR", answer="ok\t\n", prompt="�").raw == "replacement_char"
    assert not signal(spark, "CTRL-CHAR", answer="ok\t\n").hard
    assert signal(spark, "TPL-LEAK", answer="x <|IM_START|>").hard
    for text, issue in (("(]", "mismatch:]"), ("[a", "unclosed:]"), ("`a", "unclosed_backtick"), ("```", "unclosed_fence"), ("$x", "unclosed_dollar"), (r"\$x ok", None), ("(a[b]{c})", None)):
        assert signal(spark, "SYNTAX-BREAK", answer=text).raw == issue


def test_tool_signals(spark):
    assert signal(spark, "TOOL-PLAN", answer="a", tools=["s"], thinking_trace="I should use search").hard
    assert not signal(spark, "TOOL-PLAN", answer="a", tools=["s"], tool_calls=[("s",)], thinking_trace="I should use search").hard
    assert signal(spark, "TOOL-CLAIM", answer="I searched for it", tools=["s"]).hard
    assert signal(spark, "FACT-HALL", answer="２８℃です", tools=["s"]).hard
    assert not signal(spark, "FACT-HALL", answer="28℃").hard
    assert signal(spark, "TOOL-LEAK", answer="a", suspected_unparsed_tool_calls=["x"]).hard
    assert not signal(spark, "TOOL-LEAK", answer="a").hard
    assert signal(spark, "STYLE-FMT", answer="go on go on go on ", style_id="report").raw == "triple_repeat"
    assert signal(spark, "STYLE-FMT", answer="- item", style_id="prose").hard
    assert signal(spark, "STYLE-FMT", answer="x" * 3 + "y" * 3 + " z", style_id="qa_short").score == 1.0


def test_rubric_parsing(spark):
    keys = ["a", "b", "c"]
    got = one(spark, 'x {"a": 2.5, "b": 9} y', lambda c: sg.parse_rubric(c, keys))
    assert got == {"a": 2, "b": 5, "c": 3}
    assert one(spark, '{"winner": "B"}', sg.parse_pair) == "b"
    assert one(spark, "nothing", sg.parse_pair) == "tie"
    assert (one(spark, '{"score": 7}', sg.parse_self), one(spark, "?", sg.parse_self)) == (1.0, 0.5)


def scored(spark, rows):
    return spark.createDataFrame(rows, "ord long, final_score double, hard array<string>")


@pytest.mark.parametrize("n", [1, 3, 5])
def test_keep_rate_rounds_half_to_even(spark, n):
    df = scored(spark, [(i, 0.5, []) for i in range(n)])
    kept = sorted(r.ord for r in sc.select(df, keep_rate=0.5).filter("accepted").collect())
    assert kept == list(range(round(0.5 * n)))


def test_select_edges(spark):
    df = scored(spark, [(0, 0.9, ["X"]), (1, 0.8, []), (2, 0.8, []), (3, 0.1, [])])
    pick = lambda **k: {r.ord: r.rejected_by for r in sc.select(df, **k).collect()}
    assert pick(top_k=1) == {0: ["X"], 1: [], 2: ["BELOW_THRESHOLD"], 3: ["BELOW_THRESHOLD"]}
    assert pick(top_k=9)[3] == []
    assert pick(threshold=0.8)[2] == []
    assert pick(top_k=0)[1] == ["BELOW_THRESHOLD"]
    assert pick(keep_rate=0.4, top_k=3) == pick(top_k=1)
    assert sc.select(scored(spark, [(0, 0.9, ["X"])]), keep_rate=0.5).first().accepted is False


@given(st.lists(st.tuples(st.sampled_from(["OK", "REVIEW", "NG"]), st.integers(0, 5)), min_size=1, max_size=15), st.sampled_from([0.0, 0.3, 1.0]))
@FEW
def test_review_quota(spark, rows, rate):
    df = spark.createDataFrame([(i, s / 5, x) for i, (x, s) in enumerate(rows)], "ord long, final_score double, screening_label string")
    got = {r.ord: r.screening_label for r in sc.review_quota(df, rate).collect()}
    review = sorted((s, i) for i, (x, s) in enumerate(rows) if x == "REVIEW")
    gone = {i for _, i in review[: max(0, len(review) - int(rate * len(rows)))]}
    assert got == {i: "NG" if i in gone else x for i, (x, _) in enumerate(rows)}


def test_outliers_need_five_rows_and_spread(spark):
    rows = [(i, 0.9, [], 0.5, 0.8) for i in range(9)] + [(9, 0.0, ["X"], 0.5, 0.8)] + [(10 + i, float(i), [], 0.6, 0.8) for i in range(4)] + [(20 + i, 0.5, [], None, None) for i in range(6)]
    df = spark.createDataFrame(rows, "ord long, final_score double, hard array<string>, temperature double, top_p double")
    assert {r.ord: r.hard for r in sc.sample_outliers(df).collect() if "SAMP-OUT" in r.hard} == {9: ["X", "SAMP-OUT"]}


def test_best_of_n_ties_by_hash(spark):
    rows = [("p", None, "b", 0.5, []), ("p", None, "a", 0.5, []), ("p", None, "c", 0.9, ["X"]), ("q", None, "d", 0.1, [])]
    df = spark.createDataFrame(rows, "prompt string, mode string, record_hash string, stat_score double, hard array<string>")
    assert {r.record_hash: r.hard for r in sc.best_of_n(df).collect()} == {"a": [], "b": ["BEST-OF-N"], "c": ["X"], "d": []}


def test_win_rates_without_pairs(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, 0, 1, 255, 256, 257, 511, 512, 5000, *range(20)])) for i in range(400)] + [(400, "alone", 7), (401, "nulls", None), (402, "nulls", None)]
    got = {r.ord: r.win_rate for r in sc.value_win_rate(spark.createDataFrame(rows, "ord long, g string, n int"), ("g",), "ord", "n").collect()}
    assert len(got) == len(rows)
    for i, g, n in rows:
        p = [0.5 if None in (n, m) or n == m else float(n > m) for j, h, m in rows if h == g and j != i]
        assert got[i] == pytest.approx(sum(p) / len(p) if p else 1), i


def test_win_rates_of_any_judge(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, rng.choice("xyz"), rng.randrange(4)) for i in range(25)], "ord long, g string, n int")
    higher = lambda a, b: F.when(F.col(f"{a}.n") > F.col(f"{b}.n"), "a").when(F.col(f"{a}.n") < F.col(f"{b}.n"), "b").otherwise("tie")
    each = lambda out: {r.ord: pytest.approx(r.win_rate) for r in out.collect()}
    assert each(sc.pair_win_rate(df, ("g",), "ord", higher)) == {k: w.expected for k, w in each(sc.value_win_rate(df, ("g",), "ord", "n")).items()}


def test_compose(spark):
    f = lambda llm, **k: one(spark, llm, lambda c: sc.compose(F.lit(0.5), c, **k), "double")
    assert f(None) == 0.5 and f(1.0) == pytest.approx(0.8) and f(1.0, w_stat=0.0, w_llm=0.0) == 0.0


@given(st.integers(0, 10_000))
@FEW
def test_greedy_equals_sequential(spark, seed):
    rng = random.Random(seed)
    n = rng.randint(1, 14)
    edges = [(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.25]
    kept: set[int] = set()
    for v in range(n):
        if not any(u in kept for u, w in edges if w == v):
            kept.add(v)
    nodes = spark.createDataFrame([(i,) for i in range(n)], "ord long")
    got = {r.ord for r in dd.greedy_keep(nodes, spark.createDataFrame(edges, "u long, v long")).filter("kept").collect()}
    assert got == kept


def test_copies_meet_in_order(spark):
    df = spark.createDataFrame([(0, "the same text here"), (1, "the  same text here"), (2, "quite another one")], "ord long, answer string")
    kept, pairs = dd.insert_in_order(dd.signatures(df, "answer"))
    assert {r.ord: r.kept for r in kept.collect()} == {0: True, 1: False, 2: True}
    assert [(r.u, r.v) for r in pairs.collect()] == [(0, 1)]


@pytest.mark.parametrize("seed", range(4))
def test_insertion_equals_sequential(spark, seed):
    rng = random.Random(seed)
    # Two bands of one minimum; a third of all rows share the bucket of the first band.
    rows = [(i, [0 if rng.random() < 0.35 else rng.randrange(1, 12), rng.randrange(9)]) for i in range(60)] + [(60, None)]
    index, want, met = {}, set(), set()
    for n, sig in rows:
        spots = list(enumerate(sig or []))
        hits = {index[x] for x in spots if x in index}
        met |= {(u, n) for u in hits}
        if not hits:
            want.add(n)
            index |= dict.fromkeys(spots, n)
    kept, pairs = dd.insert_in_order(spark.createDataFrame(rows, "ord long, sig array<long>"), bands=2, rows=1)
    got = {r.ord: r.kept for r in kept.collect()}
    assert len(got) == len(rows) and {n for n, k in got.items() if k} == want
    found = [(r.u, r.v) for r in pairs.collect()]
    assert len(found) == len(set(found)) and set(found) == met


def test_insertion_of_nothing(spark):
    kept, pairs = dd.insert_in_order(spark.createDataFrame([], "ord long, sig array<long>"))
    assert kept.isEmpty() and pairs.isEmpty()


def test_latest_run_key_wins(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 1, False), ("b", 2, True)], "k string, ord long, cut boolean")
    assert [r.k for r in inc.done_keys(df, ["k"], "ord", F.col("cut")).collect()] == ["a"]


def test_pending_matches_nulls(spark):
    rows = spark.createDataFrame([(None, 1.0), ("s", 1.0)], "k string, t double")
    assert inc.pending(rows, spark.createDataFrame([(None, 1.0)], "k string, t double"), ["k", "t"]).first().k == "s"


def test_variants_keep_missing_axes(spark):
    df = spark.createDataFrame([(1, "row", 0.3)], "ord long, style_id string, temperature double")
    assert [(r.style_id, r.temperature) for r in va.expand(df, {"temperature": [0.1, 0.2]}).orderBy("variant_no").collect()] == [("row", 0.1), ("row", 0.2)]
    assert va.expand(df, {}).count() == 1


def test_every_document_is_expanded(spark):
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    got = [(r.doc_id, r.variant_no) for r in catalogue.QUERIES["expand_variants"](spark, SF).collect()]
    assert sorted(got) == [(i, k) for i in sorted(ids) for k in range(12)]


def test_bins_keep_empty_ones(spark):
    df = spark.createDataFrame([(-1,), (0,), (10,), (25,)], "n int")
    assert [(r.lo, r.n) for r in ag.bins(df, F.col("n"), [0, 10, 20]).collect()] == [(0, 1), (10, 1), (20, 1)]
    assert [r.n for r in ag.bins(df.limit(0), F.col("n"), [0, 10]).collect()] == [0, 0]
    assert tuple(ag.summary(df.limit(0), F.col("n")).first()) == (0, 0.0, 0, 0)


def test_calibration_takes_the_first_best(spark):
    out = ag.calibrate(spark.createDataFrame([(0.99, True), (0.97, True), (0.1, False)], "final_score double, good boolean"))
    assert [r.threshold for r in out.filter("best").collect()] == [0.5]


def test_bm25_gives_all_filtered_rows(spark):
    df = spark.createDataFrame([(0, "red fish"), (1, "blue fish blue"), (2, "東京タワー"), (3, "")], "ord long, text string")
    index = se.build(df, text="text")
    rank = lambda q, **k: [r.ord for r in se.search(index, df, q, **k).collect()]
    assert rank("blue")[0] == 1 and len(rank("blue")) == 4
    assert rank("東京")[0] == 2
    assert rank("  ") == [0, 1, 2, 3] and rank("!!") == [] and rank("blue", offset=9) == []


def test_text_functions(spark):
    assert one(spark, "東京 ab", t.tokenize) == ["ab", "東", "京", "東京"]
    assert one(spark, "<think>a</think>b<think>c</think>", t.extract_thinking) == ("a", "b")
    assert one(spark, "</think>x <think> open", t.strip_think) == "x"
    assert one(spark, "abc" * 100, lambda c: t.snippet(c, "zz", 20)).endswith("…")
    assert one(spark, "x" * 50 + "key" + "y" * 50, lambda c: t.snippet(c, "KEY", 20)) == "…" + "x" * 10 + "key" + "y" * 7 + "…"
    assert one(spark, "x\r\ny\rz\x07", t.sanitize) == "x\ny\nz"
    assert [one(spark, x, t.parse_duration) for x in ("1h30m", "45s", "?")] == [5400, 45, None]
    assert [one(spark, n, t.format_duration, "long") for n in (0, 3600, 3725, -5)] == ["0s", "1h", "1h2m5s", "0s"]
    assert one(spark, "", t.looks_truncated) is True


def test_whole_texts_are_tokenized_and_stripped(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert max(map(len, texts.values())) > 2000
    run = lambda name: {r.ord: r for r in catalogue.QUERIES[name](spark, SF).collect()}
    tokens, extracted, stripped = run("tokenize"), run("extract_thinking"), run("strip_think")
    assert set(tokens) == set(extracted) == set(stripped) == set(texts)
    for i, x in texts.items():
        assert (tokens[i].tokens or "").split() == re.findall("[a-z0-9]+", x.lower())
        assert x.strip() in extracted[i].body and x.strip() in stripped[i].body


def test_record_key_counts_code_points(spark):
    def plain(*parts):
        h = 2166136261
        for ch in "\x1e".join(parts):
            h = ((h ^ ord(ch)) * 16777619) & 0xFFFFFFFF
        digits = ""
        while h:
            h, r = divmod(h, 36)
            digits = "0123456789abcdefghijklmnopqrstuvwxyz"[r] + digits
        return digits or "0"

    assert one(spark, "é😀", lambda c: t.fnv_key(c, F.lit("b"))) == plain("é😀", "b")


def test_find_calls():
    found = parse.find_calls('a <tool_call>{"name": "s", "arguments": {"q": "}"}}</tool_call> b ```json\n{"name": "c", "arguments": {}}\n``` {"name": "s", "arguments": 1} {"name": "no", "arguments": {}}', frozenset(["s"]))
    assert [c["name"] for c in found["calls"]] == ["s", "c", "s"]
    assert found["calls"][0]["arguments"] == '{"q": "}"}' and found["cleaned"] == 'a  b   {"name": "no", "arguments": {}}'
    assert len(found["hints"]) == 1
    bad = parse.find_calls("<tool_call>{oops}</tool_call> x", frozenset())
    assert bad["calls"] == [] and bad["cleaned"] == "x" and bad["hints"] == ["<tool_call>{oops}</tool_call>"]
    assert parse.find_calls(None, frozenset()) == {"calls": [], "cleaned": "", "hints": []}


def test_other_parsers(spark):
    assert one(spark, 'x ["a", "b "] ["c"]', parse.prompt_array) == ["a", "b", "c"]
    assert one(spark, 'no list "p"', parse.prompt_array) == ["p"]
    assert [one(spark, x, parse.calc) for x in ("2+3*4", "2**-1", "1/0", "open('x')", None)] == [14.0, 0.5, None, None, None]
    assert one(spark, "ｆｕｌｌ", parse.nfkc) == "full"
    assert one(spark, "<title>T</title><nav>n</nav><p>a</p><script>s</script><p>b", parse.html_text) == "Title: T\nBody: a\nb"


def test_scan_skips_what_is_no_object(spark, tmp_path):
    good = {"prompt": "p", "answer": "a", "mode": "m", "sampling": {}, "config_hash": "c"}
    lines = [json.dumps(good), "", "{bad", "[1]", "3", json.dumps({"prompt": "only"}), '{"prompt": "x", "prompt": "y"}', json.dumps({"prompt": "u v"}, ensure_ascii=False)]
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    rows = readers.records(spark, str(tmp_path / "r.jsonl")).orderBy("ord").collect()
    assert [(r.prompt, r.schema_ok) for r in rows] == [("p", True), ("only", False), ("y", False), ("u v", False)]
    assert readers.records(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_bank_csv_and_files(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"prompt": " p ", "sampling": {"top_p": 0.5, "x": 1}, "tool_ids": ["t"]}\n{"prompt": " "}\n')
    (row,) = readers.prompt_bank(spark, str(tmp_path / "b.jsonl")).collect()
    assert (row.prompt, row.sampling, row.tool_ids) == ("p", {"top_p": 0.5}, ["t"])
    (tmp_path / "c.csv").write_text("﻿分野,プロンプト\nx, hello \n,\n,alone\n", encoding="utf-8")
    assert [(r.prompt, r.category) for r in readers.csv_bank(spark, str(tmp_path / "c.csv")).collect()] == [("hello", "x"), ("alone", None)]
    (tmp_path / "log.txt").write_text("héllo")
    assert readers.tail(spark, str(tmp_path / "log.txt"), 2) == ("llo", 5)
    (tmp_path / "p.txt").write_text("# version: v3\n# eval_version: e1\nbody\n")
    assert tuple(readers.prompt_file(spark, str(tmp_path / "p.txt")).first()) == ("v3", "e1", "body")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a\x00b\r\n", ["x\x01"])], "s string, a array<string>")
    sinks.append_jsonl(df, str(tmp_path / "o"))
    sinks.append_jsonl(df, str(tmp_path / "o"))
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "o")).collect()] == [{"s": "ab\n", "a": ["x"]}] * 2
    assert len(sinks.bundle(df)) > 1000
    sinks.write_document(spark, str(tmp_path / "d.json"), {"n": 1})
    assert json.loads((tmp_path / "d.json").read_text()) == {"n": 1, "_meta": {"schema": 1}}


def test_streams(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    kind = "request_id string, ord long, tool_call_index int, call_id string, name string, arguments_delta string, delta string, finish_reason string"
    rows = [("r", 0, 0, "c0", "s", '{"a"', None, None), ("r", 1, 1, "c1", "t", "oops", None, None), ("r", 2, 0, None, None, ": 1}", None, None), ("r", 3, None, None, None, None, None, "tool_calls")]
    rows += [("q", 10 + i, None, None, None, None, "</think>", None) for i in range(5)]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    want = {(0, "c0", "s", '{"a": 1}'), (1, "c1", "t", "{}")}

    def run(make, name):
        stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        q = make(stream).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert {tuple(r)[1:] for r in run(live.assemble_stream, "assembled")} == want
    batch = live.assemble(spark.createDataFrame(rows, kind).filter("tool_call_index IS NOT NULL"))
    assert {tuple(r)[1:] for r in batch.select("request_id", "tool_call_index", "call_id", "name", "arguments").collect()} == want
    assert [(r.request_id, r.streak) for r in run(live.runaway_stream, "runaway")] == [("q", 5)]


def test_every_event_is_assembled(spark):
    ids = [f"r{r.event_id}" for r in spark.read.parquet(f"{SF}/events.parquet").select("event_id").collect()]
    got = catalogue.QUERIES["assemble_deltas"](spark, SF).collect()
    assert sorted(r.request_id for r in got) == sorted(ids)
    assert any(r.arguments != "{}" for r in got)


def test_all_server_sent_text_is_parsed(spark):
    rows = [(r.event_id, r.event_type) for r in spark.read.parquet(f"{SF}/events.parquet").select("event_id", "event_type").collect()]
    got = [tuple(r) for r in catalogue.QUERIES["sse_explode"](spark, SF).select("event_id", "pos", "event", "data").collect()]
    assert sorted(got) == sorted(x for i, kind in rows for x in ((i, 0, "delta", kind), (i, 1, "message", "[DONE]")))


def test_dimensions(spark, tmp_path):
    from millrace.sources import dimensions as dm

    (tmp_path / "d.json").write_text(json.dumps([{"key": "x", "target": 3, "aliases": ["y"], "other": 1}]))
    domains, aliases = dm.domains(spark, dm.load(spark, str(tmp_path / "d.json")))
    assert tuple(domains.first()) == ("x", 3, [], []) and [r.category for r in aliases.collect()] == ["x", "y"]
    assert dm.styles(spark, {"a": {"label": "A", "x": 1}}).first().label == "A"
    assert dm.tools(spark, {"t": {"description": "d"}}).first().parameters == "{}"
    scores = spark.createDataFrame([(True,), (False,), (True,)], "accepted boolean")
    body = dm.write_run_manifest(scores, str(tmp_path / "m.json"), {"all": dm.fingerprint({"a": 1})}, {"LEN-A": "v1"})
    assert body["keep_rate"] == 0.6667 and json.loads((tmp_path / "m.json").read_text())["kept"] == 2


def test_record_functions(spark):
    from millrace.functions import records as rc

    assert one(spark, '{"name": "n", "description": "d \\"q\\"", "parameters": {"a": 1}}', rc.adhoc_tool) == '{"type":"function","function":{"name":"n","description":"d \\"q\\"","parameters":{"a":1}}}'
    with pytest.raises(Exception, match="lacks name"):
        one(spark, '{"name": "n"}', rc.adhoc_tool)
    tools = F.array(F.struct(F.lit("s").alias("name"), F.lit("d").alias("description"), F.lit("when asked").alias("rule")))
    assert one(spark, "", lambda c: rc.usage_hint(tools, "none")).split("\n")[1] == "- s: when asked"
    assert one(spark, "", lambda c: rc.usage_hint(F.filter(tools, lambda x: F.lit(False)), "none")) == "none"
    assert one(spark, ["a"], lambda c: rc.needs_recovery(c, F.array(), F.lit("use search function"), F.lit(""), F.array()), "array<string>")
    assert not one(spark, [], lambda c: rc.needs_recovery(c, F.array(), F.lit("use search function"), F.lit(""), F.array()), "array<string>")
    assert one(spark, "prompt too long", lambda c: rc.retry_without_tools(c, F.lit(True)))
    assert one(spark, ['{"function": {"name": "a"}}', "{}"], rc.tool_names, "array<string>") == ["a"]
    assert [one(spark, x, rc.schema_version_ok) for x in ("1", "0", None, "x")] == [True, False, False, False]
    assert one(spark, 5, lambda c: rc.clamp(c, F.lit(3)), "int") == 3
    assert one(spark, "c", lambda c: rc.reconstruct_raw(F.lit("r"), c)) == "<think>r</think>\nc"
    assert one(spark, " ", lambda c: rc.first_filled(c, F.lit("b"))) == "b"
    assert "rescore" not in one(spark, 0, lambda c: rc.incremental_report(*[F.lit(1)] * 6, c), "int")


def test_sqlite_and_pages(spark, tmp_path):
    import sqlite3

    from pyspark.sql import types as T

    with sqlite3.connect(tmp_path / "s.db") as db:
        db.execute("CREATE TABLE sessions (session_id TEXT, updated REAL)")
        db.executemany("INSERT INTO sessions VALUES (?, ?)", [(f"s{i}", i // 2) for i in range(7)])
    kind = T.StructType([T.StructField("session_id", T.StringType()), T.StructField("updated", T.DoubleType())])
    rows = readers.sqlite_table(spark, str(tmp_path / "s.db"), "sessions", kind)
    page = readers.keyset_page(rows, "updated", "session_id", None, 3).collect()
    assert [(r.session_id, r.has_more) for r in page] == [("s6", True), ("s5", True), ("s4", True)]
    rest = readers.keyset_page(rows, "updated", "session_id", (2.0, "s4"), 9).collect()
    assert [(r.session_id, r.has_more) for r in rest] == [("s3", False), ("s2", False), ("s1", False), ("s0", False)]
    with pytest.raises(ValueError):
        readers.sqlite_table(spark, "x", "a; DROP TABLE b", kind)


def test_files_and_marks(spark, tmp_path):
    (tmp_path / "runs" / "a").mkdir(parents=True)
    (tmp_path / "runs" / "a" / "scores.jsonl").write_text("{}\n\n")
    assert readers.newest_artifact(spark, str(tmp_path / "runs"), "scores.jsonl").endswith("runs/a")
    assert readers.fingerprint(spark, str(tmp_path / "runs" / "a"))[1] == 1
    (tmp_path / "jobs").mkdir()
    (tmp_path / "jobs" / "1.json").write_text('{"id": "1", "created_at": "2024"}')
    (tmp_path / "jobs" / "2.json").write_text("{broken")
    assert [r.id for r in readers.json_directory(spark, str(tmp_path / "jobs"), "id string, created_at string").collect()] == ["1"]
    assert readers.has_content(spark.createDataFrame([(" ",), ("x",)], "value string"))


def test_versions_are_whole_and_indexes_go_stale(spark, tmp_path):
    from millrace.sources import versions

    path = str(tmp_path / "d")
    rows = spark.range(3).withColumnRenamed("id", "n")
    assert versions.read(spark, path, rows.schema).count() == 0
    versions.append(rows, path)
    versions.append(rows, path)
    assert versions.read(spark, path, rows.schema).count() == 6
    versions.rewrite(versions.read(spark, path, rows.schema).distinct(), path)
    (tmp_path / "d" / "v-broken").mkdir()  # a writer that died before its version was named
    assert sorted(r.n for r in versions.read(spark, path, rows.schema).collect()) == [0, 1, 2]
    assert versions.vacuum(spark, path, 0) == 0 or versions.read(spark, path, rows.schema).count() == 3
    docs = spark.createDataFrame([(1, "a b"), (2, "b c c"), (3, None)], "ord long, search_text string")
    index = se.build(docs)
    where = str(tmp_path / "index")
    assert se.load(spark, where, "s1") is None
    se.save(index, where, "s1")
    assert se.load(spark, where, "s2") is None
    want, got = (se.search(i, docs, "c b").select("ord", "score").collect() for i in (index, se.load(spark, where, "s1")))
    assert want == got
    kept = se.load(spark, where, "s1")
    word = spark.createDataFrame([("c",)], "term string").select("term", se.bucket_of(F.col("term")).alias("bucket")).first()
    plan = se.asked_of(kept.postings, [word])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(bucket" in plan and str(word.bucket) in plan and "EqualTo(term,c)" in plan


def test_unknown_styles_and_odd_responses(spark):
    from millrace.functions import messages as ms

    known = spark.createDataFrame([("a", 1)], "style_id string, preset int")
    assert va.presets(spark.createDataFrame([("a",)], "style_id string"), known).collect()[0].preset == 1
    with pytest.raises(Exception, match="unknown style b"):
        va.presets(spark.createDataFrame([("a",), ("b",)], "style_id string"), known).collect()
    assert one(spark, '{"choices": []}', ms.chat_result) is None
    got = one(spark, json.dumps({"choices": [{"message": {"content": None, "tool_calls": [{"function": {"name": "f", "arguments": {"x": 1}}}, {"id": 1}, {"function": {"name": "g", "arguments": "[1]"}}]}}]}), ms.chat_result)
    assert (got.thinking, got.answer, got.finish_reason) == (None, "", None)
    assert [c.name for c in got.tool_calls] == ["f", "<malformed>", "<malformed>"] and json.loads(got.tool_calls[0].arguments) == {"x": 1}


def test_appends_at_the_same_time_all_stay(spark, tmp_path):
    import threading

    from millrace.sources import versions

    path = str(tmp_path / "d")
    writers = [threading.Thread(target=lambda i=i: [versions.append(spark.range(i * 10 + j, i * 10 + j + 1), path) for j in range(4)]) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    kind = spark.range(1).schema
    assert sorted(r.id for r in versions.read(spark, path, kind).collect()) == [i * 10 + j for i in range(4) for j in range(4)]
    # A commit that another came before is refused, and taken anew.
    number, parts, _ = versions._latest(spark, path)
    assert not versions._create(spark, path, number, parts, "") and versions._latest(spark, path)[1] == parts


def test_kept_indexes_have_few_parts(spark, tmp_path):
    from millrace.sources import versions

    path = str(tmp_path / "seen")
    for i in range(20):
        dd.remember(spark.createDataFrame([(100 - i, j) for j in range(i, i + 3)], "ord long, bucket long"), path)
    assert len(versions.current(spark, path)) <= 3 * 3
    kind = versions.read(spark, path, dd.SEEN)
    want = {b: min(str(100 - i) for i in range(20) if i <= b < i + 3) for b in range(22)}
    got = dd.seen_before(spark.createDataFrame([(b, b) for b in range(23)], "ord long, bucket long"), path)
    assert {r.ord: r.seen for r in got.collect()} == want | {22: None} and kind.count() >= 22
    before = versions.current(spark, path)
    assert versions.vacuum(spark, path, 0) > 0 and versions.current(spark, path) == before
    # Parts that were merged by another meanwhile are left to it.
    for i in range(4):
        versions.append(kind.limit(1), path)

    def late(rows):
        versions.rewrite(kind, path)
        return rows

    versions.compact(spark, path, dd.SEEN, late)
    assert len(versions.current(spark, path)) == 1
