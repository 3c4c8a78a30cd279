"""Queries: kept indexes, staged gating, judges' signals, chat messages, and small lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import messages as ms
from ..functions import signals as sg
from ..functions import text as t
from ..operators import dedup as dd
from ..operators import incremental as inc
from ..operators import score as sc
from ..operators import search as se
from ..operators import variants as va
from ..sources import versions
from ..sources.scratch import scratch
from . import views as v
from .catalogue import query
from .q_text import BM
from .views import DOCS, SCORED

KEY = v.strip("coalesce(answer, '')")


@query(f"WITH {DOCS}, k AS (SELECT ord, {KEY} AS k FROM docs), e AS (SELECT k, min(ord::VARCHAR) AS seen FROM k WHERE ord % 2 = 0 GROUP BY k) SELECT ord, seen FROM k LEFT JOIN e USING (k) WHERE ord % 2 = 1")
def dup_index_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier run's records (here every other one) are kept in the index, in two steps; then a later run's are looked up, by their exact texts."""
    path = scratch(spark, "seen")
    placed = v.docs(spark, sf_dir).select("ord", F.xxhash64(t.strip(t.text(F.col("answer")))).alias("bucket"))
    for rest in (0, 2):
        dd.remember(placed.filter(F.col("ord") % 4 == rest), path)
    return dd.seen_before(placed.filter("ord % 2 = 1"), path)


@query()
def dup_index_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by min-hash bands."""
    path = scratch(spark, "seen")
    placed = lambda run: dd.buckets(dd.signatures(v.docs(spark, sf_dir).filter(run), "answer"))
    dd.remember(placed("ord % 2 = 0"), path)
    return dd.seen_before(placed("ord % 2 = 1"), path)


@query(f"""WITH {DOCS}, k AS (SELECT ord, {KEY} AS k, min(ord) OVER (PARTITION BY {KEY}) AS f FROM docs)
SELECT ord, 'DUP-GLOB' AS code, CASE WHEN k = '' OR f < ord THEN 0::DOUBLE ELSE 1 END AS score, CASE WHEN k = '' THEN 'empty' WHEN f < ord THEN f::VARCHAR END AS raw, k = '' OR f < ord AS hard FROM k""")
def signal_dup_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.docs(spark, sf_dir).select("ord", "answer", F.sha1(t.strip(t.text(F.col("answer"))).cast("binary")).alias("k"))
    found = dd.dup_signal(dd.mark_repeats(rows, F.col("k")), F.col("answer"))
    return found.select("ord", "signal.code", "signal.score", "signal.raw", "signal.hard")


def _marks(letter: str):
    keys = [f"{letter}-0{i}" for i in range(1, 5)]  # the fifth is missing and counts 3
    return F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*[(F.col("ord") % (i + 1) + 1).cast("double") for i in range(1, 5)]))


MEAN = "round(((ord % 2 + 1) + (ord % 3 + 1) + (ord % 4 + 1) + (ord % 5 + 1) + 3)::DOUBLE / 5 / 5, 6)"


@query(f"SELECT doc_id AS ord, 'LLM-HEALTH' AS code, 'health_rubric.ja.v1.0' AS version, {MEAN.replace('ord', 'doc_id')} AS score, false AS hard FROM documents")
def signal_llm_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.docs(spark, sf_dir).select("ord", sg.llm_health(_marks("L")).alias("s"))
    return d.select("ord", "s.code", "s.version", v.r6("s.score").alias("score"), "s.hard")


@query(f"SELECT doc_id AS ord, 'LLM-PROMPT-HEALTH' AS code, 'prompt_health_rubric.ja.v1.0' AS version, {MEAN.replace('ord', 'doc_id')} AS score, false AS hard FROM documents")
def signal_llm_prompt_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.docs(spark, sf_dir).select("ord", sg.llm_prompt_health(_marks("P")).alias("s"))
    return d.select("ord", "s.code", "s.version", v.r6("s.score").alias("score"), "s.hard")


@query(f"""WITH {DOCS}, x AS (SELECT *, mode = 'thinking' AND thinking_trace <> '' AND coalesce(answer, '') <> '' AS asked FROM docs), y AS (
SELECT ord, asked, CASE WHEN mode <> 'thinking' THEN 1::DOUBLE WHEN NOT asked THEN 0.5 WHEN ord % 7 = 0 THEN 0.5 ELSE (ord % 11) / 10::DOUBLE END AS score FROM x)
SELECT ord, round(score, 6) AS score, asked AND score < 0.3 AS hard FROM y""")
def signal_llm_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge's texts, one of seven unreadable."""
    o = F.col("ord")
    said = F.when(o % 7 == 0, "no idea").otherwise(F.concat(F.lit('so {"score": '), (o % 11 / 10).cast("string"), F.lit("}")))
    d = v.docs(spark, sf_dir).select("ord", "answer", "mode", "thinking_trace", F.lit(None).cast("string").alias("reasoning"), said.alias("said"))
    return d.select("ord", sg.llm_self(F.col("said"), 0.3).alias("s")).select("ord", v.r6("s.score").alias("score"), "s.hard")


GATED = f"WITH {SCORED}, g AS (SELECT ord, CASE WHEN len(hard) > 0 THEN 'rejected' WHEN ord % 3 = 0 THEN 'saved' ELSE 'judge' END AS gate FROM scored)"


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.scored(spark, sf_dir).select("ord", "hard")
    return inc.gate(rows, rows.filter("ord % 3 = 0"))


@query(f"{GATED} SELECT ord, gate FROM g")
def staged_gating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records a judge is asked about; a third of them have a judge's result already."""
    return _gated(spark, sf_dir).select("ord", "gate")


@query(f"{GATED} SELECT count(*) AS records, count(*) FILTER (gate = 'rejected') AS rejected, count(*) FILTER (gate = 'judge') AS judge_calls, count(*) FILTER (gate = 'saved') AS judge_saved FROM g")
def gating_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.gate_counters(_gated(spark, sf_dir))


@query(f"WITH {DOCS} SELECT ord, array_to_string(list_filter([nullif(thinking_trace, ''), nullif(answer, ''), nullif(category, ''), nullif(style_id, '')], lambda x: x IS NOT NULL), chr(10)) AS search_text FROM docs")
def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None)  # prompt and model, which these records lack
    return v.docs(spark, sf_dir).select("ord", ms.search_text(none, F.col("thinking_trace"), F.col("answer"), F.col("category"), F.col("style_id"), none).alias("search_text"))


@query(
    f"""{BM}, q AS (SELECT 'the' AS term, 1 AS times UNION ALL SELECT 'scum', 2), sc AS (SELECT ord, sum(times * idf * (tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (SELECT avg(dl) FROM dl))))) AS score FROM post JOIN q USING (term) JOIN terms USING (term) JOIN dl USING (ord) GROUP BY ord)
    SELECT ord, round(coalesce(score, 0), 4) AS score FROM docs LEFT JOIN sc USING (ord) ORDER BY round(coalesce(score, 0), 9) DESC, ord LIMIT 50"""
)
def bm25_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search of an index that was kept and opened again."""
    d = v.docs(spark, sf_dir)
    path = scratch(spark, "bm25")
    se.save(se.build(d, text="answer"), path, sf_dir)
    return se.search(se.load(spark, path, sf_dir), d, "the scum Scum").select("ord", "score")


@query("SELECT doc_id, source FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'added' FROM documents WHERE doc_id % 5 = 0")
def versioned_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, replaced by a part of itself, added to."""
    path, d = scratch(spark, "versioned"), v.table(spark, sf_dir, "documents").select("doc_id", "source")
    versions.rewrite(d, path)
    versions.rewrite(versions.read(spark, path, d.schema).filter("doc_id % 3 = 0"), path)
    versions.append(d.filter("doc_id % 5 = 0").withColumn("source", F.lit("added")), path)
    return versions.read(spark, path, d.schema)


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE lang END AS thinking, CASE WHEN doc_id % 2 = 0 THEN 'body ' || doc_id ELSE trim('body ' || doc_id) END AS answer, 'stop' AS finish_reason, (doc_id % 100)::INT AS prompt_tokens,
CASE WHEN doc_id % 3 = 0 THEN '<malformed>' ELSE 't' || doc_id % 4 END AS tool, CASE WHEN doc_id % 3 = 0 THEN '{}' ELSE '{"n": ' || doc_id || '}' END AS arguments FROM documents""")
def chat_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model server's responses: the thinking in its own field or in the content, arguments that can't be read in one of three."""
    d = F.col("doc_id")
    even, name = d % 2 == 0, F.concat(F.lit("t"), d % 4)
    call = F.to_json(F.struct(F.struct(name.alias("name"), F.when(d % 3 == 0, "{bad").otherwise(F.concat(F.lit('{"n": '), d, F.lit("}"))).alias("arguments")).alias("function")))
    content = F.when(even, F.concat(F.lit("body "), d, F.lit(" \n"))).otherwise(F.concat(F.lit("<think> "), F.col("lang"), F.lit("</think>body "), d))
    quote = lambda c: F.to_json(F.struct(c.alias("x")))
    inner = lambda c: F.substr(quote(c), F.lit(6), F.length(quote(c)) - 6)  # noqa: E731  a string as JSON
    reasoning = F.when(even, F.concat(F.lit(', "reasoning_content": '), inner(F.col("source")))).otherwise("")
    made = F.concat(F.lit('{"choices": [{"finish_reason": "stop", "message": {"content": '), inner(content), reasoning, F.lit(', "tool_calls": ['), call, F.lit(']}}], "usage": {"prompt_tokens": '), d % 100, F.lit("}}"))
    got = v.table(spark, sf_dir, "documents").select("doc_id", ms.chat_result(made).alias("r")).select("doc_id", "r.*")
    first = F.get("tool_calls", F.lit(0))
    return got.select("doc_id", "thinking", "answer", "finish_reason", "prompt_tokens", first["name"].alias("tool"), first["arguments"].alias("arguments"))


@query("""WITH d AS (SELECT doc_id, (doc_id % 3)::INT AS n FROM documents), m AS (SELECT doc_id, n, unnest(range(n + 2)) AS pos FROM d)
SELECT doc_id, pos::INT AS pos, CASE WHEN pos = 0 THEN 'user' WHEN pos = 1 THEN 'assistant' ELSE 'tool' END AS role, CASE WHEN pos = 0 THEN 'q' WHEN pos = 1 THEN 'a' || doc_id ELSE 'r' || (pos - 2) END AS content,
CASE WHEN pos > 1 THEN 'call_' || left(sha1(doc_id || ':' || (pos - 2)), 24) END AS tool_call_id, CASE WHEN pos = 1 THEN n ELSE NULL END AS calls FROM m""")
def tool_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of one message with a tool turn of no to two calls put after it."""
    d = F.col("doc_id")
    n = (d % 3).cast("int")
    each = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    calls = F.transform(each, lambda i: F.struct(F.concat(F.lit("t"), i).alias("name"), F.lit("{}").alias("arguments")))
    results = F.transform(each, lambda i: F.struct(F.concat(F.lit("t"), i).alias("name"), F.concat(F.lit("r"), i).alias("content")))
    none = F.lit(None)
    before = F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content"), none.alias("tool_calls"), none.alias("tool_call_id"), none.alias("name")).cast(ms.MESSAGE))
    rows = v.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(ms.tool_turn(before, d, F.concat(F.lit("a"), d), calls, results)).alias("pos", "m"))
    return rows.select("doc_id", "pos", "m.role", "m.content", "m.tool_call_id", F.when(F.col("m.tool_calls").isNotNull(), F.size("m.tool_calls")).alias("calls"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def session_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions turned to a line of JSON each and back."""
    c = v.table(spark, sf_dir, "conversations")
    kind = c.select("turn", "role", "text").schema.simpleString()
    line = c.groupBy("conv_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("turn", "role", "text")))).alias("line"))
    return line.select("conv_id", F.explode(F.from_json("line", f"array<{kind}>")).alias("m")).select("conv_id", "m.*")


@query("SELECT event_id FROM events WHERE event_type = 'click' AND user_id % 4 IN (0, 1)")
def jobs_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of one kind that are queued or running."""
    state = F.element_at(F.array(*map(F.lit, ("queued", "running", "done", "failed"))), (F.col("user_id") % 4 + 1).cast("int"))
    return v.table(spark, sf_dir, "events").filter((F.col("event_type") == "click") & state.isin("queued", "running")).select("event_id")


@query("SELECT source AS domain, 0.1::DOUBLE * (SELECT count(*) FROM documents) AS target, count(*) AS have FROM documents GROUP BY source HAVING count(*) < 0.8 * 0.1 * (SELECT count(*) FROM documents)")
def domains_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains that hold less than 0.8 of a tenth of all records."""
    d = v.table(spark, sf_dir, "documents")
    counts = d.groupBy(F.col("source").alias("domain")).agg(F.count(F.lit(1)).alias("have"))
    goal = d.agg((F.count(F.lit(1)) * 0.1).alias("target"))
    return va.open_domains(counts.select("domain").crossJoin(goal), counts)  # goal: one row


@query("SELECT doc_id, lang AS style_id, 'style ' || lang AS instruction FROM documents WHERE doc_id < 100")
def style_presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The presets of the first 100 input records."""
    known = spark.createDataFrame([(x, f"style {x}") for x in ("de", "en", "es", "fr")], "style_id string, instruction string")
    return va.presets(v.table(spark, sf_dir, "documents").filter("doc_id < 100").select("doc_id", F.col("lang").alias("style_id")), known).select("doc_id", "style_id", "instruction")


@query("SELECT doc_id, lang AS style_id, 'style ' || lang AS instruction FROM documents")
def style_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The presets of all records; an id that no preset has would be an error."""
    known = spark.createDataFrame([(x, f"style {x}") for x in ("de", "en", "es", "fr")], "style_id string, instruction string")
    return va.presets(v.table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("style_id")), known).select("doc_id", "style_id", "instruction")


@query("WITH h AS (SELECT doc_id, md5(source || chr(10) || text) AS h FROM documents) SELECT doc_id, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS id FROM h")
def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.seed_rows(v.table(spark, sf_dir, "documents"), "text", "source").select("doc_id", "id")


ALERTS = """r AS (SELECT 'u' || user_id AS run_key, event_id AS ord, event_id % 7 AS attempts, event_type = 'purchase' AS cleared, event_type AS prompt FROM events),
l AS (SELECT run_key, max(ord) AS ord FROM r WHERE cleared OR attempts >= 3 GROUP BY run_key), alerts AS (SELECT run_key, prompt AS prompt_preview, attempts FROM l JOIN r USING (run_key, ord) WHERE NOT cleared)"""


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = v.table(spark, sf_dir, "events")
    return inc.alerts(e.select(F.concat(F.lit("u"), "user_id").alias("run_key"), F.col("event_id").alias("ord"), (F.col("event_id") % 7).alias("attempts"), (F.col("event_type") == "purchase").alias("cleared"), F.col("event_type").alias("prompt")))


@query(f"WITH {ALERTS} SELECT run_key, prompt_preview, attempts FROM alerts")
def retry_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir)


@query(f"WITH {ALERTS} SELECT count(*) AS records, 0 AS tool_records, false AS active, (SELECT count(*) FROM alerts) AS retries FROM documents")
def live_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, missing ones filled in, with the live state."""
    stats = inc.filled(v.table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("records")), {"records": 0, "tool_records": 0})
    found = inc.attach_live(stats, spark.range(1).select(F.lit(False).alias("active")), _alerts(spark, sf_dir))
    return found.select("records", "tool_records", "live.active", "live.retries")


@query(f"""WITH {DOCS}, tree AS (SELECT category, style_id, count(*) AS n FROM docs GROUP BY ALL), a AS (
SELECT ord, CASE WHEN ord % 5 = 0 THEN 'gone' ELSE category END AS category, CASE WHEN ord % 7 = 0 THEN 'none' ELSE style_id END AS style_id, ord - 50 AS page FROM docs)
SELECT ord, CASE WHEN ord % 5 = 0 OR a.category IS NULL THEN 'categories' WHEN t.n IS NULL THEN 'styles' ELSE 'records' END AS level, CASE WHEN ord % 5 <> 0 THEN a.category END AS to_category, CASE WHEN t.n IS NOT NULL THEN t.style_id END AS to_style,
CASE WHEN t.n IS NULL THEN 0 ELSE least(greatest(0, page), (n + 49) // 50 - 1) END::BIGINT AS to_page FROM a LEFT JOIN tree t ON a.category = t.category AND a.style_id = t.style_id""")
def browse_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asked places, some unknown, with pages far out of range."""
    d = v.docs(spark, sf_dir)
    asked = d.select("ord", F.when(F.col("ord") % 5 == 0, "gone").otherwise(F.col("category")).alias("category"), F.when(F.col("ord") % 7 == 0, "none").otherwise(F.col("style_id")).alias("style_id"), (F.col("ord") - 50).alias("page"))
    tree = d.groupBy("category", "style_id").agg(F.count(F.lit(1)).alias("n"))
    return inc.resolve_browse(asked, tree).select("ord", "level", "to_category", "to_style", "to_page")
