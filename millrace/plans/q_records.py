"""Queries: functions of whole records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as rc
from ..sources import dimensions
from . import views as v
from .catalogue import query

DOCS, RESPONSES = v.DOCS, v.RESPONSES


@query(f"WITH {DOCS} SELECT ord, CASE WHEN ord % 3 = 0 THEN '-' ELSE CASE WHEN ord % 3 = 1 THEN ord::VARCHAR ELSE '-' END || '/' || ord END AS tokens, CASE WHEN finish_reason = 'length' THEN 'truncated' WHEN finish_reason = 'stop' THEN 'stop' WHEN {v.truncated('answer')} THEN 'truncated' ELSE coalesce(finish_reason, '-') END AS status FROM docs")
def record_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("ord")
    return v.docs(spark, sf_dir).select("ord", rc.tokens_label(F.when(o % 3 == 1, o), F.when(o % 3 != 0, o)).alias("tokens"), rc.status_label(F.col("finish_reason"), F.col("answer")).alias("status"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN NULL ELSE source END AS category, lang AS style_id, greatest(doc_id % 5 - 1, 0)::INT AS page FROM documents")
def browse_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs built from rows and read again; page 0 isn't written."""
    d = F.col("doc_id")
    url = F.concat(F.lit("http://x"), rc.browse_path(F.when(F.col("lang") != "en", F.col("source")), F.col("lang"), F.greatest(d % 5 - 1, F.lit(0)).cast("int")))
    return v.table(spark, sf_dir, "documents").select("doc_id", rc.browse_state(url).alias("s")).select("doc_id", "s.*")


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'error: down' WHEN 1 THEN 'switching a→b (' || doc_id || ')' WHEN 2 THEN 'starting b' WHEN 3 THEN 'active=a ready' ELSE 'status=idle' END AS line FROM documents")
def status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id") % 5
    profiles = F.array(F.struct(F.lit("a").alias("name"), F.lit(True).alias("ready")))
    on = lambda x, *i: F.when(d.isin(*i), x)
    status = F.when(d == 1, "switching").when(d == 2, "starting").otherwise("idle")
    return v.table(spark, sf_dir, "documents").select("doc_id", rc.status_line(on("down", 0), status, on("a", 1, 3), on("b", 1, 2), on(F.col("doc_id").cast("string"), 1), profiles).alias("line"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '快晴' WHEN 1 THEN '雷雨' WHEN 2 THEN 'コード7' ELSE '不明' END AS label FROM documents")
def weather_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id") % 4
    return v.table(spark, sf_dir, "documents").select("doc_id", rc.weather_label(F.when(d == 0, 0).when(d == 1, 95).when(d == 2, 7)).alias("label"))


@query("SELECT doc_id, '[search results for ''q'', top_k=2]' || chr(10) || '1. ' || source || chr(10) || '   url: u' || chr(10) || '   snippet: ' || CASE WHEN length(text) > 500 THEN left(text, 500) || chr(10) || '[truncated]' ELSE text END || chr(10) || '2. ' || lang AS said FROM documents")
def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = lambda *x: F.struct(*[c.alias(n) for c, n in zip(x, ("title", "url", "snippet"), strict=True)])
    none = F.lit(None).cast("string")
    hits = F.array(hit(F.col("source"), F.lit("u"), F.col("text")), hit(F.col("lang"), none, none))
    return v.table(spark, sf_dir, "documents").select("doc_id", rc.search_results(F.lit("q"), F.lit(2), hits).alias("said"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'search_web' WHEN 1 THEN 'search' WHEN 2 THEN 'calc' END AS tool, doc_id % 4 IN (1, 2) AS plans FROM documents")
def planned_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id") % 4
    said = F.when(d == 0, "try search_web here").when(d == 1, "we should use search now").when(d == 2, "let's call calc").otherwise("nothing")
    return v.table(spark, sf_dir, "documents").select("doc_id", rc.planned_tool(said, ["search", "search_web", "calc"]).alias("tool"), rc.plans_tools(said).alias("plans"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'given' WHEN 1 THEN 'in_answer' WHEN 2 THEN 'in_thinking' ELSE 'in_raw' END AS name, CASE WHEN doc_id % 4 = 1 THEN 'x' ELSE 'plain' END AS answer FROM documents")
def normalize_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a chat result's call comes from: what is given, the answer, the thinking, the raw completion."""
    d = F.col("doc_id") % 4
    call = lambda n: f'{{"name": "{n}", "arguments": {{}}}}'
    kind = "array<struct<name:string,arguments:string,raw:string>>"
    given = F.when(d == 0, F.array(F.struct(F.lit("given").alias("name"), F.lit("{}").alias("arguments"), F.lit("").alias("raw")))).otherwise(F.array().cast(kind))
    answer = F.when(d == 1, "x " + call("in_answer")).otherwise("plain")
    thinking = F.when(d == 2, "<think>" + call("in_thinking")).otherwise("hm")
    out = rc.normalize_result(given, answer, thinking, F.lit("<tool_call>" + call("in_raw") + "</tool_call>"), ["in_answer", "in_thinking"])
    return v.table(spark, sf_dir, "documents").select("doc_id", out.alias("r")).select("doc_id", F.get("r.tool_calls", F.lit(0))["name"].alias("name"), "r.answer")


@query("SELECT doc_id, doc_id % 2 = 0 AS same FROM documents")
def tool_call_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls whose arguments differ in order, blanks and nulls only, or in a value."""
    a = F.create_map(F.lit("q"), F.lit(" x "), F.lit("n"), F.lit(None).cast("string"), F.lit("b"), F.lit("1"))
    b = F.create_map(F.lit("b"), F.when(F.col("doc_id") % 2 == 0, "1").otherwise("2"), F.lit("q"), F.lit("x"), F.lit("z"), F.lit("  "))
    return v.table(spark, sf_dir, "documents").select("doc_id", (rc.call_key(F.lit("s"), a) == rc.call_key(F.lit("s"), b)).alias("same"))


@query(f"WITH {RESPONSES} SELECT ord, CASE WHEN ord % 2 = 0 THEN 'search' ELSE '' END AS names, 'a|b|c' AS hints FROM responses")
def turn_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named calls of assistant turns, and hints merged in order."""
    calls = F.array(F.struct(F.when(F.col("ord") % 2 == 0, "search").alias("name")))
    turns = F.array(F.struct(F.lit("assistant").alias("role"), calls.alias("tool_calls")), F.struct(F.lit("tool").alias("role"), calls.alias("tool_calls")))
    hints = rc.merge_hints(F.array(F.lit("a"), F.lit("b")), F.lit(None).cast("array<string>"), F.array(F.lit("b"), F.lit("c")))
    return v.responses(spark, sf_dir).select("ord", F.array_join(rc.calls_of_turns(turns)["name"], ",").alias("names"), F.array_join(hints, "|").alias("hints"))


@query("SELECT count(*) FILTER (doc_id % 3 = 0) AS used, count(*) FILTER (doc_id % 3 = 0 AND (doc_id % 2 = 0 OR doc_id % 5 = 0)) AS rescued FROM documents")
def fallback_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    calls = F.when(d % 5 == 0, F.array(F.struct(F.lit("s").alias("name"))))
    return v.table(spark, sf_dir, "documents").select((d % 3 == 0).alias("used"), (d % 2 == 0).alias("succeeded"), calls.alias("tool_calls")).agg(*rc.fallback_metrics())


@query(f"WITH {RESPONSES} SELECT ord, 'Ask ' || style_id || ' about ' || turn_index || '.' AS prompt, length(prompt) + length(answer) + 2 AS characters FROM responses")
def fill_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed templates filled, and the size of a request."""
    said = rc.fill(F.lit("Ask {persona} about {theme}."), persona=F.col("style_id"), theme=F.col("turn_index").cast("string"))
    message = lambda c: F.struct(F.col(c).alias("content"), F.lit(None).cast("string").alias("tool_calls"))
    return v.responses(spark, sf_dir).select("ord", said.alias("prompt"), rc.prompt_characters(F.array(message("prompt"), message("answer")), F.lit("[]")).alias("characters"))


@query("SELECT source AS domain, count(*) FILTER (doc_id % 3 = 0) AS accepted, count(*) FILTER (doc_id % 3 = 1) AS rejected_dup, count(*) FILTER (doc_id % 3 = 2) AS rejected_other FROM documents GROUP BY source")
def domain_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id") % 3
    return dimensions.domain_state(v.table(spark, sf_dir, "documents").select(F.col("source").alias("domain"), F.when(d == 0, "accepted").when(d == 1, "dup").otherwise("short").alias("outcome")))


@query("SELECT user_id, array_agg(event_type ORDER BY ts, event_id)[1] AS first_event, max(ts) AS last_ts, greatest(1, least(8, count(*)))::BIGINT AS batch FROM events GROUP BY user_id")
def live_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state a live view shows of each user, and the batch that is taken next."""
    e = v.table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("first_event"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return e.select("user_id", "first_event", "last_ts", rc.batch_size(F.lit(None).cast("int"), F.col("n")).cast("long").alias("batch"))
