"""Queries: streams run to their end, and their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch
from ..streaming import guards, live
from . import views as v
from .catalogue import query


def _deltas(e: DataFrame) -> DataFrame:
    """Each event as three deltas of a tool call of its user's request, and a last one that ends it."""
    none = F.lit(None).cast("string")
    parts = F.array(*[F.struct(d.alias("d"), n.alias("n")) for d, n in ((F.lit('{"v": '), F.col("event_type")), (F.rint("value").cast("int").cast("string"), none), (F.when(F.col("event_id") % 20 == 0, "}").otherwise("!"), none))])
    d = e.select(F.format_string("r%d", "event_id").alias("request_id"), "event_id", F.posexplode(parts).alias("pos", "x"))
    return d.select("request_id", (F.col("event_id") * 10 + F.col("pos")).alias("ord"), F.lit(0).alias("tool_call_index"), F.when(F.col("pos") == 0, F.col("request_id")).alias("call_id"), F.col("x.n").alias("name"), F.col("x.d").alias("arguments_delta"), F.when(F.col("pos") == 2, "tool_calls").alias("finish_reason"))


@query(
    """SELECT 'r' || event_id AS request_id, 0 AS tool_call_index, 'r' || event_id AS call_id, event_type AS name,
CASE WHEN event_id % 20 = 0 THEN '{"v": ' || round_even(value, 0)::INT || '}' ELSE '{}' END AS arguments FROM events"""
)
def assemble_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tool calls of all events."""
    return live.assemble(_deltas(v.table(spark, sf_dir, "events")))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of JSON lines, counted by a stream that takes what is there and ends."""
    log, out = scratch(spark, "log"), scratch(spark, "shown")
    v.table(spark, sf_dir, "events").select(F.to_json(F.struct("event_type", "value")).alias("value")).write.text(log)
    rows = live.log_stream(spark, log).select(F.try_variant_get("json", "$.event_type", "string").alias("event_type"))
    live.refresh(rows, ["event_type"], lambda df: df.write.mode("overwrite").parquet(out), scratch(spark, "state"), every=None).awaitTermination()
    return spark.read.parquet(out)


@query(
    """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL"""
)
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extension: hourly windows in event time."""
    return live.windowed(v.table(spark, sf_dir, "events")).withColumn("total", v.r6("total"))


@query("SELECT event_id, unnest([0, 1])::INT AS pos, unnest(['delta', 'message']) AS event, unnest([event_type, '[DONE]']) AS data FROM events")
def sse_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The server-sent text of all events."""
    return _sse(v.table(spark, sf_dir, "events"))


def _sse(e: DataFrame) -> DataFrame:
    text = F.concat(F.lit("event: delta\ndata: "), "event_type", F.lit("\n\ndata: [DONE]\n\ndata: unend"))
    return live.sse_blocks(e.select("event_id", text.alias("text"))).select("event_id", "pos", "event", "data")


TURNS = """c AS (SELECT turn * 4294967296 + conv_id AS ord, conv_id, turn, role, coalesce(text, '') AS text FROM conversations)"""


def _turns(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The turns of all conversations in the order in which they come: first turns, later ones, the rest."""
    c = v.table(spark, sf_dir, "conversations").select((F.col("turn") * 4294967296 + F.col("conv_id")).alias("ord"), "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    return [c.filter("turn < 2"), c.filter("turn >= 2 AND turn < 4"), c.filter("turn >= 4")]


def _streamed(spark: SparkSession, parts: list[DataFrame], make) -> DataFrame:
    guards.stateful(spark)
    out = scratch(spark, "passed")
    guards.replay(parts, scratch(spark, "log"), out, scratch(spark, "state"), make)
    return spark.read.parquet(out)


@query(f"WITH {TURNS} SELECT ord, row_number() OVER (PARTITION BY lower(split_part(text, ' ', 1)), role ORDER BY ord)::INT AS nth FROM c QUALIFY nth <= 5")
def guard_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the turns that begin alike in a role the first five, as a stream that is stopped and taken up again."""
    keys = {"prompt": F.lower(F.substring_index("text", " ", 1)), "style": F.col("role")}
    return _streamed(spark, _turns(spark, sf_dir), lambda s: guards.first_rows(s, keys)).select("ord", "nth")


@query(f"WITH {TURNS} SELECT ord, conv_id FROM c QUALIFY coalesce(length(text) % 2 <> lag(length(text) % 2) OVER (PARTITION BY conv_id ORDER BY ord), true)")
def changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns at which the parity of the length of a conversation's texts changes."""
    return _streamed(spark, _turns(spark, sf_dir), lambda s: guards.changes(s.select("ord", "conv_id", (F.length("text") % 2).alias("parity")), ["conv_id"], F.col("parity"))).select("ord", "conv_id")


@query(
    f"""WITH {TURNS}, e AS (SELECT conv_id::VARCHAR AS session, role AS source, ord, CASE WHEN ord = max(ord) OVER (PARTITION BY conv_id, role) THEN 'column_done' ELSE 'token' END AS kind FROM c WHERE role IN ('user', 'assistant'))
    SELECT * FROM e UNION ALL SELECT session, NULL, max(ord) + 1, 'done' FROM e GROUP BY session HAVING count(DISTINCT source) = 2"""
)
def fan_in_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users and assistants say as two streams in one; a session is done when both have ended."""
    guards.stateful(spark)
    c = v.table(spark, sf_dir, "conversations").filter("role IN ('user', 'assistant')")
    last = c.groupBy("conv_id", "role").agg(F.max("turn").alias("last"))
    e = c.join(last, ["conv_id", "role"]).select(F.col("conv_id").cast("string").alias("session"), "role", "turn", (F.col("turn") * 4294967296 + F.col("conv_id")).alias("ord"), F.when(F.col("turn") == F.col("last"), "column_done").otherwise("token").alias("kind"), F.col("text").alias("data"))
    out, state, logs = scratch(spark, "merged"), scratch(spark, "state"), {r: scratch(spark, r) for r in ("user", "assistant")}
    for when in ("turn < 3", "turn >= 3"):
        for role, log in logs.items():
            e.filter(when).filter(F.col("role") == role).write.mode("append").parquet(log)
        streams = {role: spark.readStream.schema(e.schema).parquet(log) for role, log in logs.items()}
        merged = guards.fan_in(streams, None)
        merged.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("session", "source", "ord", "kind")


@query(
    f"""WITH {TURNS}, r AS (SELECT *, length(text) % 7 AS attempts, length(text) % 5 = 0 AS cleared FROM c), l AS (SELECT conv_id, max(ord) AS ord FROM r WHERE cleared OR attempts >= 3 GROUP BY conv_id)
    SELECT conv_id::VARCHAR AS run_key, CASE WHEN length(text) > 80 THEN text[1:80] || '…' ELSE text END AS prompt_preview, attempts::BIGINT AS attempts FROM r JOIN l USING (conv_id, ord) WHERE NOT cleared"""
)
def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts that are open after all turns, kept up to date batch by batch."""
    path, log, state = scratch(spark, "alerts"), scratch(spark, "log"), scratch(spark, "state")
    n = F.length("text")
    for part in _turns(spark, sf_dir):
        part.select(F.col("conv_id").cast("string").alias("run_key"), "ord", (n % 7).cast("long").alias("attempts"), (n % 5 == 0).alias("cleared"), F.col("text").alias("prompt")).write.mode("append").parquet(log)
        guards.keep_alerts(spark.readStream.schema(guards.REPORT).parquet(log), path, state).awaitTermination()
    return guards.open_alerts(spark, path)
