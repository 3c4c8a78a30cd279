"""Live forms: counters over a growing log, assembly of streamed tool calls, guards with state, event-time windows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources import readers


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """New JSON objects (json VARIANT) of a directory that writers add whole files of lines to; torn lines are skipped."""
    return readers.objects(spark.readStream.option("lineSep", "\n").text(path))


def refresh(stream: DataFrame, dims: list[str], show: Callable[[DataFrame], None], checkpoint: str, every: str | None = "3 seconds") -> StreamingQuery:
    """Counts by dimensions, shown anew at most every so often; every=None takes what is there and ends."""
    counts = stream.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
    writer = counts.writeStream.outputMode("complete").foreachBatch(lambda df, _: show(df)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def assemble(deltas: DataFrame) -> DataFrame:
    """(request_id, tool_call_index, call_id, name, arguments) from ordered deltas; arguments that aren't an object become {}."""
    joined = deltas.groupBy("request_id", "tool_call_index").agg(
        F.max_by("call_id", F.when(F.col("call_id").isNotNull(), F.col("ord"))).alias("call_id"),
        F.max_by("name", F.when(F.col("name").isNotNull(), F.col("ord"))).alias("name"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "arguments_delta"))), lambda x: F.coalesce(x["arguments_delta"], F.lit(""))), "").alias("text"),
    )
    whole = F.try_parse_json("text")
    return joined.withColumn("arguments", F.when(F.schema_of_variant(whole).startswith("OBJECT"), F.col("text")).otherwise("{}")).drop("text")


class Assembler(StatefulProcessor):
    """assemble() as a stream: a request's parts are held until its finish_reason arrives, then given out and dropped."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.parts = handle.getMapState("parts", "tool_call_index int", "call_id string, name string, text string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        ended = False
        for pdf in rows:
            for r in pdf.sort_values("ord").itertuples():
                if r.finish_reason:
                    ended = True
                if pd.isna(r.tool_call_index):
                    continue
                i = (int(r.tool_call_index),)
                call_id, name, text = self.parts.getValue(i) if self.parts.containsKey(i) else (None, None, "")
                self.parts.updateValue(i, (r.call_id or call_id, r.name or name, text + (r.arguments_delta or "")))
        if ended:
            out = []
            for (i,), (call_id, name, text) in sorted(self.parts.iterator()):
                try:
                    good = isinstance(json.loads(text), dict)
                except ValueError:
                    good = False
                out.append((key[0], i, call_id, name, text if good else "{}"))
            self.parts.clear()
            if out:
                yield pd.DataFrame(out, columns=["request_id", "tool_call_index", "call_id", "name", "arguments"])

    def close(self) -> None:
        pass


def assemble_stream(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("request_id").transformWithStateInPandas(statefulProcessor=Assembler(), outputStructType="request_id string, tool_call_index int, call_id string, name string, arguments string", outputMode="append", timeMode="none")


def runaway_stream(deltas: DataFrame, limit: int = 5) -> DataFrame:
    """(request_id, streak) when empty think deltas have followed each other `limit` times."""

    def step(key: tuple, rows: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        (streak,) = state.get if state.exists else (0,)
        out = []
        for pdf in rows:
            for delta in pdf.sort_values("ord")["delta"]:
                streak = streak + 1 if (delta or "").strip() in ("</think>", "<think></think>") else 0
                if streak == limit:
                    out.append((key[0], streak))
        state.update((streak,))
        yield pd.DataFrame(out, columns=["request_id", "streak"])

    return deltas.groupBy("request_id").applyInPandasWithState(step, "request_id string, streak int", "streak int", "append", "NoTimeout")


def windowed(events: DataFrame, size: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """An extension: counts and sums by event-time window and type, with a watermark when streamed."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sse_blocks(text: DataFrame, column: str = "text") -> DataFrame:
    """(pos, event, data) of each event block of server-sent text; several data lines are joined; the unended rest is left."""
    blocks = text.select("*", F.posexplode(F.slice(F.split(column, "\n\n"), 1, F.size(F.split(column, "\n\n")) - 1)).alias("pos", "block"))
    event = F.regexp_extract("block", r"(?m)^event:\s?(.*)$", 1)
    data = F.array_join(F.regexp_extract_all("block", F.lit(r"(?m)^data:\s?(.*)$"), F.lit(1)), "\n")
    return blocks.select(*text.columns, "pos", F.when(event == "", "message").otherwise(event).alias("event"), data.alias("data")).filter("data <> ''")
