"""State kept over a stream: first rows of each key, changes of a value, many streams as one with heartbeats, tables of open alerts.

Stateful operators need a state store that transformWithState supports (RocksDB); `stateful` sets it. Rows of a key that come in one
batch are thinned in the tasks that read them before they meet, so that a key with most of the rows moves a few of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources import versions

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def _columns(rows: DataFrame, *more: str) -> T.StructType:
    return T.StructType([*rows.schema.fields, *T.StructType.fromDDL(", ".join(more)).fields])


# The first rows of each key ------------------------------------------------------------------------------------------


class FirstRows(StatefulProcessor):
    """Lets the first `most` rows of a key pass, over all batches; a key that isn't seen for `forget_ms` starts anew."""

    def __init__(self, columns: list[str], order: str, most: int, forget_ms: int | None):
        self.columns, self.order, self.most, self.forget_ms = columns, order, most, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n int", self.forget_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        (n,) = self.seen.get() if self.seen.exists() else (0,)
        best = None
        for pdf in rows:  # a batch may hold many rows of a key: no more than can pass are kept
            whole = pdf[self.columns] if best is None else pd.concat([best, pdf[self.columns]])
            best = whole.nsmallest(max(0, self.most - n), self.order)
        if best is not None and len(best):
            self.seen.update((n + len(best),))
            yield best.assign(nth=range(n + 1, n + 1 + len(best))).astype({"nth": "int32"})

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, keys: dict[str, Column], most: int = 5, order: str = "ord", forget_ms: int | None = None) -> DataFrame:
    """The rows of a stream that are among the first `most` of their keys, with nth. Batches come in order; within one, order decides."""
    keyed = stream.withColumns({f"key_{k}": F.coalesce(c, F.lit("")) for k, c in keys.items()})
    names = [f"key_{k}" for k in keys]

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.sort_values(order).groupby(names, sort=False).head(most)

    processor = FirstRows(stream.columns, order, most, forget_ms)
    return keyed.mapInPandas(thin, keyed.schema).groupBy(*names).transformWithStateInPandas(statefulProcessor=processor, outputStructType=_columns(stream, "nth int"), outputMode="append", timeMode="processingTime" if forget_ms else "none")


# Changes -------------------------------------------------------------------------------------------------------------


def _changed(columns: list[str], order: str, value: str) -> Callable[[Any, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """What a key's rows of a batch and the value of its last row before them let pass; the state comes and goes with the rows, many keys at once."""

    def run(key: Any, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        whole = parts[0] if len(parts) == 1 else pd.concat(parts)
        place = np.argsort(whole[order].to_numpy(), kind="stable")
        values = whole[value].to_numpy(dtype=object)[place]
        values[pd.isna(values)] = None  # nulls are alike
        differs = np.ones(len(values), dtype=bool)
        differs[1:] = values[1:] != values[:-1]
        if state.exists:
            differs[0] = values[0] != state.get[0]
        state.update((values[-1],))
        if differs.any():
            yield whole[columns].iloc[place[differs]]

    return run


def changes(stream: DataFrame, keys: list[str], value: Column, order: str = "ord") -> DataFrame:
    """The rows of a stream whose value isn't that of the row before of the same keys, and the first row of each; nulls are alike. The value is kept as a digest."""
    tagged = stream.withColumn("state_value", F.sha1(value.cast("string")))
    return tagged.groupBy(*keys).applyInPandasWithState(_changed(stream.columns, order, "state_value"), stream.schema, "value string", "append", "NoTimeout")


# Many streams as one -------------------------------------------------------------------------------------------------

EVENT = "session string, source string, ord long, kind string, data string"


class FanIn(StatefulProcessor):
    """A session's events as they come; `done` once each of its sources has ended; `ping` whenever nothing came for `silent_ms`."""

    def __init__(self, sources: int, silent_ms: int | None):
        self.sources, self.silent_ms = sources, silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ended = handle.getMapState("ended", "source string", "ended boolean")
        self.due = handle.getValueState("due", "at long")
        self.last = handle.getValueState("last", "ord long")

    def _wait(self, now: int) -> None:
        if self.silent_ms is not None:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            self.due.update((now + self.silent_ms,))
            self.handle.registerTimer(now + self.silent_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = self.last.get()[0] if self.last.exists() else -1
        over = sum(1 for _ in self.ended.keys()) == self.sources
        for pdf in rows:
            last = max(last, int(pdf["ord"].max()))
            for source in pdf.loc[pdf["kind"].isin(("column_done", "error")), "source"].unique():
                self.ended.updateValue((source,), (True,))
            yield pdf[["session", "source", "ord", "kind", "data"]]
        self.last.update((last,))
        if not over and sum(1 for _ in self.ended.keys()) == self.sources:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
                self.due.clear()
            yield pd.DataFrame({"session": [key[0]], "source": [None], "ord": [last + 1], "kind": ["done"], "data": [None]})
        elif not over and self.silent_ms is not None:
            self._wait(timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.due.clear()
        self._wait(timerValues.getCurrentProcessingTimeInMs())
        yield pd.DataFrame({"session": [key[0]], "source": [None], "ord": [-1], "kind": ["ping"], "data": [None]})

    def close(self) -> None:
        pass


def fan_in(streams: dict[str, DataFrame], silent_ms: int | None = 5000) -> DataFrame:
    """EVENT rows of several streams (session, ord, kind, data) as one, tagged with their source, with `done` and `ping` rows. A source ends a session with `column_done` or `error`."""
    whole = None
    for name, s in streams.items():
        own = s.select("session", F.lit(name).alias("source"), "ord", "kind", "data")
        whole = own if whole is None else whole.unionByName(own)
    return whole.groupBy("session").transformWithStateInPandas(statefulProcessor=FanIn(len(streams), silent_ms), outputStructType=EVENT, outputMode="append", timeMode="none" if silent_ms is None else "processingTime")


def fanned_in(sources: dict[str, DataFrame]) -> DataFrame:
    """What fan_in gives in the end, as a batch, without pings."""
    whole = None
    for name, s in sources.items():
        own = s.select("session", F.lit(name).alias("source"), "ord", "kind", "data")
        whole = own if whole is None else whole.unionByName(own)
    over = F.collect_set(F.when(F.col("kind").isin("column_done", "error"), F.col("source")))
    done = whole.groupBy("session").agg(F.size(over).alias("n"), (F.max("ord") + 1).alias("ord")).filter(F.col("n") == len(sources))
    return whole.unionByName(done.select("session", F.lit(None).cast("string").alias("source"), "ord", F.lit("done").alias("kind"), F.lit(None).cast("string").alias("data")))


# Tables kept up to date ----------------------------------------------------------------------------------------------

REPORT = "run_key string, ord long, attempts long, cleared boolean, prompt string"


def keep_alerts(stream: DataFrame, path: str, checkpoint: str, least: int = 3, **trigger: Any) -> StreamingQuery:
    """A stream of REPORT rows as a versioned dataset of each key's last report that counts, under path.

    Batches are applied once: a commit carries the number of its batch, and a batch that comes again after a failure is one that is there. A cleared key stays as a cleared row, so that a
    report that is late doesn't open it again.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if int(versions.tag_of(spark, path) or -1) >= number:
            return
        counted = batch.filter(F.col("cleared") | (F.col("attempts") >= least)).select(*T.StructType.fromDDL(REPORT).names)
        known = versions.read(spark, path, REPORT)
        rest = [c for c in known.columns if c != "run_key"]
        both = known.unionByName(counted).groupBy("run_key").agg(F.max_by(F.struct(*rest), "ord").alias("x")).select("run_key", "x.*")
        versions.rewrite(both, path, str(number))

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def open_alerts(spark: SparkSession, path: str) -> DataFrame:
    """(run_key, prompt_preview, attempts) of the keys that are open."""
    text = F.when(F.length("prompt") > 80, F.concat(F.left("prompt", F.lit(80)), F.lit("…"))).otherwise(F.col("prompt"))
    return versions.read(spark, path, REPORT).filter(~F.col("cleared")).select("run_key", text.alias("prompt_preview"), "attempts")


def end_run(spark: SparkSession, path: str) -> None:
    """All alerts are cleared when a run ends; the number of the last batch stays."""
    versions.rewrite(spark.createDataFrame([], REPORT), path)


def replay(parts: list[DataFrame], log: str, out: str, checkpoint: str, make: Any) -> None:
    """Run make(stream) over a log of Parquet files to which one part after another is added, from its checkpoint each time, and add its rows to out."""
    for part in parts:
        part.write.mode("append").parquet(log)
        stream = part.sparkSession.readStream.schema(part.schema).parquet(log)
        query = make(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
