"""Scans of JSON Lines, compressed lines, CSV, SQLite, directories of JSON, and prompt banks."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as t

#: The fields that a generated record must have for curation.
REQUIRED = ("prompt", "answer", "mode", "sampling", "config_hash")
CALL = "struct<name:string,arguments:string,raw:string>"
RECORD = (
    "prompt string, category string, style_id string, mode string, system_prompt string, "
    "sampling struct<temperature:double,top_p:double,top_k:int,max_tokens:int,repetition_penalty:double,effective_max_tokens:int>, "
    "thinking_trace string, reasoning string, answer string, model string, config_hash string, finish_reason string, prompt_tokens int, completion_tokens int, "
    f"tools array<string>, tool_ids_requested array<string>, tool_calls array<{CALL}>, turns array<struct<role:string,name:string,content:string,tool_calls:array<{CALL}>>>, "
    "raw_completion string, suspected_unparsed_tool_calls array<string>, created_at string, session_id string, turn_index int"
)
SAMPLING_KEYS = ("temperature", "top_p", "top_k", "max_tokens", "repetition_penalty")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, ord) of the lines of text files, plain, gzip or zstd; ord follows the order of files and lines.

    A path without files gives no rows. Only \\n ends a line.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
        return spark.createDataFrame([], "value string, ord long")
    return spark.read.option("lineSep", "\n").text(path).withColumn("ord", F.monotonically_increasing_id())


def objects(raw: DataFrame, value: str = "value", schema: str = RECORD) -> DataFrame:
    """raw's lines that hold a JSON object, with json, a VARIANT. What the strict parser refuses for repeated keys is read by schema, the last one winning."""
    v = F.try_parse_json(F.col(value))
    loose = F.from_json(F.col(value), f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    again = F.when(v.isNull() & F.col(value).rlike(r"^\s*\{") & loose["_corrupt"].isNull(), F.try_parse_json(F.to_json(loose)))
    out = raw.withColumn("json", F.coalesce(v, again))
    return out.filter(F.schema_of_variant("json").startswith("OBJECT"))


def field(name: str, kind: str = "string") -> Column:
    return F.try_variant_get("json", f"$.{name}", kind)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Generated records with schema_ok and ord."""
    found = objects(lines(spark, path))
    typed = found.select("ord", F.from_json(F.to_json("json"), RECORD).alias("r")).select("ord", "r.*")
    return typed.withColumn("schema_ok", schema_ok())


def schema_ok(columns: tuple[str, ...] = REQUIRED) -> Column:
    """No required field is null; empty ones pass."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    return ok


def prompt_rows(spark: SparkSession, path: str) -> DataFrame:
    """Records whose prompt is a string, empty or not."""
    return records(spark, path).filter(F.col("prompt").isNotNull())


def prompt_bank(spark: SparkSession, path: str) -> DataFrame:
    """Valid prompt rows: prompt stripped and not empty; of the sampling only known keys; lists where lists belong."""
    found = objects(lines(spark, path))
    sampling = F.map_filter(F.coalesce(field("sampling", "map<string,double>"), F.create_map().cast("map<string,double>")), lambda k, v: k.isin(*SAMPLING_KEYS))
    rows = found.select("ord", t.strip(field("prompt")).alias("prompt"), *[field(c).alias(c) for c in ("id", "domain", "category", "style_id", "system_prompt")], sampling.alias("sampling"), field("tool_ids", "array<string>").alias("tool_ids"))
    return rows.filter(F.coalesce(F.col("prompt") != "", F.lit(False)))


def csv_bank(spark: SparkSession, path: str) -> DataFrame:
    """(prompt, category) of a CSV file with the headers 分野 and プロンプト, with or without a byte order mark."""
    raw = spark.read.option("header", True).option("multiLine", True).option("encoding", "UTF-8").csv(path)
    named = raw.toDF(*[c.lstrip("﻿").strip('"') for c in raw.columns])
    return named.select(t.strip(t.text(F.col("プロンプト"))).alias("prompt"), t.full(t.strip(t.text(F.col("分野")))).alias("category")).filter("prompt <> ''")


def lint(raw: DataFrame) -> DataFrame:
    """(ord, problem) of lines that aren't JSON, aren't objects, or whose answer holds think tags; blank lines pass."""
    v = F.try_parse_json("value")
    answer = F.try_variant_get(v, "$.answer", "string")
    problem = (
        F.when(t.strip(F.col("value")) == "", F.lit(None))
        .when(v.isNull(), "invalid JSON")
        .when(~F.schema_of_variant(v).startswith("OBJECT"), "not an object")
        .when(t.like(t.text(answer), "</?think>"), "think tag in answer")
    )
    return raw.select("ord", problem.alias("problem")).filter("problem IS NOT NULL")


def has_content(raw: DataFrame) -> bool:
    return not raw.filter(t.strip(F.col("value")) != "").isEmpty()


def json_directory(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One record for each JSON file; broken ones are skipped; newest first."""
    found = spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return found.filter("_corrupt IS NULL").drop("_corrupt").orderBy(F.desc("created_at"))


def tail(spark: SparkSession, path: str, offset: int) -> tuple[str, int]:
    """(text from a character offset on, its end) of one file; a negative offset counts as 0."""
    row = spark.read.text(path, wholetext=True).select(F.substring("value", max(0, offset) + 1, 1 << 30), F.length("value")).first()
    return (row[0], row[1]) if row else ("", max(0, offset))


def prompt_file(spark: SparkSession, path: str) -> DataFrame:
    """(version, eval_version, body): the headers of a prompt file, and it without its # lines."""
    raw = spark.read.text(path, wholetext=True)
    head = lambda k: t.full(F.regexp_extract("value", rf"(?m)^#\s*{k}:\s*(\S+)", 1))
    return raw.select(head("version").alias("version"), head("eval_version").alias("eval_version"), t.strip(F.regexp_replace("value", r"(?m)^#.*\n?", "")).alias("body"))


def newest_artifact(spark: SparkSession, parent: str, marker: str) -> str | None:
    """The run directory under parent whose marker file is newest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", marker).load(parent)
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    return row.p.rsplit("/", 1)[0] if row and row.p else None


def fingerprint(spark: SparkSession, path: str) -> tuple[int, int]:
    """(newest modification time in ms, lines that aren't blank), by which an index tells whether it is stale."""
    when = spark.read.format("binaryFile").load(path).agg(F.max(F.unix_millis("modificationTime"))).first()[0]
    return when or 0, lines(spark, path).filter(t.strip(F.col("value")) != "").count()


def sqlite_table(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """A table of a SQLite file that the one worker that reads it can open; session stores are small."""
    if not re.fullmatch(r"\w+", table):
        raise ValueError(f"not a table name: {table}")

    def run(batches: Iterator) -> Iterator:
        import sqlite3

        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        for _ in batches:
            with sqlite3.connect(path) as db:
                rows = db.execute(f"SELECT {', '.join(schema.fieldNames())} FROM {table}")
                while got := rows.fetchmany(5000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(map(list, zip(*got, strict=True)), to_arrow_schema(schema), strict=True)], schema=to_arrow_schema(schema))

    return spark.range(1, numPartitions=1).mapInArrow(run, schema)


def keyset_page(rows: DataFrame, by: str, name: str, after: tuple | None, n: int) -> DataFrame:
    """The next n rows by (by, name), both descending, after a cursor, with has_more."""
    if after is not None:
        rows = rows.filter((F.col(by) < F.lit(after[0])) | ((F.col(by) == F.lit(after[0])) & (F.col(name) < F.lit(after[1]))))
    page = rows.orderBy(F.desc(by), F.desc(name)).limit(n + 1)
    more = page.count() > n
    return page.orderBy(F.desc(by), F.desc(name)).limit(n).withColumn("has_more", F.lit(more))


def pick_newest(copies: DataFrame, by: list[str]) -> DataFrame:
    """The one document that is greatest by the columns named."""
    return copies.agg(F.max_by(F.struct("*"), F.struct(*by)).alias("x")).filter("x IS NOT NULL").select("x.*")
