"""Writers: JSON Lines, split outputs, export bundles, reports, chat messages."""

from __future__ import annotations

import hashlib
import io
import json
import tarfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as t


def clean_strings(rows: DataFrame) -> DataFrame:
    """rows with every string, in arrays and structs too, free of control characters; keys aren't touched."""

    def fix(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return t.sanitize(c)
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: fix(x, kind.elementType))
        if isinstance(kind, T.MapType):
            return F.transform_values(c, lambda k, v: fix(v, kind.valueType))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[fix(c[f.name], f.dataType).alias(f.name) for f in kind]))
        return c

    return rows.select(*[fix(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rows.schema])


def append_jsonl(rows: DataFrame, path: str, compression: str | None = None) -> None:
    """One JSON line a row; a task's lines appear when it commits."""
    clean_strings(rows).select(F.to_json(F.struct("*")).alias("value")).write.mode("append").option("lineSep", "\n").option("compression", compression or "none").text(path)


def split_curated(scores: DataFrame) -> dict[str, DataFrame]:
    """scores, high_quality and rejected (with rejected_by and final_score)."""
    return {"scores": scores, "high_quality": scores.filter("accepted").drop("rejected_by", "final_score"), "rejected": scores.filter("NOT accepted")}


def split_screened(scores: DataFrame) -> dict[str, DataFrame]:
    by = lambda x: scores.filter(F.col("screening_label") == x)
    return {"scores": scores, "ok": by("OK"), "high_quality": by("OK"), "review": by("REVIEW"), "ng": by("NG"), "rejected": by("NG")}


def write_split(parts: dict[str, DataFrame], path: str) -> None:
    for name, rows in parts.items():
        append_jsonl(rows, f"{path}/{name}.jsonl")


def write_document(spark: SparkSession, path: str, document: dict) -> None:
    """A small JSON document, replaced as a whole: written beside its place and moved there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place, temp = hadoop.Path(path), hadoop.Path(path + ".tmp")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    with_meta = document | {"_meta": {"schema": 1}}
    out = fs.create(temp, True)
    out.write(bytearray(json.dumps(with_meta, ensure_ascii=False, sort_keys=True).encode()))
    out.close()
    fs.delete(place, False)
    fs.rename(temp, place)


def bundle(rows: DataFrame, level: int = 19) -> bytes:
    """A tar of the rows as zstd JSON Lines, a summary and checksums; rows come to the driver one partition at a time."""
    import zstandard

    packed, n = io.BytesIO(), 0
    with zstandard.ZstdCompressor(level=level).stream_writer(packed, closefd=False) as z:
        for (line,) in clean_strings(rows).select(F.to_json(F.struct("*"))).toLocalIterator():
            z.write(line.encode() + b"\n")
            n += 1
    parts = {"records.jsonl.zst": packed.getvalue()}
    parts["meta.json"] = json.dumps({"count": n, "level": level}, sort_keys=True).encode()
    parts["SHA256SUMS"] = "".join(f"{hashlib.sha256(b).hexdigest()}  {k}\n" for k, b in sorted(parts.items())).encode()
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, body in parts.items():
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    return out.getvalue()


def screening_report(labels: DataFrame, rules: DataFrame) -> DataFrame:
    """(section, key, n, rate): what the CSV report holds."""
    return labels.select(F.lit("label").alias("section"), F.col("label").alias("key"), "n", "rate").unionByName(rules.select(F.lit("rule").alias("section"), F.col("rule").alias("key"), "n", "rate"))


def record_markdown() -> Column:
    """A record as Markdown; sections without text are left out."""
    part = lambda title, c: F.when(t.text(F.col(c)) != "", F.concat(F.lit(f"## {title}\n\n"), F.col(c)))
    return F.concat_ws("\n\n", part("Prompt", "prompt"), part("System", "system_prompt"), part("Thinking", "thinking_trace"), part("Answer", "answer"))


def chat_messages() -> Column:
    """A record as messages: the system prompt if there is one, the prompt, the answer."""
    say = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    both = F.array(say("user", "prompt"), say("assistant", "answer"))
    return F.when(t.text(F.col("system_prompt")) != "", F.concat(F.array(say("system", "system_prompt")), both)).otherwise(both)


def replay_problems() -> Column:
    """What keeps a record from being replayed as a chat."""
    return F.filter(F.array(F.when(t.text(F.col("prompt")) == "", F.lit("no prompt")), F.when(t.text(F.col("answer")) == "", F.lit("no answer"))), lambda x: x.isNotNull())
