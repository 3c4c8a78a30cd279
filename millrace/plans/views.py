"""The driver's tables in the shapes that the operators take, and the same as SQL (common table expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import signals as sg
from ..operators import score as sc

#: Thresholds under which the synthetic documents keep about half of their rows.
LATIN = sg.Limits(script=r"a-zA-Z\x{00c0}-\x{00ff}", repeat_ng=0.6)
CODES = ("LEN-A", "TRUNC", "LANG-JA", "REPEAT-NG", "END-WELL")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """A table read by fewer tasks than there are cores, dealt out to all of them; a larger one is read as it lies."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows  # asks the plan for its splits; nothing runs


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return spread(table(spark, sf_dir, "documents")).select(
        d.alias("ord"),
        F.col("text").alias("answer"),
        F.substring_index("text", "\n", 1).alias("thinking_trace"),
        F.col("lang").alias("style_id"),
        F.col("source").alias("category"),
        F.when(d % 3 == 0, "nothinking").otherwise("thinking").alias("mode"),
        F.element_at(F.array(*[F.lit(x) for x in (0.5, 0.6, 0.7)]), (d % 3 + 1).cast("int")).alias("temperature"),
        F.element_at(F.array(*[F.lit(x) for x in (0.8, 0.85, 0.9, 0.95)]), (d % 4 + 1).cast("int")).alias("top_p"),
        F.when(d % 5 == 0, "length").when(d % 5 == 1, "stop").when(d % 5 == 3, "tool_loop_exhausted").when(d % 5 == 4, "error").alias("finish_reason"),
        F.concat(F.lit("h"), d).alias("record_hash"),
    )


DOCS = """docs AS (
  SELECT doc_id AS ord, text AS answer, split_part(text, chr(10), 1) AS thinking_trace, lang AS style_id, source AS category,
         CASE WHEN doc_id % 3 = 0 THEN 'nothinking' ELSE 'thinking' END AS mode,
         [0.5::DOUBLE, 0.6::DOUBLE, 0.7::DOUBLE][(doc_id % 3 + 1)::INT] AS temperature,
         [0.8::DOUBLE, 0.85::DOUBLE, 0.9::DOUBLE, 0.95::DOUBLE][(doc_id % 4 + 1)::INT] AS top_p,
         CASE doc_id % 5 WHEN 0 THEN 'length' WHEN 1 THEN 'stop' WHEN 3 THEN 'tool_loop_exhausted' WHEN 4 THEN 'error' END AS finish_reason,
         'h' || doc_id AS record_hash
  FROM documents)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """docs with their composite over CODES."""
    return sc.composite(sg.evaluate(docs(spark, sf_dir), CODES, LATIN))


# Pieces of SQL; {c} is a column.
STRIP = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
TERMINAL = r"[。！？.!?」』）)\]]\s*$"


def strip(c: str) -> str:
    return STRIP.format(c=c)


def truncated(c: str) -> str:
    """Whether an answer looks cut."""
    a = strip(f"coalesce({c}, '')")
    last = strip(f"list_last(string_split({a}, chr(10)))")
    return rf"""(CASE WHEN {a} = '' THEN true WHEN regexp_matches({a}, '{TERMINAL}') THEN false
      WHEN regexp_matches({last}, '^#{{1,6}}\s+\S') THEN true WHEN contains({last}, '|') AND NOT ends_with({last}, '|') THEN true
      WHEN regexp_matches({last}, '[、，,：:]\s*$') THEN true WHEN regexp_matches({last}, '[\x{{4e00}}-\x{{9fff}}]$') AND length({a}) > 200 THEN true ELSE false END)"""


def count_of(c: str, sub: str) -> str:
    return f"((length({c}) - length(replace({c}, '{sub}', ''))) // {len(sub)})"


GRAMS = "list_transform(range(greatest(length(answer) - 3, 0)), lambda i: ch[i + 1] || ch[i + 2] || ch[i + 3] || ch[i + 4])"
SHARE = """share AS (
  SELECT ord, sum(CASE WHEN n > 1 THEN n ELSE 0 END) / sum(n) AS share FROM (
    SELECT ord, g, count(*) AS n FROM (SELECT ord, unnest(GRAMS) AS g FROM (SELECT ord, answer, string_split(answer, '') AS ch FROM docs)) GROUP BY ord, g) GROUP BY ord)""".replace("GRAMS", GRAMS)
WHOLE = "(CASE WHEN thinking_trace <> '' AND answer <> '' THEN thinking_trace || chr(10) || answer WHEN thinking_trace <> '' THEN thinking_trace ELSE answer END)"
ENDS = rf"""({strip(WHOLE)} <> '' AND {count_of(WHOLE, "```")} % 2 = 0 AND (ends_with({strip(WHOLE)}, '```') OR regexp_matches({strip(WHOLE)}, '{TERMINAL}')))"""
CUT = f"(CASE WHEN finish_reason = 'length' THEN true WHEN finish_reason = 'stop' THEN false ELSE {truncated('answer')} AND coalesce(finish_reason, '') <> 'tool_loop_exhausted' END)"
SCORED = rf"""{DOCS}, {SHARE}, sig AS (
  SELECT docs.*, length(answer)::BIGINT AS n, {CUT} AS cut, {ENDS} AS ends,
         length(regexp_replace(answer, '[\s\p{{P}}]', '', 'g')) AS bare, length(regexp_replace(regexp_replace(answer, '[\s\p{{P}}]', '', 'g'), '[^a-zA-Z\x{{00c0}}-\x{{00ff}}]', '', 'g')) AS script,
         coalesce(share, 0)::DOUBLE AS share
  FROM docs LEFT JOIN share USING (ord)
), five AS (
  SELECT *, greatest(0::DOUBLE, 1 - abs(n::DOUBLE - 2015) / 1985) AS s1, CASE WHEN cut THEN 0::DOUBLE ELSE 1 END AS s2,
         CASE WHEN bare > 0 THEN script::DOUBLE / bare ELSE 0 END AS s3, CASE WHEN n >= 8 THEN 1 - share ELSE 1 END AS s4, CASE WHEN ends THEN 1::DOUBLE ELSE 0 END AS s5
  FROM sig
), scored AS (
  SELECT *, (s1 + s2 + s3 + s4 + s5) / 5 AS final_score,
         list_filter([CASE WHEN n < 30 OR n > 4000 THEN 'LEN-A' END, CASE WHEN cut THEN 'TRUNC' END, CASE WHEN bare = 0 OR s3 < 0.6 THEN 'LANG-JA' END,
                      CASE WHEN n >= 8 AND share > 0.6 THEN 'REPEAT-NG' END, CASE WHEN NOT ends THEN 'END-WELL' END], lambda x: x IS NOT NULL) AS hard
  FROM five)"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows."""

    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").withColumn("next_role", F.lead("role").over(w)).withColumn("answer", F.lead("text").over(w))
    pairs = c.filter((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    style = F.element_at(F.array(*map(F.lit, ("prose", "qa_short", "dialog", "report"))), (F.col("conv_id") % 4 + 1).cast("int"))
    return pairs.select((F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), F.col("conv_id").alias("session_id"), F.col("turn").alias("turn_index"), F.col("text").alias("prompt"), "answer", style.alias("style_id"))


RESPONSES = """responses AS (
  SELECT conv_id * 1000 + turn AS ord, conv_id AS session_id, turn AS turn_index, text AS prompt, answer, ['prose', 'qa_short', 'dialog', 'report'][(conv_id % 4 + 1)::INT] AS style_id
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""


def r6(c: Column | str) -> Column:
    return F.round(c, 6)
