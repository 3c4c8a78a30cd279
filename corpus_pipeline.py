"""A corpus from raw documents to shards: five stages, each over all that its predecessor kept.

Each stage is written as Parquet and read back before the next. All but the last return the columns of documents. An empty
table passes through every stage; rows with null ids, texts, languages or sources are treated as the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, langid, mixing, ngram_join, sharding
from millrace.llm.common import stored

#: Texts of two halves, random letters and other scripts score far below it; capitals with accents, keys and foreign passages in a clean text above.
LEAST_SCORE = 0.01


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or that fit no learned language, go."""
    model = langid.train(docs.filter(~langid.held_out()))
    found = langid.predict(docs.withColumnsRenamed({c: f"doc__{c}" for c in docs.columns if c != "text"}), model)
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col("text") if c == "text" else F.col(f"`doc__{c}`").alias(c) for c in docs.columns])


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the least id and text hash stays, once; null ids come last. Texts without words all stay."""
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    named = docs.withColumnsRenamed({c: f"doc__{c}" for c in docs.columns if c != "text"})
    found = decontam.find(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    clean = found.filter(F.size("hit_from") == 0)
    return clean.select(*[F.col("text") if c == "text" else F.col(f"`doc__{c}`").alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice stands twice."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shards."""
    return sharding.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("ngram_jaccard_join", deduplicate),
    ("benchmark_decontamination", decontaminate),
    ("source_mix", mix),
    ("extendible_shards", shard),
]

#: SQL can't express the first stage's code lengths; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
