"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balltree, decontam, divergence, langid, license, mixing, ngram_join, quality, sharding, sitetree, tokens, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "group_id", "n_links", "n_shingles")


@query
def op1_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("score", F.round("score", 6))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # where the machine has it; the other queries don't need it

    return tokens.roundtrip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.find(docs, table(spark, sf_dir, "benchmark")))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = toxicity.train(docs.filter(~toxicity.held_out()), table(spark, sf_dir, "labels"))
    found = toxicity.score(docs.select("doc_id", "text"), index)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.judge(docs.select("doc_id", "text"), quality.learn(docs))
    return found.drop("text")


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", mixing.row_hash(docs).alias("row"), "source", mixing.size_of().alias("size"))
    found = mixing.copies(docs, ["doc_id", "row"])
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op10_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "page")


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.digest(balltree.cluster(table(spark, sf_dir, "embeddings")))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


ORACLE_SQL["op1_warc_roundtrip"] = warc.SQL
ORACLE_SQL["op3_license_scan"] = license.sql()
ORACLE_SQL["op9_source_mix"] = mixing.SQL
ORACLE_SQL["op10_extendible_shards"] = sharding.SQL
ORACLE_SQL["op11_centroid_clusters"] = balltree.sql()
ORACLE_SQL["op12_source_divergence"] = divergence.SQL
