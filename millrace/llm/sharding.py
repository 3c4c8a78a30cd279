"""Sharding by extendible hashing, with DataFrame functions only.

A row's hash is the first 60 bits of the md5 of its id and text. Directories map hash prefixes to buckets: the first has
one entry for each prefix of STRIDE bits; a bucket that holds more than `shard_bytes` of text is split on its next bit, others
aren't, so buckets differ in depth and several entries may lead to one. Only prefixes that are still too large at the end of a directory get
one of STRIDE more bits. What is counted is bytes for each prefix, summed before it is moved; the driver learns no more
than whether a directory left something too large. Directories are made from narrow rows (hash, bytes). Texts are moved once at
most, to meet the buckets of their hash; not at all where the first directory, which is broadcast, is enough.

Rows that all 60 bits can't part (repeated rows) are numbered, with their texts, and dealt to pages of a bucket, as many rows to a page as fit; a row
that alone exceeds the limit is a page of its own. So every shard, a bucket's page, fits its limit unless it is one row.

Results: shard (the prefix as a string of bits, empty for the bucket of all rows), depth, page (0 but for such rows), n_bytes,
shard_bytes (of the bucket). A null text has 0 bytes; a null id hashes as an empty one; an empty table gives no rows; input columns with these names, in any case, give way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, stored, without

BITS = 60
STRIDE = 12
ADDED = ["shard", "depth", "page", "n_bytes", "shard_bytes"]


def hash_of(id_col: str, text_col: str) -> Column:
    joined = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return F.conv(F.substring(F.md5(joined), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: str, bits: int) -> Column:
    return F.shiftright(F.col(h), BITS - bits)


def directory(cells: DataFrame, level: int, shard_bytes: int) -> DataFrame:
    """(cell, depth, bucket_bytes) of one level from (cell, bytes); depth is null where the whole cell is too large."""
    top = STRIDE * (level + 1)
    path = cells.withColumn("depth", F.explode(F.sequence(F.lit(STRIDE * level), F.lit(top))))
    path = path.withColumn("bucket", F.expr(f"shiftright(cell, {top} - depth)"))
    path = path.withColumn("held", F.sum("bytes").over(Window.partitionBy("depth", "bucket")))
    fits = F.when(F.col("held") <= shard_bytes, F.struct("depth", "held"))
    return path.groupBy("cell").agg(F.min(fits).alias("x")).select("cell", F.col("x.depth").alias("depth"), F.col("x.held").alias("bucket_bytes"))


def shard(docs: DataFrame, shard_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the columns ADDED."""
    hashed = without(docs, [*ADDED, "shard__h"]).withColumns({"shard__h": hash_of(id_col, text_col), "n_bytes": F.coalesce(F.octet_length(f"`{text_col}`"), F.lit(0)).cast("long")})
    plain = hashed.columns
    rest = stored(hashed.select("shard__h", "n_bytes"), "hashes")
    first, deep = None, []
    for level in range(BITS // STRIDE):
        top = STRIDE * (level + 1)
        cells = rest.groupBy(_prefix("shard__h", top).alias("cell")).agg(F.sum("n_bytes").alias("bytes"))
        found = stored(directory(cells, level, shard_bytes), f"directory{level}")
        entry = found.filter("depth IS NOT NULL").withColumnRenamed("cell", "shard__cell")
        if first is None:
            first = entry  # 2^STRIDE rows at most
        else:
            deep.append(rest.join(entry, _prefix("shard__h", top) == F.col("shard__cell")).select("shard__h", "depth", "bucket_bytes").distinct())
        large = found.filter("depth IS NULL").select(F.col("cell").alias("shard__cell"))
        last = large.isEmpty()
        if last:
            break
        rest = rest.join(large, _prefix("shard__h", top) == F.col("shard__cell"), "left_semi")
    met = hashed.join(F.broadcast(first), _prefix("shard__h", STRIDE) == F.col("shard__cell"), "left").withColumnRenamed("bucket_bytes", "shard_bytes")
    met = met.select(*plain, "depth", "shard_bytes").withColumn("page", F.lit(0).cast("long"))
    if last and not deep:
        return _named(met)
    out, lower = met.filter("depth IS NOT NULL"), met.filter("depth IS NULL").select(*plain)
    place = reduce(DataFrame.union, deep).withColumn("widest", F.lit(None).cast("long"))
    if not last:  # whole hashes that are too large
        full = rest.groupBy("shard__h").agg(F.lit(BITS).alias("depth"), F.sum("n_bytes").alias("bucket_bytes"), F.max("n_bytes").alias("widest"))
        place = place.unionByName(full)
    placed = lower.join(place.withColumnRenamed("shard__h", "shard__of"), F.col("shard__h") == F.col("shard__of")).withColumnRenamed("bucket_bytes", "shard_bytes")
    out = out.unionByName(placed.filter("widest IS NULL").withColumn("page", F.lit(0).cast("long")).select(out.columns))
    if last:
        return _named(out)
    # The rows of whole hashes are numbered and dealt to pages.
    over = ranked(placed.filter("widest IS NOT NULL"), ["shard__h"], ["n_bytes"], "shard__i", "pages")
    over = over.withColumn("page", F.floor(F.col("shard__i") / F.greatest(F.lit(1), F.floor(F.lit(shard_bytes) / F.col("widest")))).cast("long"))
    return _named(out.unionByName(over.select(out.columns)))


def _named(df: DataFrame) -> DataFrame:
    bits = F.left(F.lpad(F.bin("shard__h"), BITS, "0"), F.col("depth"))
    return df.withColumn("shard", bits).drop("shard__h")


#: DuckDB SQL for the rows of the query: the least depth at which a row's bucket fits, to 24 bits.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents
), p AS (
  SELECT doc_id, n_bytes, h, depth, sum(n_bytes) OVER (PARTITION BY depth, h >> (60 - depth)) AS held FROM d, range(25) AS r(depth)
), m AS (
  SELECT doc_id, n_bytes, h, min(depth) AS depth, max(held) AS held FROM p WHERE held <= 1048576 GROUP BY ALL
)
SELECT doc_id, n_bytes, left(lpad(bin(h), 60, '0'), depth::INT) AS shard, depth::INT AS depth, held::BIGINT AS shard_bytes, 0::BIGINT AS page FROM m
"""
