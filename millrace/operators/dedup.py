"""Removal of exact, near and semantic duplicates, in input order."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as t
from ..sources.scratch import stored
from ..sources import versions


def mark_repeats(rows: DataFrame, key: Column, order: str = "ord") -> DataFrame:
    """rows with is_dup: an earlier row has the same key. The first of each key is found by aggregation."""
    keyed = rows.withColumn("dup_key", key)
    first = keyed.groupBy("dup_key").agg(F.min(order).alias("first_ord"))
    return keyed.join(first, "dup_key", "left").withColumn("is_dup", F.coalesce(F.col(order) > F.col("first_ord"), F.lit(False))).drop("dup_key")


def cap_per_key(rows: DataFrame, keys: list[Column], most: int = 5, order: str = "ord") -> DataFrame:
    """The first `most` rows of each key; rows beyond are dropped before they are shuffled (a window group limit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("nth", rank).filter(F.col("nth") <= most)


def shingles(c: Column, n: int = 5) -> Column:
    """Distinct character n-grams after white space is collapsed; a shorter text is its own shingle."""
    x = t.collapse(t.text(c))
    # A dot takes a whole character, also one beyond the BMP; an empty match would advance by half of it.
    chars = F.regexp_extract_all(x, F.lit("(?s)(.)"), F.lit(1))
    grams = chars
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(chars, F.lit(k + 1), F.size(chars)), lambda a, b: F.concat(a, b))
    return F.when(F.length(x) < n, F.array(x)).otherwise(F.array_distinct(F.filter(grams, lambda g: g.isNotNull())))


def dup_signal(marked: DataFrame, text: Column, first: str = "first_ord") -> DataFrame:
    """marked (mark_repeats) with the signal DUP-GLOB: an empty text rejects, and one that an earlier row has."""
    blank = t.strip(t.text(text)) == ""
    score = F.when(blank | F.col("is_dup"), 0.0).otherwise(1.0)
    raw = F.when(blank, "empty").when(F.col("is_dup"), F.col(first).cast("string"))
    return marked.withColumn("signal", F.struct(F.lit("DUP-GLOB").alias("code"), F.lit("v2").alias("version"), score.alias("score"), raw.alias("raw"), (blank | F.col("is_dup")).alias("hard")))


# An index of seen texts, kept from run to run (sources.versions): a row for each bucket, with the least key in it.

SEEN = "bucket long, seen string"


def buckets(sigs: DataFrame, key: str = "ord", bands: int = 5, rows: int = 25) -> DataFrame:
    """(key, bucket): the buckets of min-hash signatures."""
    return sigs.select(key, F.explode(_bands(bands, rows)).alias("bucket"))


def _bands(bands: int, rows: int) -> Column:
    return F.array(*[F.xxhash64(F.lit(i), F.slice("sig", i * rows + 1, rows)) for i in range(bands)])


def remember(placed: DataFrame, path: str, key: str = "ord") -> None:
    """Add rows (key, bucket) to the index under path, and keep its parts few: each bucket once a level, in order of bucket."""

    def whole(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket").agg(F.min("seen").alias("seen")).repartitionByRange("bucket").sortWithinPartitions("bucket")

    versions.append(whole(placed.select("bucket", F.col(key).cast("string").alias("seen"))), path)
    versions.compact(placed.sparkSession, path, SEEN, whole)


def seen_before(placed: DataFrame, path: str, key: str = "ord") -> DataFrame:
    """(key, seen): for rows (key, bucket) the least key of the index that shares a bucket, else null. A missing index is empty."""
    known = versions.read(placed.sparkSession, path, SEEN).groupBy("bucket").agg(F.min("seen").alias("seen"))
    return placed.join(known, "bucket", "left").groupBy(key).agg(F.min("seen").alias("seen"))


#: Bytes of texts that are objects at once, and shingles that all hash functions see at once.
PIECE, STRIP = 1 << 20, 1024


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of about PIECE bytes of a column of texts, or of one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PIECE, "right")))
        yield batch.slice(at, to - at)
        at = to


def signatures(rows: DataFrame, text_col: str, order: str = "ord", n: int = 5, perms: int = 128) -> DataFrame:
    """(order, sig): min-hashes of the text's character shingles."""
    kind = rows.schema[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.RandomState(7)
        a = (rng.randint(1, 1 << 62, perms, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        b = rng.randint(0, 1 << 62, perms, dtype=np.int64).astype(np.uint64)[:, None]
        hashed = np.empty((perms, STRIP), dtype=np.uint64)

        def one(s: str | None) -> np.ndarray:
            p = np.frombuffer(" ".join((s or "").split()).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
            m = max(1, len(p) - n + 1)
            g = np.full(m, len(p), dtype=np.uint64)
            for k in range(min(n, len(p))):
                g = (g ^ p[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
                g ^= g >> np.uint64(29)
            g = np.unique(g)
            least = np.full(perms, np.iinfo(np.uint64).max, dtype=np.uint64)
            for lo in range(0, len(g), STRIP):
                strip = g[lo : lo + STRIP]
                own = hashed[:, : len(strip)]
                np.multiply(strip, a, out=own)
                np.bitwise_xor(own, b, out=own)
                np.minimum(least, own.min(axis=1), out=least)
            return least.view(np.int64)

        for batch in batches:
            for piece in pieces(batch, 1):
                sigs = np.concatenate([one(s) for s in piece.column(1).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(piece.num_rows + 1) * perms, type=pa.int32()), pa.array(sigs))
                yield pa.RecordBatch.from_arrays([piece.column(0), lists], names=[order, "sig"])

    return rows.select(order, text_col).mapInArrow(run, T.StructType([kind, T.StructField("sig", T.ArrayType(T.LongType()))]))


def insert_in_order(sigs: DataFrame, order: str = "ord", bands: int = 5, rows: int = 25) -> tuple[DataFrame, DataFrame]:
    """What sequential insertion keeps, and what it sees: (order, kept) of all rows, and (u, v) of each row v and the kept rows u before it that share a bucket.

    A row goes if a kept row before it is in one of its buckets, without verification. No pairs of a bucket are made: a bucket
    has at most one kept row. A row that is the first open one of all its buckets is kept, and the other open rows of these
    buckets go; each round settles such rows, the first open row always among them. Of rows with the same buckets the first is
    asked alone, for the others go in any case. Null signatures are kept. Signatures are computed once, and only their buckets are stored.
    """
    sigs = stored(sigs.select(order, F.when(F.col("sig").isNotNull(), _bands(bands, rows)).alias("sig")), "signatures")
    first = stored(sigs.filter("sig IS NOT NULL").groupBy("sig").agg(F.min(order).alias("n")), "first")
    every = cells = stored(first.select("n", F.explode("sig").alias("bucket")).distinct(), "cells")
    keepers = []
    while True:
        heads = cells.groupBy("bucket").agg(F.min("n").alias("head"))
        wins = cells.join(heads, "bucket").groupBy("n").agg(F.bool_and(F.col("n") == F.col("head")).alias("wins")).filter("wins").select("n")
        keepers.append(stored(cells.join(wins, "n", "left_semi").select("bucket", F.col("n").alias("u")), "keepers"))
        gone = cells.join(keepers[-1], "bucket").select("n").distinct()
        cells = stored(cells.join(gone, "n", "left_anti"), "cells")
        if cells.isEmpty():
            break
    held = stored(reduce(DataFrame.unionByName, keepers), "keepers")
    seen = every.join(held, "bucket").select("u", "n").distinct()
    pairs = sigs.join(first, "sig").join(seen, "n").filter(F.col("u") < F.col(order)).select("u", F.col(order).alias("v"))
    kept = sigs.select(order).join(held.select(F.col("u").alias(order), F.lit(True).alias("kept")).distinct(), order, "left")
    blank = sigs.filter("sig IS NULL").select(order, F.lit(True).alias("blank"))
    return kept.join(blank, order, "left").select(order, F.coalesce("kept", "blank", F.lit(False)).alias("kept")), pairs


def greedy_keep(nodes: DataFrame, edges: DataFrame, order: str = "ord") -> DataFrame:
    """nodes with kept, as sequential insertion decides: a row goes if an earlier kept row is its neighbour.

    Each round keeps the rows that have no open neighbour before them, the first open row always among them, and their neighbours go. Only
    edges between open rows are left for the next. Edges are computed once and lie together by their later row.
    """
    edges = stored(edges.select("u", "v").repartition("v"), "edges")
    gone = []
    while True:
        heads = edges.select(F.col("u").alias("n")).distinct().join(edges.select(F.col("v").alias("n")).distinct(), "n", "left_anti")
        gone.append(stored(edges.join(heads.withColumnRenamed("n", "u"), "u", "left_semi").select(F.col("v").alias("n")).distinct(), "gone"))
        edges = stored(edges.join(gone[-1].withColumnRenamed("n", "u"), "u", "left_anti").join(gone[-1].withColumnRenamed("n", "v"), "v", "left_anti").select("u", "v"), "edges")
        if edges.isEmpty():
            break
    lost = reduce(DataFrame.unionByName, gone).select(F.col("n").alias(order), F.lit(False).alias("kept"))
    return nodes.join(lost, order, "left").withColumn("kept", F.coalesce("kept", F.lit(True)))


def cosine(a: Column, b: Column) -> Column:
    """0 for vectors of unlike length, empty ones and zero ones."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, z: s + z)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), F.coalesce(F.try_divide(dot(a, b), size), F.lit(0.0))).otherwise(0.0)
