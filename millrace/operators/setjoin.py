"""Exact Jaccard join of shingle sets by prefix filtering.

Shingles are put into one global order, common ones last. Two sets of n and m shingles that share a part t of their union
have a shingle in common among the first n - ceil(t n) + 1 of each, so only these prefixes are indexed. A pair of one bucket is a candidate if the
lengths allow t, if what is left behind the shared shingle allows it, and if it hasn't met in the bucket of an earlier one; candidates are verified on
their whole sets. Sets that are equal are one class from the start: its least key stands for all.

Most candidates share a passage or a chance shingle and little else. So that their texts needn't move, each set has a row of bits, of which each shingle turns one over:
two rows differ in no more bits than the sets differ in shingles, which rules out pairs below t and no others (the bitmap filter of Sandes, Teodoro and Melo).

The order is right whatever it is made of, it only decides the cost: shingles that are met again within a slice of the table are counted
there, all tasks' counts are summed, and the COMMON most frequent come last, by count; others are ordered by their hash. A
bucket of more than BLOCK sets is dealt into blocks that meet in pairs, each pair of blocks a join key of its own; sets travel to verification once for each
pair of blocks of related sets, not once for each pair. Texts are cut into shingles where they are needed, in Arrow batches, and only hashes move.

Words are runs of characters that aren't ASCII white space; with chars, white space is collapsed first and every character counts. A text of less than n units is its
own shingle; one without any has no set, is its own class and has no links. Shingles are compared as 64-bit hashes. Keys are unique and not null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.scratch import stored

BLOCK = 512
COMMON = 1 << 17
#: Shingles that are verified in one unit of work, for each of its two blocks.
UNIT = 1 << 20
#: Buckets a pair is checked against before it meets in a later one; it may meet again beyond them.
HEADS = 8
#: Shingles of a tile when many pairs are verified.
TILE = 4096
SLICE = 1 << 20

_M = np.uint64(0x9E3779B97F4A7C15)


def units(text: str, chars: bool) -> np.ndarray:
    """The hashes of a text's words or characters."""
    if chars:
        return np.frombuffer(" ".join(text.split()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    words = text.encode("utf-8", "surrogatepass").split()
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, dtype=np.uint64)


def grams(text: str | None, n: int, chars: bool) -> np.ndarray:
    """The sorted set of a text's shingle hashes."""
    h = units(text or "", chars)
    if not len(h):
        return np.zeros(0, dtype=np.int64)
    size = max(1, len(h) - n + 1)
    g = np.full(size, min(n, len(h)), dtype=np.uint64)
    for k in range(min(n, len(h))):
        g = (g ^ h[k : k + size]) * _M
        g ^= g >> np.uint64(29)
    return np.unique(g.view(np.int64))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of about SLICE bytes of the second column, or one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE, "right")))
        yield batch.slice(at, to - at)
        at = to


def _common(rows: DataFrame, n: int, chars: bool) -> np.ndarray:
    """The most frequent shingles, the most frequent last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _slices(batch):
                found, times = np.unique(np.concatenate([grams(x, n, chars) for x in piece.column(1).to_pylist()]), return_counts=True)
                again = times > 1
                yield pa.RecordBatch.from_arrays([pa.array(found[again]), pa.array(times[again])], names=["gram", "n"])

    counts = rows.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "gram").limit(COMMON).collect()  # at most COMMON rows
    return np.array([r.gram for r in reversed(top)], dtype=np.int64)


def _each(rows: DataFrame, make: Callable[[np.ndarray], list], fields: list[T.StructField], n: int, chars: bool) -> DataFrame:
    """(key, *fields) of rows (key, text), by make(set) of every text that has a set."""
    out = T.StructType([rows.schema.fields[0], *fields])
    kinds = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _slices(batch):
                sets = [grams(x, n, chars) for x in piece.column(1).to_pylist()]
                some = [i for i, g in enumerate(sets) if len(g)]
                made = [make(sets[i]) for i in some]
                columns = [pa.array([m[k] for m in made], type=kinds.field(k + 1).type) for k in range(len(fields))]
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(some, type=pa.int64())), *columns], schema=kinds)

    return rows.mapInArrow(run, out)


def prefix(g: np.ndarray, t: float, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set; order: the common ones, sorted, rank: their places, of which the highest come last."""
    at = np.searchsorted(order, g)
    common = (at < len(order)) & (order[np.minimum(at, len(order) - 1)] == g) if len(order) else np.zeros(len(g), dtype=bool)
    place = np.zeros(len(g), dtype=np.int64)
    place[common] = 1 + rank[at[common]]
    first = np.lexsort((g, place))
    return g[first[: len(g) - int(np.ceil(t * len(g) - 1e-9)) + 1]]


def bits(g: np.ndarray) -> bytes:
    """A row of 2^k bits, one for one or two shingles and 64 at least; each shingle turns over the bit that its last k bits name."""
    k = max(6, (len(g) - 1).bit_length() - 1)
    return np.packbits((np.bincount(g & ((1 << k) - 1), minlength=1 << k) & 1).astype(np.uint8)).tobytes()


def apart(x: bytes, y: bytes) -> int:
    """In how many bits two rows differ, the longer one folded to the length of the other: at most the number of shingles that only one of the sets has."""
    a, b = sorted((np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _prefixes(rows: DataFrame, t: float, n: int, chars: bool) -> DataFrame:
    """(key, a, b, size, first, bits) of every text with a set: its digest, its size, its prefix and its row of bits."""
    common = _common(rows, n, chars)
    sort = np.argsort(common)
    order, rank = common[sort], sort

    def make(g: np.ndarray) -> list:
        both = np.frombuffer(blake2b(g.tobytes(), digest_size=16).digest(), dtype=np.int64).tolist()
        return [*both, len(g), prefix(g, t, order, rank), bits(g)]

    longs = [T.StructField(c, T.LongType()) for c in ("a", "b", "size")]
    fields = [*longs, T.StructField("first", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType())]
    return _each(rows, make, fields, n, chars).withColumnRenamed(rows.columns[0], "key")


def classes(each: DataFrame) -> DataFrame:
    """(key, rep, members, size) of rows (key, a, b, size): the class of each set."""
    own = each.select("key", "a", "b", "size")
    alike = own.groupBy("a", "b", "size").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("members"))
    return own.join(alike, ["a", "b", "size"]).select("key", "rep", "members", "size")


def candidates(reps: DataFrame, t: float) -> tuple[DataFrame, DataFrame]:
    """Of reps (rep, size, first): pairs (u, v) that the filters leave, each once, and homes (rep, size, home), home the first bucket of a set that has company."""
    entry = reps.select("rep", "size", F.posexplode("first").alias("pos", "gram"))
    full = entry.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    met = entry.join(full, "gram").groupBy("rep", "size").agg(F.array_sort(F.collect_list(F.struct("pos", "gram", "held"))).alias("e"))
    met = stored(met, "buckets")
    placed = met.select("rep", "size", F.transform(F.slice("e", 1, HEADS), lambda x: x["gram"]).alias("heads"), F.posexplode("e").alias("i", "x"))
    blocks = F.ceil(F.col("x.held") / BLOCK).cast("int")
    placed = placed.select("rep", "size", F.col("x.gram").alias("gram"), F.col("x.pos").alias("pos"), F.slice("heads", F.lit(1), F.least("i", F.lit(HEADS))).alias("early"), blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"))
    left = placed.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1))).select(F.col("gram"), F.col("block").alias("lo"), F.col("other").alias("hi"), *[F.col(c).alias(f"{c}1") for c in ("rep", "size", "pos", "early")])
    right = placed.withColumn("other", F.explode(F.sequence(F.lit(0), "block"))).select(F.col("gram"), F.col("other").alias("lo"), F.col("block").alias("hi"), *[F.col(c).alias(f"{c}2") for c in ("rep", "size", "pos", "early")])
    both = left.join(right, ["gram", "lo", "hi"]).filter((F.col("lo") < F.col("hi")) | (F.col("rep1") < F.col("rep2")))
    need = F.lit(t / (1 + t)) * (F.col("size1") + F.col("size2")) - 1e-9
    rest = F.least(F.col("size1") - F.col("pos1"), F.col("size2") - F.col("pos2"))
    fit = (F.col("size1") >= F.col("size2") * t - 1e-9) & (F.col("size2") >= F.col("size1") * t - 1e-9) & (rest >= need)
    pairs = both.filter(fit).filter(~F.arrays_overlap("early1", "early2")).select(F.least("rep1", "rep2").alias("u"), F.greatest("rep1", "rep2").alias("v")).distinct()
    return pairs, met.select("rep", "size", F.col("e")[0]["gram"].alias("home"))


def likely(pairs: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """The pairs (u, v) that the rows of bits of their sets (rep, size, bits) leave."""
    one, two = (sets.select(F.col("rep").alias(k), F.col("size").alias(f"s{k}"), F.col("bits").alias(f"b{k}")) for k in "uv")

    @F.arrow_udf(T.LongType())
    def differ(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([apart(a, b) for a, b in zip(x.to_pylist(), y.to_pylist(), strict=True)], type=pa.int64())

    most = F.lit((1 - t) / (1 + t)) * (F.col("su") + F.col("sv")) + 1e-6
    return pairs.join(one, "u").join(two, "v").filter(differ("bu", "bv") <= most).select("u", "v")


def overlaps(sets: list[np.ndarray], u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """How many shingles the sets u[i] and v[i] share. Few pairs are met one by one; many by products of tiles, sets x shingles that several hold."""
    if len(u) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(u, v, strict=True)], dtype=np.int64)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(g) for g in sets])
    several = held[column] > 1
    place = np.cumsum(held > 1) - 1
    row, column = row[several], place[column[several]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for lo in range(0, int(column.max(initial=-1)) + 1, TILE):
        i, j = np.searchsorted(column, [lo, lo + TILE])
        tile = np.zeros((len(sets), TILE), dtype=np.float32)
        tile[row[i:j], column[i:j] - lo] = 1
        both += tile @ tile.T
    return both[u, v].astype(np.int64)


def _shared(work: DataFrame, n: int, chars: bool) -> DataFrame:
    """(u, v, shared) of units of work (pairs, texts)."""
    kind = work.schema["pairs"].dataType.elementType["u"].dataType
    out = T.StructType([T.StructField("u", kind), T.StructField("v", kind), T.StructField("shared", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (u, v), (keys, texts) = batch.column(0)[i].values.flatten(), batch.column(1)[i].values.flatten()
                at = {k: j for j, k in enumerate(keys.to_pylist())}
                sets = [grams(x, n, chars) for x in texts.to_pylist()]
                a, b = (np.array([at[k] for k in c.to_pylist()], dtype=np.int64) for c in (u, v))
                yield pa.RecordBatch.from_arrays([u, v, pa.array(overlaps(sets, a, b))], names=["u", "v", "shared"])

    return work.mapInArrow(run, out)


def links(rows: DataFrame, key: str, text: str, t: float = 0.8, n: int = 5, chars: bool = False) -> tuple[DataFrame, DataFrame]:
    """(classes, pairs): (key, rep, members) of every text with a set, and (u, v, jaccard) of the pairs u < v of classes with jaccard >= t."""
    rows = rows.select(F.col(f"`{key}`"), F.col(f"`{text}`"))
    each = stored(_prefixes(rows, t, n, chars), "prefixes")
    every = stored(classes(each), "classes")
    # The keys of copies are few and narrow: prefixes needn't be dealt out to be rid of theirs.
    reps = each.join(stored(every.filter("key <> rep").select("key"), "copies"), "key", "left_anti").withColumnRenamed("key", "rep")
    pairs, homes = candidates(reps.select("rep", "size", "first"), t)
    pairs = stored(likely(pairs, reps, t), "candidates")
    # Related sets are verified side by side: those of one home, in blocks of bounded size.
    weight = homes.groupBy("home").agg(F.greatest(F.ceil(F.sum("size") / UNIT), F.ceil(F.count(F.lit(1)) / BLOCK)).alias("parts"))
    asked = pairs.select(F.col("u").alias("rep")).union(pairs.select("v")).distinct()
    block = stored(homes.join(asked, "rep", "left_semi").join(weight, "home").select("rep", "size", F.xxhash64("home", F.pmod(F.xxhash64("rep"), "parts")).alias("block")), "blocks")
    one = block.select(F.col("rep").alias("u"), F.col("block").alias("bu"), F.col("size").alias("su"))
    two = block.select(F.col("rep").alias("v"), F.col("block").alias("bv"), F.col("size").alias("sv"))
    sent = stored(pairs.join(one, "u").join(two, "v"), "sent")
    listed = sent.groupBy("bu", "bv").agg(F.collect_list(F.struct("u", "v")).alias("pairs"))
    needed = sent.select("bu", "bv", F.col("u").alias("rep")).union(sent.select("bu", "bv", "v")).distinct()
    # Texts travel, which pack better than hashes.
    texts = needed.join(rows.toDF("rep", "text"), "rep").groupBy("bu", "bv").agg(F.collect_list(F.struct("rep", "text")).alias("texts"))
    shared = _shared(listed.join(texts, ["bu", "bv"]).select("pairs", "texts"), n, chars).join(sent.select("u", "v", "su", "sv"), ["u", "v"])
    jaccard = F.col("shared") / (F.col("su") + F.col("sv") - F.col("shared"))
    found = shared.withColumn("jaccard", jaccard).filter(F.col("jaccard") >= t - 1e-12).select("u", "v", "jaccard")
    return every.select("key", "rep", "members"), found


def linked(rows: DataFrame, key: str, text: str, t: float = 0.8, n: int = 5, chars: bool = False) -> DataFrame:
    """(key, class_id, n_links) of every row: the least key with an equal set, and how many other rows are at t or more."""
    every, pairs = links(rows, key, text, t, n, chars)
    pairs = stored(pairs, "links")
    size = every.filter("key = rep").select("rep", "members")
    ends = pairs.select(F.col("u").alias("rep"), F.col("v").alias("to")).union(pairs.select("v", "u"))
    near = ends.join(size.withColumnsRenamed({"rep": "to"}), "to").groupBy("rep").agg(F.sum("members").alias("near"))
    own = every.join(near, "rep", "left").select("key", F.col("rep").alias("class_id"), (F.col("members") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    return rows.select(F.col(f"`{key}`").alias("key")).join(own, "key", "left").select(F.col("key").alias(key), F.coalesce("class_id", "key").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
