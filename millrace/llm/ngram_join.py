"""N-gram Jaccard join by MinHash banding.

Texts are lower-cased (A-Z) and cut into words; a document's set holds the hashes of its n consecutive words, of all its
words if it has fewer than n, and is empty if it has none. Documents with equal sets form a class of copies, so copies
cost one row. Classes meet in buckets: b bands of r minima each, b and r chosen by choose_bands() for a target recall.
Every pair that meets in a bucket is verified on the full sets, in one of two ways:

* a bucket of at most SMALL classes gives its pairs, less those whose sizes alone rule out the similarity;
* a class of larger (crowded) buckets is at home in the fullest of them. Homes are dealt into blocks of bounded size; a class
  meets the blocks that have members in its own crowded buckets, and no others. Each pair of blocks is one unit of work: it
  compares by matrix products, counts the pairs that share a crowded bucket, and gives per-class counts and a spanning
  forest, never the pairs themselves. So buckets that touch each other in a long chain aren't compared end to end.

Both ways are exact and part the pairs between them, so no partner or candidate is capped. Groups are the connected components over the links.

Defined results: a null or wordless text has an empty set, no links, and stands alone in its class and group. Rows with a
null doc_id are linked as all others; a class or group of such rows alone has a null id. Repeated rows are copies of each other, and so are
rows of one id with equal sets; rows of one id with different texts are rows like any others. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Texts, lists, mix, shared_dir, sliced, stored

#: Classes in a bucket up to which its pairs are listed.
SMALL = 24
#: Shingles that one side of a unit of work holds, about.
BLOCK_SHINGLES = 500_000
#: Classes that one side of a unit of work holds, about.
BLOCK_CLASSES = 800
#: A text with a word.
WORDED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def hit_rate(similarity: float, bands: int, rows: int) -> float:
    """The chance that a pair of this similarity meets in a band."""
    return 1 - (1 - similarity**rows) ** bands


def choose_bands(threshold: float, recall: float, most: int = 160) -> tuple[int, int]:
    """(bands, rows) within most minima: recall at the threshold is reached with the fewest chance meetings at half of it; ties go to fewer minima."""
    fits = [(hit_rate(threshold / 2, b, r), b * r, b, r) for r in range(1, most + 1) for b in range(1, most // r + 1) if hit_rate(threshold, b, r) >= recall]
    if not fits:
        raise ValueError(f"recall {recall} at similarity {threshold} takes more than {most} minima")
    return min(fits)[2:]


def shingle_sets(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds): the sorted distinct shingle hashes of text i are values[bounds[i]:bounds[i + 1]]."""
    words = texts.lowered().runs(ALNUM)
    h, counts = words.hashes(), words.counts()
    at, grams = words.grams(h, n)
    doc = words.text_of()[at]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = []
        for i in short:
            g = np.uint64(int(counts[i]))
            with np.errstate(over="ignore"):
                for x in h[words.bounds[i] : words.bounds[i + 1]]:
                    g = (g ^ x) * np.uint64(0x9E3779B97F4A7C15)
                    g ^= g >> np.uint64(29)
            whole.append(g)
        doc, grams = np.concatenate([doc, short]), np.concatenate([grams, mix(np.array(whole, dtype=np.uint64))])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    doc, grams = doc[new], grams[new]
    return grams.view(np.int64), np.searchsorted(doc, np.arange(len(texts) + 1))


def minima(values: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """[text, k]: the least of the k-th hash over the text's set; only for texts whose set isn't empty."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    out = np.empty((len(full), count), dtype=np.uint64)
    v, at = values.view(np.uint64), bounds[full]
    rng = np.random.RandomState(20240229)
    odd = rng.randint(0, 1 << 62, count, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.randint(0, 1 << 62, count, dtype=np.int64).astype(np.uint64)
    x = np.empty_like(v)
    for k in range(count):
        np.multiply(v, odd[k], out=x)
        np.bitwise_xor(x, add[k], out=x)
        out[:, k] = np.minimum.reduceat(x, at) if len(full) else 0
    return out


def _bands_of(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(sig), bands), dtype=np.uint64)
    for b in range(bands):
        g = np.full(len(sig), b + 1, dtype=np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            g = (g ^ sig[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            g ^= g >> np.uint64(29)
        out[:, b] = mix(g)
    return out.view(np.int64)


def _prints(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal for equal sets."""
    v = values.view(np.uint64)
    out = []
    for x in (v, mix(v ^ np.uint64(0x5851F42D4C957F2D))):
        total = np.zeros(len(v) + 1, dtype=np.uint64)
        np.cumsum(x, out=total[1:])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def fingerprints(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """docs (doc_id, mark, text) as (doc_id, mark, set_a, set_b, size, bands): 128 bits that are equal for equal sets, the set's size, its band hashes."""
    long, many = T.LongType(), T.ArrayType(T.LongType())
    out = T.StructType([docs.schema["doc_id"], docs.schema["mark"], *(T.StructField(c, long) for c in ("set_a", "set_b", "size")), T.StructField("bands", many)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in sliced(batch, "text"):
                values, bounds = shingle_sets(texts, n)
                a, b = _prints(values, bounds)
                size = np.diff(bounds)
                found = _bands_of(minima(values, bounds, bands * rows), bands, rows)
                ends = np.concatenate([[0], np.cumsum((size > 0) * bands)])
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(a), pa.array(b), pa.array(size.astype(np.int64)), lists(found.reshape(-1), ends, pa.int64())], names=out.fieldNames())

    return docs.select("doc_id", "mark", "text").mapInArrow(run, out)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's component over edges (a, b), by least neighbours and label jumps.

    Each round is a bounded number of shuffles of narrow rows, stored in the shared folder; what reaches the driver is
    one count a round.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        moved = stored(moved, "labels")
        jump = moved.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = moved.join(jump, moved["label"] == jump["via"]).select("node", "was", F.col("far").alias("label"))
        after = stored(after, "labels")
        if after.filter(F.col("label") != F.col("was")).isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["mark"] == b["mark"])


def _sets(docs: DataFrame, of: DataFrame, n: int) -> DataFrame:
    """(cls, set) of some classes (cls, doc_id, mark, times), each from the text of its first row, which `times` rows share."""
    met = docs.join(of, _same_row(docs, of)).select("cls", "times", "text")
    out = T.StructType([T.StructField("cls", T.LongType()), T.StructField("set", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in sliced(batch, "text"):
                values, bounds = shingle_sets(texts, n)
                yield pa.RecordBatch.from_arrays([piece.column(0), lists(values, bounds, pa.int64())], names=out.fieldNames())

    single = met.filter("times = 1").select("cls", "text").mapInArrow(run, out)
    return single.unionByName(met.filter("times > 1").select("cls", "text").dropDuplicates(["cls"]).mapInArrow(run, out))


def _block_links(threshold: float):
    """A function for one pair of blocks: per-class link counts over the pairs that share a crowded bucket, and a forest over the links as edges."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cls", ignore_index=True)
        cls, copies, side = pdf["cls"].to_numpy(), pdf["copies"].to_numpy(), pdf["block"].to_numpy()
        same = key[0] == key[1]
        crowds = np.stack(pdf["crowds"].to_numpy())
        sizes = pdf["set"].map(len).to_numpy()
        flat = np.concatenate(pdf["set"].to_numpy()) if len(pdf) else np.zeros(0, dtype=np.int64)
        row = np.repeat(np.arange(len(pdf)), sizes)
        _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        row, column = row[shared], column[shared]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        column = np.unique(column, return_inverse=True)[1] if len(column) else column
        if same:
            left = right = np.arange(len(pdf))
        else:
            left, right = np.flatnonzero(side == key[0]), np.flatnonzero(side != key[0])
        place = np.zeros(len(pdf), dtype=np.int64)
        place[left] = np.arange(len(left))
        in_left = np.zeros(len(pdf), dtype=bool)
        in_left[left] = True
        r_place = np.zeros(len(pdf), dtype=np.int64)
        r_place[right] = np.arange(len(right))
        in_right = np.zeros(len(pdf), dtype=bool)
        in_right[right] = True
        both = np.zeros((len(left), len(right)), dtype=np.float32)
        step = 4096
        width = int(column[-1]) + 1 if len(column) else 0
        for c0 in range(0, width, step):
            lo, hi = np.searchsorted(column, [c0, c0 + step])
            r, c = row[lo:hi], column[lo:hi] - c0
            a = np.zeros((len(left), step), dtype=np.float32)
            b = a if same else np.zeros((len(right), step), dtype=np.float32)
            m = in_left[r]
            a[place[r[m]], c[m]] = 1
            if not same:
                m = in_right[r]
                b[r_place[r[m]], c[m]] = 1
            both += a @ b.T
        union = sizes[left][:, None] + sizes[right][None, :] - both
        linked = both >= threshold * union - 1e-6
        meet = np.zeros(linked.shape, dtype=bool)
        for k in range(crowds.shape[1]):
            meet |= (crowds[left, k][:, None] == crowds[right, k][None, :]) & (crowds[left, k] != 0)[:, None]
        linked &= meet
        if same:
            np.fill_diagonal(linked, False)
        n_links = np.zeros(len(pdf), dtype=np.int64)
        n_links[left] += linked @ copies[right]
        if not same:
            n_links[right] += linked.T @ copies[left]
        root = np.arange(len(pdf))
        todo = np.ones(len(pdf), dtype=bool)
        adj_r = linked.T if not same else linked
        for start in range(len(pdf)):  # breadth first; each class is expanded once
            if not todo[start]:
                continue
            todo[start] = False
            front = [start]
            while front:
                x = front.pop()
                near = np.zeros(len(pdf), dtype=bool)
                if in_left[x]:
                    near[right[linked[place[x]]]] = True
                if not same and in_right[x]:
                    near[left[adj_r[r_place[x]]]] = True
                new = np.flatnonzero(near & todo)
                todo[new] = False
                root[new] = start
                front.extend(new.tolist())
        return pd.DataFrame({"cls": cls, "root": cls[root], "n_links": n_links})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row per document: doc_id, class_id (least id with an equal set), group_id (least id of its component),
    n_links (other documents of similarity >= threshold), n_shingles, mark (md5 of the text), first (whether no other id
    and text of its group comes before its own; null ids come last)."""
    shared_dir(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall)
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), mark_of(text_col).alias("mark"), F.col(f"`{text_col}`").alias("text"))
    prints = stored(fingerprints(docs, n, bands, rows), "prints")
    alike = prints.filter("size > 0").groupBy("doc_id", "mark", "set_a", "set_b", "size").agg(F.count(F.lit(1)).alias("times"), F.first("bands").alias("bands"))
    by_row = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "mark", "times")
    classes = alike.groupBy("set_a", "set_b", "size").agg(F.min(by_row).alias("rep"), F.sum("times").alias("copies"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    placed = classes.select("cls", "size", F.posexplode("bands").alias("band", "bucket"))
    filled = stored(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "buckets")

    # Crowded buckets, the home of each of their classes, and its blocks.
    inside = placed.join(filled.filter(F.col("members") > SMALL), "bucket")
    own = F.map_from_entries(F.collect_list(F.struct("band", "bucket")))
    crowds = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.coalesce(F.element_at("own", k), F.lit(0)))
    at_home = inside.groupBy("cls", "size").agg(own.alias("own"), F.max(F.struct("members", "bucket"))["bucket"].alias("home")).select("cls", "size", "home", crowds.cast("array<long>").alias("crowds"))
    at_home = stored(at_home, "homes")
    load = at_home.groupBy("home").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("members"))
    load = load.select("home", F.greatest(F.ceil(F.col("load") / BLOCK_SHINGLES), F.ceil(F.col("members") / BLOCK_CLASSES)).alias("blocks"))
    dealt = at_home.join(load, "home").select("cls", "crowds", F.xxhash64("home", F.pmod(F.xxhash64("cls"), F.col("blocks"))).alias("block"))
    dealt = stored(dealt, "blocks")
    inside = dealt.select("cls", "block", F.explode("crowds").alias("bucket")).filter("bucket <> 0")
    touched = inside.groupBy("bucket").agg(F.collect_set("block").alias("others"))  # a block for each BLOCK_CLASSES members of a home
    meets = inside.join(touched, "bucket").groupBy("cls", "block").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    meets = meets.select("cls", "block", F.explode("others").alias("other")).select("cls", F.least("block", "other").alias("u"), F.greatest("block", "other").alias("v"))

    # Pairs of the other buckets, less those that a unit counts.
    few = filled.filter(F.col("members") <= SMALL).select("bucket")
    met = placed.join(few, "bucket").groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("cls", "size"))).alias("m"))
    met = met.select(F.explode("m").alias("x"), "m").select("x", F.explode(F.filter("m", lambda y: (y["cls"] > F.col("x.cls")) & (F.least(y["size"], F.col("x.size")) >= F.greatest(y["size"], F.col("x.size")) * threshold - 1e-6))).alias("y"))
    pairs = met.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()
    crowd_a, crowd_b = (dealt.select(F.col("cls").alias(c), F.filter("crowds", lambda x: x != 0).alias(f"crowds_{c}")) for c in "ab")
    pairs = pairs.join(crowd_a, "a", "left").join(crowd_b, "b", "left").filter(~F.coalesce(F.arrays_overlap("crowds_a", "crowds_b"), F.lit(False))).select("a", "b")
    pairs = stored(pairs, "pairs")

    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(dealt.select("cls")).distinct()
    sets = stored(_sets(docs, classes.join(wanted, "cls").select("cls", "rep.doc_id", "rep.mark", "rep.times"), n), "sets")
    close = pairs.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a")), "a").join(sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b")), "b")
    close = close.withColumn("both", F.size(F.array_intersect("set_a", "set_b"))).filter(F.col("both") >= threshold * (F.size("set_a") + F.size("set_b") - F.col("both")) - 1e-6)
    close = stored(close.select("a", "b"), "links")
    crowd_sets = stored(dealt.join(classes.select("cls", "copies"), "cls").join(sets, "cls"), "crowd")
    units = meets.join(crowd_sets, "cls")
    counted = stored(units.groupBy("u", "v").applyInPandas(_block_links(threshold), "cls long, root long, n_links long"), "units")

    edges = close.union(counted.filter(F.col("cls") != F.col("root")).select(F.col("cls").alias("a"), F.col("root").alias("b")))
    groups = components(edges)
    weight = classes.select(F.col("cls").alias("other"), "copies")
    one_way = reduce(DataFrame.union, [close.select(F.col(x).alias("cls"), F.col(y).alias("other")) for x, y in ("ab", "ba")])
    tally = one_way.join(weight, "other").select("cls", F.col("copies").alias("n")).union(counted.select("cls", F.col("n_links").alias("n"))).groupBy("cls").agg(F.sum("n").alias("linked"))
    grouped = groups.withColumnRenamed("node", "cls").join(classes.select("cls", "rep"), "cls")
    heads = grouped.groupBy("label").agg(F.min("rep").alias("head"))
    facts = classes.join(tally, "cls", "left").join(grouped.join(heads, "label").select("cls", "head"), "cls", "left")
    facts = facts.select("set_a", "set_b", F.col("size").alias("s"), "rep", F.coalesce("head", "rep").alias("head"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"))
    hit = (prints["set_a"] == facts["set_a"]) & (prints["set_b"] == facts["set_b"]) & (prints["size"] == facts["s"])
    out = prints.join(facts, hit, "left")
    alone = F.col("links").isNull()
    return out.select(
        prints["doc_id"],
        F.when(alone, prints["doc_id"]).otherwise(F.col("rep.doc_id")).alias("class_id"),
        F.when(alone, prints["doc_id"]).otherwise(F.col("head.doc_id")).alias("group_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        prints["size"].alias("n_shingles"),
        prints["mark"],
        (alone | (prints["doc_id"].eqNullSafe(F.col("head.doc_id")) & (prints["mark"] == F.col("head.mark")))).alias("first"),
    )


def mark_of(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with one row of each group of near duplicates: its first (see near_duplicates), once. Rows without words all stay.

    Decisions are narrow rows; the texts meet them in one join.
    """
    first = near_duplicates(docs, id_col, text_col, **how).filter(F.col("first") & (F.col("n_shingles") > 0))
    first = first.groupBy("doc_id", F.col("mark").alias("dup__mark")).agg(F.count(F.lit(1)).alias("dup__times")).withColumnRenamed("doc_id", "dup__id")
    first = stored(first, "first")
    worded = F.coalesce(F.col(f"`{text_col}`").rlike(WORDED), F.lit(False))
    own = [F.col(f"`{c}`") for c in docs.columns]
    tagged = docs.filter(worded).withColumn("dup__own", mark_of(text_col))
    met = tagged.join(first, F.col(f"`{id_col}`").eqNullSafe(F.col("dup__id")) & (F.col("dup__own") == F.col("dup__mark")))
    single = met.filter("dup__times = 1").select(*own)
    again = met.filter("dup__times > 1").dropDuplicates([id_col, "dup__own"]).select(*own)
    return docs.filter(~worded).unionByName(single).unionByName(again)
