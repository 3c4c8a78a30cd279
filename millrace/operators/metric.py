"""Pairs of vectors at a cosine of t and more, exactly, without meeting all with all: a metric partition by pivots.

The angle between vectors is a metric, so the triangle inequality says what can't be near. Every vector is a resident of the cell of its nearest
pivot; a cell has a radius. A vector is a guest of a cell with a higher number only if neither the cell's radius nor the fact that its residents
are nearer to their pivot than to the vector's own rules out an angle of t there. Residents meet residents and guests of their cell, as blocks of about
BLOCK vectors each, one pair of blocks a unit of work, so a crowded cell, a common vector or many guests spread over tasks. A vector moves once for
each block that it meets, so blocks are large; a unit compares them TILE vectors at a time. Pivots are the vectors with the least
hashes of their ids, at most MOST_PIVOTS; what the driver holds is they and a few numbers a cell.

Vectors of unlike length aren't similar, nor are empty and zero ones, and those with nulls, NaN or infinities. Ids are unique; t is above 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import stored

BLOCK = 16384
#: Vectors of a block that are compared at once, and that are dealt out at once.
TILE = 512
MOST_PIVOTS = 256
#: What rounding may add to an angle near 0.
SLACK = 1e-6


@dataclass
class Cells:
    """pivots: unit vectors; radius, residents, guests: of each cell."""

    pivots: np.ndarray
    angle: float
    radius: np.ndarray
    residents: np.ndarray
    guests: np.ndarray

    def angles(self, x: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(x @ self.pivots.T, -1, 1))

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home of each vector, which vector, cell) of the unit vectors x: where they are guests."""
        d = self.angles(x)
        home = d.argmin(axis=1)
        near = d[np.arange(len(x)), home][:, None]
        may = (d - self.radius <= self.angle + SLACK) & (d - near <= 2 * self.angle + SLACK)
        may &= np.arange(len(self.pivots)) > home[:, None]
        which, cell = np.nonzero(may & (self.residents > 0))
        return home, which, cell


def _unit(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def partition(vectors: DataFrame, t: float, dims: int) -> Cells:
    """The cells of vectors (id, e), all of dims components and of a length above 0."""
    n = vectors.count()
    pivots = vectors.orderBy(F.xxhash64("id"), "id").limit(max(1, min(MOST_PIVOTS, n // BLOCK + 8))).collect()
    p = np.array([r.e for r in pivots], dtype=np.float64).reshape(-1, dims)
    # Pivots that are alike make empty cells: one of each.
    p = np.unique(p / np.linalg.norm(p, axis=1, keepdims=True), axis=0)
    k = len(p)
    cells = Cells(p, float(np.arccos(t)), np.zeros(k), np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radius, held = np.zeros(k), np.zeros(k, dtype=np.int64)
        for batch in batches:
            d = cells.angles(_unit(batch, dims))
            home = d.argmin(axis=1)
            np.maximum.at(radius, home, d[np.arange(len(d)), home])
            held += np.bincount(home, minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(radius), pa.array(held)], names=["cell", "radius", "n"])

    for r in vectors.mapInArrow(homes, "cell long, radius double, n long").groupBy("cell").agg(F.max("radius").alias("radius"), F.sum("n").alias("n")).collect():  # k rows
        cells.radius[r.cell], cells.residents[r.cell] = r.radius, r.n

    def guests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(k, dtype=np.int64)
        for batch in batches:
            held += np.bincount(cells.visits(_unit(batch, dims))[2], minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(held)], names=["cell", "n"])

    for r in vectors.mapInArrow(guests, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # k rows
        cells.guests[r.cell] = r.n
    return cells


def units(vectors: DataFrame, cells: Cells, dims: int) -> DataFrame:
    """(cell, a, b, left, id, w, e): the vectors of each unit of work, block a of a cell's residents (left) against block b, of its residents if b < 0 (block -1 - b) or of its guests."""
    kind = vectors.schema["id"].dataType
    out = T.StructType([*[T.StructField(c, T.IntegerType()) for c in ("cell", "a", "b")], T.StructField("left", T.BooleanType()), T.StructField("id", kind), T.StructField("w", T.LongType()), T.StructField("e", T.ArrayType(T.DoubleType()))])
    blocks, rooms = -(-cells.residents // BLOCK), -(-cells.guests // BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TILE):
                batch = whole.slice(at, TILE)
                x = _unit(batch, dims)
                home, which, cell = cells.visits(x)
                dealt = batch.column(3).to_numpy(zero_copy_only=False)
                rows = []
                for i in range(len(x)):
                    c, own = int(home[i]), int(dealt[i] % blocks[home[i]])
                    rows += [(c, own, -1 - j, True, i) for j in range(own, int(blocks[c]))]
                    rows += [(c, j, -1 - own, False, i) for j in range(own)]
                    rows += [(c, own, j, True, i) for j in range(int(rooms[c]))]
                for i, c in zip(which.tolist(), cell.tolist(), strict=True):
                    rows += [(c, j, int(dealt[i] % rooms[c]), False, i) for j in range(int(blocks[c]))]
                for lo in range(0, len(rows), 16 * TILE):
                    a = np.array(rows[lo : lo + 16 * TILE], dtype=np.int64)
                    e = pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * dims, type=pa.int32()), pa.array(x[a[:, 4]].ravel()))
                    yield pa.RecordBatch.from_arrays([*[pa.array(a[:, j].astype(np.int32)) for j in range(3)], pa.array(a[:, 3].astype(bool)), batch.column(0).take(pa.array(a[:, 4])), batch.column(2).take(pa.array(a[:, 4])), e], names=out.fieldNames())

    return vectors.withColumn("dealt", F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 30))).mapInArrow(run, out)


def _met(pdf: pd.DataFrame, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, id, cosine) of the similar pairs of a unit."""
    left, block = pdf["left"].to_numpy(), int(pdf["b"].iloc[0])
    ids, e = pdf["id"].to_numpy(), pdf["e"].to_numpy()
    one = np.flatnonzero(left)
    two = one if block < 0 and -1 - block == int(pdf["a"].iloc[0]) else np.flatnonzero(~left)
    if not len(one) or not len(two):
        return ids[:0], ids[:0], np.zeros(0)
    a, b = ids[one], ids[two]
    x, y = np.stack(e[one]), np.stack(e[two]).T
    found = []
    for lo in range(0, len(one), TILE):
        s = x[lo : lo + TILE] @ y
        i, j = np.nonzero(s >= t)
        if one is two:
            keep = a[lo + i] < b[j]
            i, j = i[keep], j[keep]
        found.append((a[lo + i], b[j], s[i, j]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _good(rows: DataFrame, name: str, vector: str) -> DataFrame:
    """(id, e, w) of the vectors that can be similar to one, w = 1."""
    e = F.col(f"`{vector}`")
    odd = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(e.isNotNull() & ~odd & F.exists(e, lambda x: x != 0)).select(F.col(f"`{name}`").alias("id"), e.cast("array<double>").alias("e"), F.lit(1).cast("long").alias("w"))


def _work(good: DataFrame, t: float) -> Iterator[DataFrame]:
    """The units of each length of the vectors (id, e, w)."""
    good = stored(good, "vectors")
    for r in good.groupBy(F.size("e").alias("dims")).count().filter("count > 1").orderBy("dims").collect():  # a row for each length in use
        own = good.filter(F.size("e") == r.dims)
        yield units(own, partition(own.select("id", "e"), t, r.dims), r.dims)


def pairs(rows: DataFrame, t: float, name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(u, v, similarity) of all pairs u < v with cosine >= t."""
    kind = rows.schema[name].dataType
    out = T.StructType([T.StructField("u", kind), T.StructField("v", kind), T.StructField("similarity", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, s = _met(pdf, t)
        return pd.DataFrame({"u": np.minimum(a, b), "v": np.maximum(a, b), "similarity": s})

    found = rows.sparkSession.createDataFrame([], out)
    for work in _work(_good(rows, name, vector), t):
        found = found.unionByName(work.groupBy("cell", "a", "b").applyInPandas(run, out))
    return found


def neighbours(rows: DataFrame, t: float, name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(name, class_id, n_links) of every row: the least id with the same vector, and how many other rows are at a cosine of t or more. Equal vectors are compared once; no pair leaves a unit of work."""
    kind = rows.schema[name].dataType
    out = T.StructType([T.StructField("id", kind), T.StructField("n", T.LongType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, _ = _met(pdf, t)
        weight = pdf.drop_duplicates("id").set_index("id")["w"]
        both = pd.DataFrame({"id": np.concatenate([a, b]), "n": weight.reindex(np.concatenate([b, a])).to_numpy(dtype=np.int64)})
        return both.groupby("id", as_index=False)["n"].sum()

    every = _good(rows, name, vector).withColumns({"x": F.xxhash64("e"), "y": F.xxhash64(F.lit(1), "e")})
    alike = every.groupBy("x", "y").agg(F.min("id").alias("class_id"), F.sum("w").alias("w"))
    every = stored(every.join(alike.drop("w"), ["x", "y"]).select("id", "class_id", "e"), "alike")
    held = every.groupBy("class_id").agg(F.count(F.lit(1)).alias("w"))
    found = rows.sparkSession.createDataFrame([], out)
    for work in _work(every.filter("id = class_id").join(held, "class_id").select("id", "e", "w"), t):
        found = found.unionByName(work.groupBy("cell", "a", "b").applyInPandas(run, out))
    near = held.join(found.groupBy("id").agg(F.sum("n").alias("n")), F.col("id") == F.col("class_id"), "left").select("class_id", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    own = every.select("id", "class_id").join(near, "class_id").withColumnRenamed("id", name)
    return rows.select(F.col(f"`{name}`")).join(own, name, "left").withColumns({"class_id": F.coalesce("class_id", name), "n_links": F.coalesce("n_links", F.lit(0))})
