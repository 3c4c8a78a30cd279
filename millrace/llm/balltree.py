"""Centroid clustering (Lloyd's rounds over integer vectors) with ball trees that assign whole balls at once.

Each task packs its vectors into blocks of at most BLOCK and builds a metric tree over each: a block is halved along the line
between two of its far points until LEAF vectors are left, and every ball keeps its radius, its count and the integer sum of
its vectors. Blocks are stored once, as one row each. A round walks all trees level by level: centroids that are farther than
another by more than the ball's diameter drop out by the triangle inequality; a ball with one centroid left gives it count and sum
without a look at its vectors; what is left at the bottom is compared exactly. What leaves a task is one row a centroid,
summed up by Spark; the driver holds k centroids.

A vector counts if it has exactly `dims` components, none null or not finite; component x is the integer floor(scale * x), held
within +-2^27 so that a squared distance fits a long (for scale 64 only floats beyond two millions are held). The first
centroids are the k counted vectors with the smallest hexadecimal sha256 of "<seed>:<id>" (a null id: nothing after the colon; rows
that share an id: by their components), in that order; with fewer than k vectors all are centroids. A round assigns every vector to the nearest
centroid by squared Euclidean distance, ties to the smaller number, then moves every centroid that has vectors to their componentwise floor(sum / count).
After the rounds vectors are assigned once more.

Defined results: one row for each counted row of the input, repeated rows too; other rows have none; an empty table gives no
rows; other columns aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

BLOCK = 4096
LEAF = 32
HELD = 1 << 27
#: Integers below this have exact products and sums of products (64 terms and more) in doubles.
EXACT = 1 << 22


def counted(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, x) of the vectors that count, x their integer components."""
    v = F.col(f"`{vec_col}`")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.least(F.greatest(F.floor(F.lit(float(scale)) * x.cast("double")), F.lit(-HELD)), F.lit(HELD)).cast("int"))
    return vectors.filter((F.size(v) == dims) & ~odd).select(F.col(f"`{id_col}`").alias("id"), whole.alias("x"))


def bounds(n: int, level: int) -> np.ndarray:
    """Where the 2^level balls of a level begin and end among n vectors."""
    return (np.arange((1 << level) + 1, dtype=np.int64) * n) >> level


def levels(n: int) -> int:
    """How often a block is halved."""
    return max(0, (n // LEAF).bit_length() - 1)


def grow(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the vectors, radii, sums) of the tree over x; balls are numbered level by level."""
    order, deep = np.arange(len(x)), levels(len(x))
    radii, sums = [], []
    for level in range(deep + 1):
        b, then = bounds(len(x), level), bounds(len(x), level + 1)
        for i in range(1 << level):
            own = x[order[b[i] : b[i + 1]]].astype(np.float64)
            total = x[order[b[i] : b[i + 1]]].sum(axis=0, dtype=np.int64)
            off = np.sqrt(((own - total / len(own)) ** 2).sum(axis=1))
            radii.append(off.max() * (1 + 1e-9))
            sums.append(total)
            if level < deep:
                far = own[off.argmax()]
                axis = own[((own - far) ** 2).sum(axis=1).argmax()] - far
                order[b[i] : b[i + 1]] = order[b[i] : b[i + 1]][np.argpartition(own @ axis, then[2 * i + 1] - b[i])]
    return order, np.array(radii), np.array(sums)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector, exactly."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT:
        x, c = x.astype(np.float64), centroids.astype(np.float64)
        d = ((x**2).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c**2).sum(axis=1)).astype(np.int64)
    else:
        d = np.stack([((x.astype(np.int64) - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best]


def filtered(x: np.ndarray, radii: np.ndarray, sums: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(counts, sums of the vectors of each centroid, vectors that were compared one by one) by the tree over x."""
    k = len(centroids)
    counts, totals = np.zeros(k, dtype=np.int64), np.zeros((k, x.shape[1]), dtype=np.int64)
    balls, left, deep = np.zeros(1, dtype=np.int64), np.ones((1, k), dtype=bool), levels(len(x))
    for level in range(deep + 1):
        b = bounds(len(x), level)
        size, node = b[balls + 1] - b[balls], balls + (1 << level) - 1
        centre = sums[node] / size[:, None]
        d = np.sqrt(((centre[:, None, :] - centroids[None, :, :].astype(np.float64)) ** 2).sum(axis=2))
        reach = np.where(left, d, np.inf).min(axis=1) + 2 * radii[node]
        left &= d <= (reach * (1 + 1e-9) + 1e-6)[:, None]
        one = left.sum(axis=1) == 1
        owner = left[one].argmax(axis=1)
        np.add.at(counts, owner, size[one])
        np.add.at(totals, owner, sums[node[one]])
        balls, left = balls[~one], left[~one]
        if level < deep:
            balls, left = np.stack([2 * balls, 2 * balls + 1], axis=1).ravel(), np.repeat(left, 2, axis=0)
    if not len(balls):
        return counts, totals, 0
    rest = np.concatenate([x[b[i] : b[i + 1]] for i in balls])
    best, _ = nearest(rest, centroids)
    np.add.at(counts, best, 1)
    np.add.at(totals, best, rest.astype(np.int64))
    return counts, totals, len(rest)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(next(t for t in (np.int8, np.int16, np.int32) if np.abs(x).max(initial=0) <= np.iinfo(t).max))


def blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """The rows (id, x) as tree blocks: ids, vectors in tree order with their width in bytes, radii, sums."""
    kind = vectors.schema["id"].dataType
    out = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("width", T.IntegerType()), T.StructField("x", T.BinaryType()), T.StructField("radii", T.BinaryType()), T.StructField("sums", T.BinaryType())])

    def pack(ids: list[pa.Array], xs: list[np.ndarray]) -> pa.RecordBatch:
        x, own = np.concatenate(xs), pa.concat_arrays(ids)
        order, radii, sums = grow(x)
        small = _narrow(x[order])
        lists = pa.ListArray.from_arrays(pa.array([0, len(x)], type=pa.int32()), own.take(pa.array(order)))
        return pa.RecordBatch.from_arrays([lists, pa.array([small.dtype.itemsize], type=pa.int32()), *[pa.array([a.tobytes()], type=pa.binary()) for a in (small, radii, sums)]], names=out.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, xs, held = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                x = piece.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int32)
                while held + len(x) >= BLOCK:
                    take = BLOCK - held
                    yield pack([*ids, piece.column(0).slice(0, take)], [*xs, x[:take]])
                    piece, x, ids, xs, held = piece.slice(take), x[take:], [], [], 0
                if len(x):
                    ids.append(piece.column(0))
                    xs.append(x)
                    held += len(x)
        if held:
            yield pack(ids, xs)

    return vectors.mapInArrow(run, out)


def _opened(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        row = batch.slice(i, 1)
        width, x, radii, sums = (row.column(j)[0].as_py() for j in range(1, 5))
        yield row.column(0).flatten(), np.frombuffer(x, dtype=f"i{width}").reshape(-1, dims), np.frombuffer(radii), np.frombuffer(sums, dtype=np.int64).reshape(-1, dims)


def gathered(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, n, sums, compared): for each task and centroid that has vectors there, their number and sums; compared: vectors looked at one by one."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals, compared = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=np.int64), 0
        for batch in batches:
            for _, x, radii, sums in _opened(batch, dims):
                n, s, looked = filtered(x, radii, sums, centroids)
                counts, totals, compared = counts + n, totals + s, compared + looked
        some = np.flatnonzero(counts)
        if len(some):
            spread = np.zeros(len(some), dtype=np.int64)
            spread[0] = compared
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * dims, type=pa.int32()), pa.array(totals[some].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some]), lists, pa.array(spread)], names=["cluster", "n", "sums", "compared"])

    return packed.mapInArrow(run, "cluster int, n long, sums array<long>, compared long")


def moved(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round."""
    parts = gathered(packed, centroids).select("cluster", "n", F.posexplode("sums").alias("at", "s"))
    sums = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    out = centroids.copy()
    for r in sums.collect():  # k x dims rows
        out[r.cluster, r["at"]] = int(r.s) // r.n
    return out


def assigned(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    kind = packed.schema["ids"].dataType.elementType
    out = T.StructType([T.StructField("id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, _, _ in _opened(batch, centroids.shape[1]):
                best, d = nearest(x, centroids)
                yield pa.RecordBatch.from_arrays([ids.cast(arrow), pa.array(best.astype(np.int32)), pa.array(d)], names=out.fieldNames())

    return packed.mapInArrow(run, out)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, rounds: int = 3, seed: int = 1, dims: int = 64, scale: int = 64) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid): every counted vector with its cluster, and the cluster's final centroid."""
    own = counted(vectors, id_col, vec_col, dims, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = [r.x for r in own.orderBy(key, "x").limit(k).collect()]
    centroids = np.array(first, dtype=np.int64).reshape(-1, dims)
    packed = stored(blocks(own, dims), "balls")
    if not first:
        return packed.limit(0).select(F.explode("ids").alias(id_col), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.array().cast("array<long>").alias("centroid"))
    for _ in range(rounds):
        centroids = moved(packed, centroids)
    found = stored(assigned(packed, centroids), "assigned")
    held = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    at = F.col("cluster") + 1
    inertia = F.element_at(F.array(*[F.lit(held.get(i, 0)).cast("long") for i in range(len(centroids))]), at)
    final = F.element_at(F.array(*[F.array(*[F.lit(int(v)).cast("long") for v in c]) for c in centroids]), at)
    return found.select(F.col("id").alias(id_col), "cluster", "distance", inertia.alias("cluster_inertia"), F.lit(sum(held.values())).cast("long").alias("inertia"), final.alias("centroid"))


def digest(found: DataFrame) -> DataFrame:
    """The centroid as the sha256 of its components."""
    return found.withColumn("centroid_sha256", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)).drop("centroid")


def sql(rounds: int = 3, k: int = 16) -> str:
    """DuckDB SQL for the rows of the query."""
    away = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [
        """v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x, row_number() OVER () AS r FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1)::INT AS j, x FROM v QUALIFY j < {k})",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS (SELECT r, vec_id, any_value(v.x) AS x, min({{'d': {away}::BIGINT, 'j': c.j}}) AS m FROM v, c{i} c GROUP BY r, vec_id)")
        if i < rounds:
            parts.append(
                f"""s{i} AS (SELECT j, place, sum(y)::BIGINT AS s, count(*)::BIGINT AS n FROM (SELECT m.j AS j, unnest(x) AS y, generate_subscripts(x, 1) AS place FROM a{i}) GROUP BY j, place),
c{i + 1} AS (SELECT c{i}.j, coalesce(u.x, c{i}.x) AS x FROM c{i} LEFT JOIN (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY place) AS x FROM s{i} GROUP BY j) u ON u.j = c{i}.j)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, m.j AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.j))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.j = m.j"""
