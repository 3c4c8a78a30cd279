"""Shared parts of the training-data operators: byte-level text kernels, Arrow plumbing and shared scratch space.

The kernels work on the UTF-8 buffer of an Arrow string column, never on Python strings, and a batch is cut into
slices of a megabyte before any temporary array is made, so the memory of a task doesn't depend on how many rows Spark
puts into a batch. A text longer than a slice is a slice of its own; what is counted by the byte is counted in parts of it
(Texts.parts), and what is kept for each word takes at most 30 bytes of memory a byte of text.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_BYTES = 1 << 20

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z, and every byte of a character beyond ASCII.
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Bytes of [^\x20\x09-\x0D].
NOSPACE = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])

#: The low bytes of a block of 8 that a run with so many bytes left has.
_LEFT = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=_U)
#: Runs that are hashed or compared at once.
_RUNS = 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit hashes."""
    h = h ^ (h >> _U(31))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Texts:
    """The UTF-8 bytes of some texts, end to end; text i is data[offsets[i]:offsets[i + 1]]. A null has no bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self._blocks: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def blocks(self) -> np.ndarray:
        """For each byte, it and the 7 after it as one number, without a copy for each; beyond the end stand zeros."""
        if self._blocks is None:
            padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
            self._blocks = np.ndarray((len(self.data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
        return self._blocks

    def parts(self, limit: int) -> Iterator[tuple[Texts, int, bool]]:
        """Pieces of at most limit bytes, in order: (piece, number of its first text, whether that text began in a piece before).

        A text longer than limit is divided, between any two bytes.
        """
        o, i, pos = self.offsets, 0, 0
        while i < len(self):
            j = int(np.searchsorted(o, pos + limit, "right")) - 1
            if j > i:
                yield Texts(self.data[pos : o[j]], np.maximum(o[i : j + 1], pos) - pos), i, pos > o[i]
                i, pos = j, int(o[j])
            else:
                yield Texts(self.data[pos : pos + limit], np.array([0, limit], dtype=np.int64)), i, pos > o[i]
                pos += limit

    def count(self, member: np.ndarray) -> np.ndarray:
        """How many bytes of each text member holds for."""
        out = np.zeros(len(self), dtype=np.int64)
        for part, i, _ in self.parts(SLICE_BYTES):
            out[i : i + len(part)] += per_text(member[part.data], part.offsets)
        return out

    def lowered(self) -> Texts:
        """A-Z to lower case; nothing else changes."""
        return Texts(np.frombuffer(self.data.tobytes().translate(_LOWER), dtype=np.uint8), self.offsets)

    def runs(self, member: np.ndarray) -> Runs:
        """The maximal runs of bytes for which member[byte] holds, none across two texts."""
        inside = member[self.data]
        if not len(inside):
            none = np.zeros(0, dtype=np.int64)
            return Runs(self, none, none, np.zeros(len(self.offsets), dtype=np.int64))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        o = self.offsets
        heads, tails = o[:-1][o[:-1] < len(inside)], o[1:][o[1:] > 0] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
        starts = np.flatnonzero(first)
        return Runs(self, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, o))


class Runs:
    """Words or lines: run j is bytes starts[j]:ends[j]; those of text i are bounds[i]:bounds[i + 1]."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray):
        self.texts, self.starts, self.ends, self.bounds = texts, starts, ends, bounds

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.counts())

    def _cut(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The blocks of 8 bytes of runs of these sizes: (where a run's blocks begin, run, place from the run's start, mask)."""
        many = np.maximum(1, (size + 7) >> 3)
        first = np.cumsum(many) - many
        run = np.repeat(np.arange(len(size)), many)
        at = (np.arange(len(run)) - first[run]) << 3
        return first, run, at, _LEFT[np.minimum(size[run] - at, 8)]

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the runs' bytes; they depend on nothing but the bytes.

        Each block of 8 bytes is mixed with its place before the blocks are summed, so the sum isn't linear in the bytes.
        """
        out = np.empty(len(self), dtype=_U)
        blocks = self.texts.blocks()
        for i in range(0, len(self), _RUNS):
            starts = self.starts[i : i + _RUNS]
            size = self.ends[i : i + _RUNS] - starts
            first, run, at, mask = self._cut(size)
            x = mix((blocks[starts[run] + at] & mask) ^ ((at + 8).astype(_U) * _ODD))
            out[i : i + _RUNS] = mix(np.add.reduceat(x, first) + size.astype(_U) * _ODD)
        return out

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the runs a[i] and b[i] have the same bytes."""
        out = np.empty(len(a), dtype=bool)
        blocks = self.texts.blocks()
        for i in range(0, len(a), _RUNS):
            x, y = a[i : i + _RUNS], b[i : i + _RUNS]
            size = self.ends[x] - self.starts[x]
            alike = size == self.ends[y] - self.starts[y]
            left = np.flatnonzero(alike)
            if len(left):
                first, run, at, mask = self._cut(size[left])
                odd = (blocks[self.starts[x[left]][run] + at] ^ blocks[self.starts[y[left]][run] + at]) & mask
                alike[left] = np.bitwise_or.reduceat(odd, first) == 0
            out[i : i + _RUNS] = alike
        return out

    def grams(self, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of its first run, hash) of each n consecutive runs of one text; h: the runs' hashes."""
        room = np.repeat(self.bounds[1:], self.counts()) - np.arange(len(self))
        at = np.flatnonzero(room >= n)
        g = np.full(len(at), n, dtype=_U)
        for k in range(n):
            g = (g ^ h[at + k]) * _ODD
            g ^= g >> _U(29)
        return at, mix(g)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]; 0 where there are none."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def covered(starts: np.ndarray, n: int | np.ndarray, size: int) -> np.ndarray:
    """Which of range(size) lie in some start:start + n."""
    edge = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def sliced(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Pieces of a batch with at most limit bytes of text each, or one row."""
    column = pc.fill_null(batch.column(batch.schema.get_field_index(text)), "")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        lo, hi = int(offsets[at]), int(offsets[to])
        yield batch.slice(at, to - at), Texts(data[lo:hi], offsets[at : to + 1] - lo)
        at = to


_KINDS = {"string": T.StringType, "int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType, "binary": T.BinaryType}


def schema(text: str) -> T.StructType:
    """The struct type of "name kind, ..."; unlike fromDDL it works before a session exists."""
    return T.StructType([T.StructField(n, _KINDS[k]()) for n, k in (x.split() for x in text.split(","))])


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without columns of these names, in any case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def annotate(df: DataFrame, text: str, schema: T.StructType, make: Callable[[], Callable[[Texts], dict]], drop_text: bool = False) -> DataFrame:
    """df with columns added that make()(texts) gives for each slice of its column text, as arrays by name.

    make runs once in each task. Input columns that have a new column's name, in any case, give way to it.
    """
    new = schema.fieldNames()
    taken = {n.lower() for n in new}
    keep = [f for f in df.schema.fields if f.name.lower() not in taken and not (drop_text and f.name == text)]
    if text.lower() in taken:
        raise ValueError(f"a new column can't be named as the text column {text}")
    source = df.select(*[F.col(f"`{f.name}`") for f in keep if f.name != text], F.col(f"`{text}`"))
    names = [f.name for f in keep]
    out = T.StructType([*keep, *schema.fields])
    kinds = {f.name: to_arrow_type(f.dataType) for f in schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for piece, texts in sliced(batch, text):
                found = fn(texts)
                arrays = [piece.column(piece.schema.get_field_index(n)) for n in names]
                arrays += [x if isinstance(x := found[n], pa.Array) else pa.array(x, type=kinds[n]) for n in new]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *new])

    return source.mapInArrow(run, out)


def lists(flat: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column: item i is flat[bounds[i]:bounds[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat, type=kind))


def least(df: DataFrame, group: str, order: list[str], n: int, spread: int = 64) -> DataFrame:
    """Of each group the n rows that come first; the rows of a group are thinned out in `spread` parts before they meet."""
    part, i = "least__part", "least__i"
    thin = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(spread)))
    for keys in ([group, part], [group]):
        thin = thin.withColumn(i, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(i) <= n)
    return thin.drop(part, i)


# Scratch space ---------------------------------------------------------------------------------------------------

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only where it names none and all runs on one machine."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/millrace-scratch/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(sweep)
    _made.append((spark, path))
    return path


def sweep() -> None:
    """Delete what scratch() has named, as far as its session still lives."""
    while _made:
        spark, path = _made.pop()
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session has ended: the folder is the cluster's to clean
            return


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back: it survives lost executors and is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, groups: list[str], order: list[str], rank: str, name: str) -> DataFrame:
    """df with its rows numbered from 0 within each group by order, however large a group is.

    Rows are dealt out by range of (groups, order), so a large group spreads over many tasks; each task numbers its own
    rows and is shifted by what the tasks before it hold of the group. Rows that tie share out their numbers among
    them in any order. Only the columns that df has are moved: give it narrow rows.
    """
    part, own, before, row = f"{rank}__part", f"{rank}__own", f"{rank}__before", f"{rank}__row"
    # The row's own number comes last, so that rows that tie can be dealt to several tasks as well.
    keys = [*(F.col(f"`{c}`").asc_nulls_last() for c in [*groups, *order]), F.col(row).asc()]
    dealt = stored(df.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*keys).withColumn(part, F.spark_partition_id()), name)
    counts = dealt.groupBy(part, *groups).agg(F.count(F.lit(1)).alias(own))
    shift = counts.withColumn(before, F.sum(own).over(Window.partitionBy(*groups).orderBy(part)) - F.col(own))
    shift = shift.select(before, *[F.col(f"`{c}`").alias(f"{rank}__{i}") for i, c in enumerate([part, *groups])])
    numbered = dealt.withColumn(own, F.row_number().over(Window.partitionBy(part, *groups).orderBy(*keys)) - F.lit(1))
    meets = F.lit(True)
    for i, c in enumerate([part, *groups]):
        meets = meets & F.col(f"`{c}`").eqNullSafe(F.col(f"{rank}__{i}"))
    return numbered.join(shift, meets).select(*[F.col(f"`{c}`") for c in df.columns], (F.col(own) + F.col(before)).cast("long").alias(rank))
