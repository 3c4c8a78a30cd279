"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z) and cut into words. A window is `window` consecutive words of a benchmark item; an item with
fewer words, but not none, is one window. Windows of one length form one search: the shift of a block (two words, or one
for windows of one word) says how far the search may jump when the block ends at the current word; a block with shift 0
leads to its bucket of windows that end with it; those whose first block also fits are compared word by word, byte for byte.
The search of a slice of text walks many segments in lockstep, so that each step is one array operation.

The windows of at most about `pattern_bytes` of benchmark text are searched at once (a window's words take some 100 bytes of memory
a byte of text); a larger benchmark, and an item that is larger, is searched in as many passes, whose results are stored
in between and add up, so nothing that is broadcast grows beyond that bound.

Defined results: a null or wordless text has no hits; a null or wordless item has no windows; a null item_id counts as
the empty string; items repeated with one id count once; all document rows are kept, repeated ones each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Runs, Texts, covered, lists, mix, sliced, stored
from .langid import KeyTable

SEGMENT = 512


def _block(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of `size` words that ends at each place."""
    g = h[at]
    if size == 2:
        g = mix(g * np.uint64(0x9E3779B97F4A7C15) + h[at - 1])
    return g.view(np.int64)


class Search:
    """All windows of one length."""

    def __init__(self, length: int, hashes: np.ndarray, phrases: list[bytes], items: list[list[str]]):
        self.length, self.size = length, min(2, length)
        self.hashes, self.phrases, self.items = hashes, phrases, items
        flat = np.ascontiguousarray(hashes).reshape(-1)
        starts = np.arange(len(hashes)) * length
        blocks, shifts = [], []
        for end in range(self.size - 1, length):
            blocks.append(_block(flat, starts + end, self.size))
            shifts.append(np.full(len(hashes), length - 1 - end))
        block, shift = np.concatenate(blocks), np.concatenate(shifts)
        keys, place = np.unique(block, return_inverse=True)
        self.table = KeyTable(keys)
        self.shift = np.full(len(keys) + 1, length - self.size + 1, dtype=np.int64)  # the last: any other block
        np.minimum.at(self.shift, place, shift)
        suffix = np.searchsorted(keys, blocks[-1])
        self.by_suffix = np.argsort(suffix, kind="stable")
        self.bucket = np.searchsorted(suffix[self.by_suffix], np.arange(len(keys) + 1))
        self.prefix = blocks[0]

    def ends(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, block) of the words at which a suffix block stands."""
        heads = np.arange(0, len(h), SEGMENT)
        at = heads + self.length - 1  # segments overlap by a window less one word
        stop = np.minimum(heads + SEGMENT + self.length - 1, len(h))
        found = []
        live = at < stop
        at, stop = at[live], stop[live]
        while len(at):
            block = self.table.find(_block(h, at, self.size))
            shift = self.shift[block]
            hit = shift == 0
            if hit.any():
                found.append((at[hit], block[hit]))
            at = at + np.maximum(shift, 1)
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return none, none
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]).astype(np.int64)

    def matches(self, words: Runs, h: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word, window) of each occurrence."""
        end, block = self.ends(h)
        start = end - self.length + 1
        inside = doc[start] == doc[end]
        start, end, block = start[inside], end[inside], block[inside]
        many = self.bucket[block + 1] - self.bucket[block]
        first = np.repeat(start, many)
        offset = np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
        pattern = self.by_suffix[np.repeat(self.bucket[block], many) + offset]
        fits = _block(h, first + self.size - 1, self.size) == self.prefix[pattern]
        first, pattern = first[fits], pattern[fits]
        for j in range(self.length):
            fits = h[first + j] == self.hashes[pattern, j]
            first, pattern = first[fits], pattern[fits]
        data = words.texts.data
        for a, p in zip(first.tolist(), pattern.tolist(), strict=True):
            if b" ".join(data[words.starts[i] : words.ends[i]].tobytes() for i in range(a, a + self.length)) == self.phrases[p]:
                yield a, p


def windows(items: DataFrame, window: int) -> DataFrame:
    """(item, phrase) of every window of a benchmark (item_id string, text): its words, space between; made on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in sliced(batch, "text"):
                ids = piece.column(0).to_pylist()
                words = texts.lowered().runs(ALNUM)
                data = words.texts.data
                for i in range(len(piece)):
                    own = [data[words.starts[j] : words.ends[j]].tobytes() for j in range(words.bounds[i], words.bounds[i + 1])]
                    every = list(dict.fromkeys(b" ".join(own[j : j + window]) for j in range(max(1, len(own) - window + 1)))) if own else []
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i]] * len(every), type=pa.string()), pa.array(every, type=pa.binary())], names=["item", "phrase"])

    return items.select(F.coalesce("item_id", F.lit("")).alias("item_id"), "text").mapInArrow(run, "item string, phrase binary")


def searches(found: pa.Table) -> list[Search]:
    """The searches for windows (item, phrase)."""
    owners: dict[bytes, set[str]] = {}
    for item, phrase in zip(found.column("item").to_pylist(), found.column("phrase").to_pylist(), strict=True):
        owners.setdefault(phrase, set()).add(item)
    by_length: dict[int, list[bytes]] = {}
    for phrase in sorted(owners):
        by_length.setdefault(phrase.count(b" ") + 1, []).append(phrase)
    out = []
    for length, phrases in sorted(by_length.items()):
        data = np.frombuffer(b"".join(phrases), dtype=np.uint8)
        words = Texts(data, np.concatenate([[0], np.cumsum([len(p) for p in phrases])])).runs(ALNUM)
        out.append(Search(length, words.hashes().reshape(len(phrases), length), phrases, [sorted(owners[p]) for p in phrases]))
    return out


SPAN = T.ArrayType(T.IntegerType())
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("hit_from", SPAN), T.StructField("hit_to", SPAN), T.StructField("items", T.ArrayType(T.StringType()))]


def _pass(df: DataFrame, text: str, found: Broadcast, first: bool) -> DataFrame:
    names = [f.name for f in ADDED]
    keep = [f for f in df.schema.fields if f.name not in names]
    out = T.StructType([*keep, *ADDED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in sliced(batch, text):
                words = texts.lowered().runs(ALNUM)
                h, doc = words.hashes(), words.text_of()
                n = words.counts()
                items: list[set[str]] = [set() for _ in range(len(texts))]
                a: list[int] = []
                length: list[int] = []
                get = lambda c: piece.column(piece.schema.get_field_index(c)).to_pylist()
                if not first:
                    for i, (starts, ends, own) in enumerate(zip(get("hit_from"), get("hit_to"), get("items"), strict=True)):
                        items[i].update(own)
                        a += [words.bounds[i] + x for x in starts]
                        length += [y - x for x, y in zip(starts, ends, strict=True)]
                for s in found.value:
                    for start, p in s.matches(words, h, doc):
                        a.append(start)
                        length.append(s.length)
                        items[doc[start]].update(s.items[p])
                hit = covered(np.array(a, dtype=np.int64), np.array(length, dtype=np.int64), len(words))
                begin = hit.copy()
                begin[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
                end = hit.copy()
                end[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
                b, e = np.flatnonzero(begin), np.flatnonzero(end)
                bounds = np.searchsorted(b, words.bounds)
                base = words.bounds[:-1]
                arrays = [piece.column(piece.schema.get_field_index(f.name)) for f in keep]
                arrays += [
                    pa.array(n.astype(np.int64)),
                    lists((b - base[doc[b]]).astype(np.int32), bounds, pa.int32()),
                    lists((e + 1 - base[doc[e]]).astype(np.int32), bounds, pa.int32()),
                    pa.array([sorted(x) for x in items], type=pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=out.fieldNames())

    return df.mapInArrow(run, out)


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 10, pattern_bytes: int = 2 << 20) -> DataFrame:
    """docs with n_words, hit_from, hit_to (word ranges inside occurrences) and items (ids of items with occurring windows).

    Input columns with these names, in any case, give way.
    """
    names = {f.name for f in ADDED}
    if text_col.lower() in names:
        raise ValueError(f"a result has the name of the text column {text_col}")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    every = stored(windows(items, window), "windows")
    held = every.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    passes = max(1, -(-held // (window * pattern_bytes)))
    sc = docs.sparkSession.sparkContext
    for i in range(passes):
        part = every if passes == 1 else every.filter(F.pmod(F.xxhash64("phrase"), F.lit(passes)) == i)
        out = _pass(out, text_col, sc.broadcast(searches(part.toArrow())), i == 0)
        if i + 1 < passes:
            out = stored(out, f"pass{i}")
    return out


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of what find() gives."""
    n_hit = F.aggregate(F.zip_with("hit_to", "hit_from", lambda x, y: x - y), F.lit(0), lambda x, y: x + y).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
