"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index.

Terms are lower-cased (A-Z) words and their prefixes of 4, 5 and 6 bytes, so that inflected forms of a word share
terms; every term of the examples is in the index. Examples and texts are vectors of (1 + ln tf) * idf * lift over them, of length 1;
lift = (G2 / (G2 + half_lift)) ** 2, with G2 the likelihood ratio of the term between the classes, lies between 0 and 1 and sets no term
to nothing unless the classes have it equally often. The k examples of greatest cosine vote, each with
cosine ** sharpness times the weight of its class, against a prior of weight `prior_weight`, the share of toxic rows. A class's
weight is its labelled rows over its examples, so the sample's balance doesn't shift the scores. Votes become scores by a logistic map, fitted to
the votes that examples get from an index of the other folds (see calibration), so that of rows that score s about s are toxic.

The index keeps, for each term, its postings by blocks of BLOCK examples and its greatest weight in each block. The FIRST blocks of a text
in order of their bounds are compared, and then those whose bounds reach the k-th cosine found, so the neighbours are exact. Of equal
cosines the lower place in the index wins. Texts are taken AT_ONCE together, so that each step is an array operation. The most
frequent terms, which have most of the postings that a text meets, stand in a block as dense rows, so that a block's part of many texts' cosines
is one product of matrices; the rows take WIDE * 8 bytes an example at most.

Examples are at most `rows_per_class` different whole labelled texts of each class, those with the least text hash, texts
longer than `long_bytes` last: both bound the index.

Defined results: a text without known terms (null and empty ones too) scores the prior; without labelled rows of both classes every
score is the share of toxic rows, or 0; a label that repeats counts once, toxic if any says so; labels that aren't 0 or 1, or null, teach
nothing. All rows are kept; input columns named as a result (score, evidence) give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Runs, Texts, annotate, least, lists, sliced, stored
from .langid import KeyTable

BLOCK = 64
#: Texts that are compared at once.
AT_ONCE = 48
#: Blocks of a text that are compared before the k-th cosine is looked at; those of the rest that may hold a neighbour follow at once.
FIRST = 2
#: The most frequent terms, at most WIDE and each in one of WIDE_PART examples at least, have a dense row in each block; the others have postings.
WIDE, WIDE_PART = 1024, 24
#: Cosines that differ by less than this rank as equal: the order in which a product is summed shows in its last bits.
FINE = 2.0**-40
PREFIXES = (4, 5, 6)


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(term hash, text) of every word and prefix."""
    words = texts.lowered().runs(ALNUM)
    doc = words.text_of()
    out, docs = [words.hashes()], [doc]
    for k in PREFIXES:
        long = words.ends - words.starts > k
        part = Runs(words.texts, words.starts[long], words.starts[long] + k, words.bounds)
        out.append(part.hashes() ^ np.uint64(k))
        docs.append(doc[long])
    return np.concatenate(out).view(np.int64), np.concatenate(docs)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, element) for the elements of the ranges lo[i]:hi[i], one after another."""
    some = np.flatnonzero(hi > lo)
    if not len(some):
        return some, some
    lo, hi = lo[some], hi[some]
    ends = np.cumsum(hi - lo)
    # Sums of steps: repeating each range's number costs far more where ranges are short.
    which, element = np.zeros(ends[-1], dtype=np.int64), np.ones(ends[-1], dtype=np.int64)
    which[0], element[0] = some[0], lo[0]
    which[ends[:-1]], element[ends[:-1]] = np.diff(some), lo[1:] - hi[:-1] + 1
    return np.cumsum(which, out=which), np.cumsum(element, out=element)


@dataclass
class Index:
    """Examples in index order, and what a query needs of them."""

    vocabulary: KeyTable
    scale: np.ndarray
    toxic: np.ndarray
    weight: np.ndarray
    names: list
    prior: float
    k: int
    sharpness: float
    prior_weight: float
    slope: float = 1.0
    shift: float = 0.0

    def build(self, term: np.ndarray, example: np.ndarray, value: np.ndarray) -> None:
        """Postings: the term at place term[i] has weight value[i] in example[i]."""
        n, self.blocks = len(self.toxic), -(-len(self.toxic) // BLOCK)
        held = np.bincount(term, minlength=len(self.scale))
        wide = np.argsort(-held, kind="stable")[:WIDE]
        wide = np.sort(wide[held[wide] * WIDE_PART >= max(1, n)])
        self.row = np.full(len(self.scale), -1, dtype=np.int32)
        self.row[wide] = np.arange(len(wide))
        tall = self.row[term] >= 0
        self.tiles = np.zeros((self.blocks, len(wide), BLOCK))
        self.tiles[example[tall] // BLOCK, self.row[term[tall]], example[tall] % BLOCK] = value[tall]
        self.wide_most = np.ascontiguousarray(self.tiles.max(axis=2).T)
        term, example, value = term[~tall], example[~tall], value[~tall]
        order = np.lexsort((example, term))
        term, self.example, self.value = term[order], example[order].astype(np.int32), value[order]
        # Runs of postings of one term in one block, and where each term's runs begin.
        key = term * max(1, self.blocks) + self.example // BLOCK
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
        self.run_begin = np.append(first, len(key))
        self.run_block = (self.example[first] // BLOCK).astype(np.int64)
        self.run_most = np.maximum.reduceat(self.value, first) if len(first) else np.zeros(0)
        self.term_begin = np.searchsorted(term[first], np.arange(len(self.scale) + 1))

    def nearest(self, bounds: np.ndarray, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """[text, example] cosines, of every example that may be among the k nearest; -1 elsewhere. Text i has the terms at[bounds[i]:bounds[i + 1]] with weights q."""
        n, blocks = len(bounds) - 1, self.blocks
        width = blocks * BLOCK
        out = np.full((n, width), -1.0)
        text, row = np.repeat(np.arange(n), np.diff(bounds)), self.row[at]
        tall = row >= 0
        wide = np.zeros((n, self.tiles.shape[1]))
        wide[text[tall], row[tall]] = q[tall]
        text, at, q = text[~tall], at[~tall], q[~tall]
        entry, run = _ranges(self.term_begin[at], self.term_begin[at + 1])
        weight = q[entry]
        pair = (text * blocks)[entry] + self.run_block[run]
        most = wide @ self.wide_most + np.bincount(pair, weight * self.run_most[run], minlength=n * blocks).reshape(n, blocks)
        ranked = np.argsort(-most, axis=1, kind="stable")
        bound = np.take_along_axis(most, ranked, axis=1)
        kth, done = np.full(n, -1.0), 0
        for step in (FIRST, blocks):
            if done and width > self.k:
                kth = np.partition(out, -self.k, axis=1)[:, -self.k]
            near = bound[:, done : done + step]
            chosen = np.zeros((n, blocks), dtype=bool)
            np.put_along_axis(chosen, ranked[:, done : done + step], (near > 0) & (near >= kth[:, None] - 1e-9), axis=1)
            for b in np.flatnonzero(chosen.any(axis=0)).tolist():
                some = np.flatnonzero(chosen[:, b])
                out[some, b * BLOCK : (b + 1) * BLOCK] = (wide if len(some) == n else wide[some]) @ self.tiles[b]
            own = np.flatnonzero(chosen.reshape(-1)[pair])
            of, posting = _ranges(self.run_begin[run[own]], self.run_begin[run[own] + 1])
            slot = (pair[own] // blocks * width)[of] + self.example[posting]
            out += np.bincount(slot, weight[own][of] * self.value[posting], minlength=n * width).reshape(n, width)
            done += step
        return out[:, : len(self.toxic)]

    def vectors(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bounds, term places, weights): the vectors of the texts, one after another."""
        h, doc = terms(texts)
        at = self.vocabulary.find(h)
        known = at >= 0
        width = max(1, len(self.scale))
        key, tf = np.unique(doc[known] * width + at[known], return_counts=True)
        return self.weighed(key % width, key // width, tf, len(texts))

    def weighed(self, at: np.ndarray, doc: np.ndarray, tf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same from entries: text doc[j] of n, in order, has the term at place at[j] tf[j] times."""
        w = (1 + np.log(tf)) * self.scale[at]
        norm = np.sqrt(np.bincount(doc, w * w, minlength=n))
        fits = w > 0
        return np.searchsorted(doc[fits], np.arange(n + 1)), at[fits], (w[fits] / norm[doc[fits]])

    def vote(self, term: np.ndarray, row: np.ndarray, tf: np.ndarray, n: int) -> tuple[np.ndarray, list[list]]:
        """(uncalibrated scores, evidence) of n texts given by their terms, in order of row."""
        at = self.vocabulary.find(term)
        known = at >= 0
        return self.polled(*self.weighed(at[known], row[known], tf[known], n))

    def votes(self, cosines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores, places and cosines of the k nearest, best first) of rows of cosines."""
        near = np.argsort(-np.rint(cosines / FINE), axis=1, kind="stable")[:, : self.k]
        cosine = np.maximum(np.take_along_axis(cosines, near, axis=1), 0.0)
        vote = cosine**self.sharpness * self.weight[near]
        total = vote.sum(1) + self.prior_weight
        return ((vote * self.toxic[near]).sum(1) + self.prior_weight * self.prior) / total, near, cosine

    def score(self, texts: Texts) -> tuple[np.ndarray, list[list]]:
        raw, evidence = self.polled(*self.vectors(texts))
        return self.calibrated(raw), evidence

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        """Votes as shares of toxic rows; what only the prior speaks for stays the prior."""
        p = np.clip(raw, 1e-4, 1 - 1e-4)
        out = 1 / (1 + np.exp(-(self.slope * np.log(p / (1 - p)) + self.shift)))
        return np.where(raw == self.prior, self.prior, out)

    def polled(self, bounds: np.ndarray, at: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, list[list]]:
        """(votes, evidence) of the texts with these vectors."""
        n = len(bounds) - 1
        out = np.full(n, self.prior)
        evidence: list[list] = [[]] * n
        some = np.flatnonzero(np.diff(bounds)) if len(self.toxic) else np.zeros(0, dtype=np.int64)
        for i in range(0, len(some), AT_ONCE):
            own = some[i : i + AT_ONCE]
            _, e = _ranges(bounds[own], bounds[own + 1])
            cosines = self.nearest(np.append(0, np.cumsum(np.diff(bounds)[own])), at[e], w[e])
            out[own], near, cosine = self.votes(cosines)
            for j, text in enumerate(own.tolist()):
                evidence[text] = [self.names[x] for x, c in zip(near[j, :3].tolist(), cosine[j, :3].tolist(), strict=True) if c > 0]
        return out, evidence


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 4, is 2; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def likelihood_ratio(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    """G squared of each term that a of n_a and b of n_b examples have."""
    out = np.zeros(len(a))
    n = n_a + n_b
    for x, row, col in ((a, n_a, a + b), (b, n_b, a + b), (n_a - a, n_a, n - a - b), (n_b - b, n_b, n - a - b)):
        with np.errstate(divide="ignore", invalid="ignore"):
            out += np.where(x > 0, 2 * x * np.log(x * n / (row * np.maximum(col, 1))), 0)
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows_per_class: int = 500, long_bytes: int = 1 << 16, half_lift: float = 40.0, k: int = 25, sharpness: float = 4.0, prior_weight: float = 0.5) -> Index:
    """The index of docs' labelled texts; labels: rows (id, label 0 or 1)."""
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).dropna().filter("y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    hashed = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("h"), (F.octet_length(f"`{text_col}`") > long_bytes).alias("long")).join(marks, "id")
    hashed = stored(hashed, "labelled")
    # One row of each text: copies would fill the sample.
    single = hashed.groupBy("y", "h", F.coalesce("long", F.lit(False)).alias("long")).agg(F.min("id").alias("id"))
    chosen = stored(least(single, "y", ["long", "h", "id"], rows_per_class).select(F.col("id").alias("chosen__id"), F.col("h").alias("chosen__h"), "y"), "chosen")
    counts = {r["y"]: r["n"] for r in hashed.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("h"), F.col(f"`{text_col}`").alias("text"))
    met = rows.join(F.broadcast(chosen), (F.col("id") == F.col("chosen__id")) & (F.col("h") == F.col("chosen__h")))  # chosen: 2 x rows_per_class rows at most
    some = met.groupBy("id", "h", "y").agg(F.first("text").alias("text")).drop("h")  # a row that is repeated counts once

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in sliced(batch, "text"):
                h, doc = terms(texts)
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, dtype=np.int64)
                tf = np.diff(np.append(first, len(h)))
                bounds = np.searchsorted(doc[first], np.arange(len(piece) + 1))
                cols = [piece.column(piece.schema.get_field_index(c)) for c in ("id", "y")]
                yield pa.RecordBatch.from_arrays([*cols, lists(h[first], bounds, pa.int64()), lists(tf, bounds, pa.int64())], names=["id", "y", "term", "tf"])

    many = T.ArrayType(T.LongType())
    kind = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("y", T.IntegerType()), T.StructField("term", many), T.StructField("tf", many)])
    held = sum(counts.values())
    share = counts.get(1, 0) / held if held else 0.0
    none = np.zeros(0, dtype=np.int64)
    empty = Index(KeyTable(none), np.zeros(0), np.zeros(0), np.zeros(0), [], share, k, sharpness, prior_weight)
    empty.build(none, none, np.zeros(0))
    got = some.mapInArrow(count, kind).toArrow().combine_chunks()  # the bounded sample
    y, size = got.column("y").to_numpy(), np.array([len(x) for x in got.column("term")])
    if not (y == 0).any() or not (y == 1).any():
        return empty
    flat, tf = (np.concatenate([np.asarray(x.flatten()) for x in got.column(c).chunks]) for c in ("term", "tf"))
    sample = Sample(y, np.array([str(x) for x in got.column("id").to_pylist()], dtype=object), np.repeat(np.arange(len(y)), size), flat, tf)
    how = {"counts": counts, "half_lift": half_lift, "k": k, "sharpness": sharpness, "prior_weight": prior_weight}
    out = fit(sample, **how)
    out.slope, out.shift = calibration(sample, how, unseen(docs.sparkSession, sample, how))
    return out


@dataclass
class Sample:
    """Labelled examples: label y and name of each; entry j says that example row[j] has the term[j] tf[j] times."""

    y: np.ndarray
    names: np.ndarray
    row: np.ndarray
    term: np.ndarray
    tf: np.ndarray

    def part(self, of: np.ndarray) -> Sample:
        at = np.cumsum(of) - 1
        own = of[self.row]
        return Sample(self.y[of], self.names[of], at[self.row[own]], self.term[own], self.tf[own])


def fit(sample: Sample, counts: dict[int, int], half_lift: float, k: int, sharpness: float, prior_weight: float) -> Index:
    """The index of a sample with both classes; counts: labelled rows of each class."""
    y, row, tf = sample.y, sample.row, sample.tf
    held = sum(counts.values())
    term, place = np.unique(sample.term, return_inverse=True)
    n0, n1 = (np.bincount(place[y[row] == c], minlength=len(term)).astype(float) for c in (0, 1))
    weigh = {c: counts[c] / (y == c).sum() for c in (0, 1)}
    ratio = likelihood_ratio(n1, n0, (y == 1).sum(), (y == 0).sum())
    scale = np.log((1 + held) / (n0 * weigh[0] + n1 * weigh[1])) * (ratio / (ratio + half_lift)) ** 2
    value = (1 + np.log(tf)) * scale[place]
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(y)))
    value = value / np.maximum(norm[row], 1e-300)
    # Examples with the same most frequent term, and then the same heaviest one, stand together, so that blocks have telling bounds.
    df = np.bincount(place)
    leading = [np.full(len(y), -1), np.full(len(y), -1)]
    for lead, by in zip(leading, (df[place] * tf, value), strict=True):
        order = np.lexsort((place, by, row))
        last = np.flatnonzero(np.append(row[order][1:] != row[order][:-1], True)) if len(row) else np.zeros(0, dtype=np.int64)
        lead[row[order][last]] = place[order][last]
    ranks = np.lexsort((sample.names.astype(str), y, leading[1], leading[0]))
    index_of = np.empty(len(y), dtype=np.int64)
    index_of[ranks] = np.arange(len(y))
    out = Index(KeyTable(term), scale, y[ranks].astype(float), np.array([weigh[c] for c in y[ranks]]), [sample.names[i] for i in ranks], counts[1] / held, k, sharpness, prior_weight)
    fits = value > 0
    out.build(place[fits], index_of[row[fits]], value[fits])
    return out


FOLDS = 5


def unseen(spark: SparkSession, sample: Sample, how: dict) -> np.ndarray:
    """The vote that each example gets from an index of the other folds, not a number where those lack a class.

    The examples are dealt into folds in the order of their names, each in a task of its own.
    """
    fold = np.argsort(np.argsort(sample.names.astype(str), kind="stable"), kind="stable") % FOLDS
    shared = spark.sparkContext.broadcast((sample, how, fold))  # the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, how, fold = shared.value
        for batch in batches:
            for f in batch.column(0).to_pylist():
                own, rest = sample.part(fold == f), sample.part(fold != f)
                if (rest.y == 0).any() and (rest.y == 1).any() and len(own.y):
                    votes = fit(rest, **how).vote(own.term, own.row, own.tf, len(own.y))[0]
                    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(fold == f)), pa.array(votes)], names=["place", "vote"])

    kind = T.StructType([T.StructField("place", T.LongType()), T.StructField("vote", T.DoubleType())])
    got = spark.range(0, FOLDS, 1, FOLDS).mapInArrow(run, kind).toArrow()  # a row for each example
    shared.destroy()
    out = np.full(len(sample.y), np.nan)
    out[got.column("place").to_numpy()] = got.column("vote").to_numpy()
    return out


def calibration(sample: Sample, how: dict, raw: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic map from votes to the share of toxic rows, fitted to raw, votes of examples that weren't in the index.

    Rows weigh as much as they stand for; targets are smoothed by the classes' sizes, and the slope is held to its start by one row, so that few examples change little.
    """
    known = np.isfinite(raw)
    y, raw = sample.y[known], np.clip(raw[known], 1e-4, 1 - 1e-4)
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    if not n0 or not n1:
        return 1.0, 0.0
    weight = np.where(y == 1, how["counts"][1] / n1, how["counts"][0] / n0)
    weight *= len(y) / weight.sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([np.log(raw / (1 - raw)), np.ones(len(raw))], axis=1)
    start = np.array([1.0, 0.0])
    w = start.copy()
    for _ in range(50):  # Newton's steps
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (weight * (p - goal)) + (w - start)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2), slope)
        w = w - np.clip(step, -1, 1)
    return max(float(w[0]), 0.05), float(w[1])


RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.StringType()))])


def score(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """docs with score and evidence, the ids of the three nearest examples."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by rows_per_class and long_bytes

    def make():
        index = shared.value

        def run(texts: Texts) -> dict:
            value, evidence = index.score(texts)
            return {"score": value, "evidence": evidence}

        return run

    return annotate(docs, text_col, RESULT, make)
