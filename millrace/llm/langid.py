"""Language ID by prediction by partial matching.

Each language has a tree of byte contexts of up to `order` bytes with frozen counts. The cost of a byte is its exact code
length under PPM with escape method C and no exclusions: the longest context that the tree knows is asked first; a byte
that it has seen n times of T, among D kinds, costs -log2(n / (T + D)); else the escape costs -log2(D / (T + D)) and the
next shorter context is asked; below the empty context a byte costs 8 bits. The language whose tree gives a text the
shortest code wins. Its score is its share of exp(-code length), times how well the text fits the language at all: what a byte costs, against what
it costs in texts of the language (learned from one half of the sample under the trees of the other).

Texts are lower-cased (A-Z) and each run of bytes that are neither ASCII letters nor part of a longer character counts
as one space. The trees are learned from a bounded sample of whole texts and hold every gram of it. Of each language the sample
takes different texts in order of a hash, up to `sample_bytes` shared equally among the languages (one text at least; a text longer
than `long_bytes` only if there are no others); languages are the `most_languages` with the most text. The model's size is linear in these bounds:
languages are kept in groups of GROUP, each with tables of its own grams.

Scoring takes PIECE bytes at a time, so its memory depends neither on a text's length nor on the number of languages.

Defined results: a null text or one without letters is `und` with score 0; so is every text if nothing could be learned.
Ties between languages go to the least name. Rows with a null language or text teach nothing. All rows are kept;
input columns named as a result (lang_pred, score, bits) give way to it.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, annotate, per_text, sliced, stored

_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
_SPACE = 32
#: Bytes that are scored at once.
PIECE = 1 << 16
#: Languages that share tables.
GROUP = 8


class KeyTable:
    """From sorted distinct int64 keys to their places, by open addressing; a lookup is a few array operations."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2 + 1)))))
        size = 1 << (64 - int(self.shift))
        self.mask = size - 1
        self.slots = np.full(size, -1, dtype=np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]  # of those that want one slot, the last stays
            lost = self.slots[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places, -1 where a key is unknown."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int32)
        slot = self._slot(keys)
        out = self.slots[slot]
        wrong = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self.mask
            got = self.slots[slot[wrong]]
            out[wrong] = got
            wrong = wrong[(got >= 0) & (self.keys[got] != keys[wrong])]
        return out


def normalised(texts: Texts, after_letter: bool = False) -> Texts:
    """The texts as they are scored; after_letter: the first text goes on from a part that ended with a letter."""
    low = texts.lowered()
    letter = _LETTER[low.data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    heads = low.offsets[:-1][low.offsets[:-1] < len(letter)]
    keep[heads] = letter[heads]  # no leading space
    if after_letter and len(keep):
        keep[0] = True
    data = np.where(letter, low.data, np.uint8(_SPACE))[keep]
    total = np.zeros(len(keep) + 1, dtype=np.int64)
    np.cumsum(keep, out=total[1:])
    return Texts(data, total[low.offsets])


def gram_keys(texts: Texts, order: int, before: bytes = b"") -> np.ndarray:
    """For each byte, it and the `order` bytes before it, packed; before a text stand spaces, before the first one `before`."""
    lead = np.frombuffer(before.rjust(order), dtype=np.uint8)[len(before.rjust(order)) - order :]
    data = np.concatenate([lead, texts.data]).astype(np.int64)
    key = data[order:].copy()
    heads = texts.offsets[1:-1]
    for j in range(1, order + 1):
        prev = data[order - j : len(data) - j].copy()
        for k in range(j):  # bytes that belong to the text before
            at = heads + k
            prev[at[at < texts.offsets[2:]]] = _SPACE
        key |= prev << (8 * j)
    return key


def _parts(texts: Texts, order: int) -> Iterator[tuple[Texts, int, np.ndarray]]:
    """(normalised part, number of its first text, gram keys); a text longer than PIECE goes on from part to part."""
    tail, letter = b"", False
    for part, i, goes_on in texts.parts(PIECE):
        if not goes_on:
            tail, letter = b"", False
        norm = normalised(part, letter)
        yield norm, i, gram_keys(norm, order, tail)
        last = norm.data[norm.offsets[-2] :].tobytes()
        tail = ((tail if len(part) == 1 else b"") + last)[-order:] if order else b""
        letter = bool(len(part.data)) and bool(_LETTER[part.data[-1] | 32 if 65 <= part.data[-1] <= 90 else part.data[-1]])


#: A text that costs this many times what its language's texts cost a byte has half of the score; bits that aren't counted.
FAR, SPARE = 1.5, 512.0


@dataclass
class Model:
    """keys[k]: grams of k + 1 bytes; cost[k][gram, language] in bits; escape[k][gram, language]: of the gram as a context."""

    languages: list[str]
    order: int
    tables: list[KeyTable]
    cost: list[np.ndarray]
    escape: list[np.ndarray]
    #: Bits a byte that a text of each language costs.
    typical: np.ndarray | None = None

    def bits(self, keys: np.ndarray, k: int) -> np.ndarray:
        """[gram, language] code lengths of the last bytes of grams of k + 1 bytes."""
        if k < 0:
            return np.full((len(keys), len(self.languages)), 8.0, dtype=np.float32)
        at = self.tables[k].find(keys)
        known = at >= 0
        if known.all():
            return self.cost[k][at]
        out = np.empty((len(keys), len(self.languages)), dtype=np.float32)
        out[known] = self.cost[k][at[known]]
        out[~known] = self.below(keys[~known], k)
        return out

    def below(self, keys: np.ndarray, k: int) -> np.ndarray:
        """What a gram costs if no tree has it at this length."""
        if k == 0:
            return self.root + self.bits(keys, -1)
        rest = self.bits(keys & ((1 << (8 * k)) - 1), k - 1)
        context = self.tables[k - 1].find(keys >> 8)
        known = context >= 0
        rest[known] += self.escape[k - 1][context[known]]
        return rest

    root: np.ndarray | float = 0.0


def _build(counts: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]], languages: list[str], order: int) -> Model:
    """counts[k][language]: grams of k + 1 bytes and how often each was seen."""
    m = Model(languages, order, [], [], [])
    every: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
    for k in range(order, -1, -1):  # contexts that reach back before a text are no grams of it, but are asked for
        every.insert(0, np.unique(np.concatenate([*(x[0] for x in counts.get(k, {}).values()), every[0] >> 8])))
    for k in range(order + 1):
        seen, keys = counts.get(k, {}), every[k]
        n = np.zeros((len(keys), len(languages)))
        for j, name in enumerate(languages):
            if name in seen:
                n[np.searchsorted(keys, seen[name][0]), j] = seen[name][1]
        if k == 0:
            total, kinds = n.sum(0)[None, :].repeat(len(keys), 0), (n > 0).sum(0)[None, :].repeat(len(keys), 0)
            t, d = n.sum(0), (n > 0).sum(0)
            m.root = np.where(d > 0, -np.log2(np.maximum(d, 1) / np.maximum(t + d, 1)), 0).astype(np.float32)
        else:
            context = m.tables[k - 1].find(keys >> 8)
            t = np.zeros((len(m.tables[k - 1].keys), len(languages)))
            d = np.zeros_like(t)
            np.add.at(t, context, n)
            np.add.at(d, context, n > 0)
            m.escape.append(np.where(d > 0, -np.log2(np.maximum(d, 1) / np.maximum(t + d, 1)), 0).astype(np.float32))
            total, kinds = t[context], d[context]
        m.tables.append(KeyTable(keys))
        m.cost.append(np.zeros((len(keys), len(languages)), dtype=np.float32))
        own = -np.log2(np.maximum(n, 1) / np.maximum(total + kinds, 1))
        m.cost[k] = np.where(n > 0, own, m.below(keys, k)).astype(np.float32)
    return m


def sample(docs: DataFrame, text_col: str, lang_col: str, sample_bytes: int, long_bytes: int, most_languages: int) -> DataFrame:
    """(lang, text) of the sample.

    Texts are taken by 64 x 64 classes of their hash, finer towards 0, so that how many classes fit follows from sums
    by language and class: no language's texts meet in one task, and copies count once.
    """
    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).dropna()
    h = F.xxhash64("text")
    rows = rows.withColumn("h", h).withColumn("bytes", F.octet_length("text").cast("long"))
    shrunk = F.floor(F.log2(F.shiftrightunsigned("h", 1).cast("double") + 2.0) * 64).cast("int")
    rows = rows.withColumn("class", shrunk + F.when(F.col("bytes") > long_bytes, 1 << 13).otherwise(0))
    single = rows.groupBy("lang", "class", "h").agg(F.min("bytes").alias("bytes"))
    sums = stored(single.groupBy("lang", "class").agg(F.sum("bytes").alias("bytes"), F.min("h").alias("one")), "sample")
    known = sums.groupBy("lang").agg(F.sum("bytes").alias("held")).orderBy(F.desc("held"), "lang").limit(most_languages).select("lang")
    share = sample_bytes // max(1, known.count())
    so_far = Window.partitionBy("lang").orderBy("class")
    sums = sums.join(F.broadcast(known), "lang").withColumns({"upto": F.sum("bytes").over(so_far), "i": F.row_number().over(so_far)})
    # A class that alone is above the share gives one text.
    taken = sums.filter((F.col("upto") <= share) | (F.col("i") == 1)).groupBy("lang").agg(F.max("class").alias("last"), F.max(F.when(F.col("upto") > share, F.col("one"))).alias("only"))
    taken = stored(taken.withColumnRenamed("lang", "of"), "taken")
    met = rows.join(F.broadcast(taken), (F.col("lang") == F.col("of")) & (F.col("class") <= F.col("last")) & (F.col("only").isNull() | (F.col("only") == F.col("h"))))
    return met.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = 4, sample_bytes: int = 2 << 20, long_bytes: int = 1 << 16, most_languages: int = 512) -> list[Model]:
    """The trees of all languages that docs names, GROUP languages a model. Counting runs on the executors; the driver gets the frozen counts."""
    chosen = sample(docs, text_col, lang_col, sample_bytes, long_bytes, most_languages)
    chosen = stored(chosen.withColumn("half", F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(2)).cast("int")), "halves")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in sliced(batch, "text"):
                names = piece.column(0).dictionary_encode()
                index = np.asarray(names.indices) * 2 + np.asarray(piece.column(2))
                for norm, i, full in _parts(texts, order):
                    which = np.repeat(index[i : i + len(norm)], np.diff(norm.offsets))
                    for j in np.unique(which).tolist():
                        mine = full[which == j]
                        for k in range(order + 1):
                            grams, n = np.unique(mine & ((1 << (8 * (k + 1))) - 1), return_counts=True)
                            name = names.dictionary[j // 2].as_py()
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array([j % 2] * len(grams), pa.int32()), pa.array([k] * len(grams), pa.int32()), pa.array(grams), pa.array(n.astype(np.int64))], names=["lang", "half", "k", "gram", "n"])

    seen = chosen.mapInArrow(count, "lang string, half int, k int, gram long, n long").groupBy("lang", "half", "k", "gram").agg(F.sum("n").alias("n"))
    got = seen.toArrow()
    half = got.column("half").to_numpy()
    cost = _typical(chosen, _models(got.filter(pa.array(half == 0)), order)) if (half == 0).any() else {}
    models = _models(got, order)
    for m in models:
        m.typical = np.array([cost.get(x, np.inf) for x in m.languages])
    return models


def _models(got: pa.Table, order: int) -> list[Model]:
    """The frozen trees of rows (lang, k, gram, n); a gram may have several."""
    names, lang = np.unique(got.column("lang").to_numpy().astype(object), return_inverse=True) if len(got) else (np.zeros(0, dtype=object), np.zeros(0, dtype=int))
    k, gram, n = (got.column(c).to_numpy() for c in ("k", "gram", "n"))
    by_bytes = sorted(range(len(names)), key=lambda i: names[i].encode())
    models = []
    for g in range(0, len(names), GROUP):
        counts: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]] = {}
        for i in by_bytes[g : g + GROUP]:
            for o in range(order + 1):
                at = np.flatnonzero((lang == i) & (k == o))
                grams, place = np.unique(gram[at], return_inverse=True)
                counts.setdefault(o, {})[names[i]] = grams, np.bincount(place, n[at], minlength=len(grams)).astype(np.int64)
        models.append(_build(counts, [names[i] for i in by_bytes[g : g + GROUP]], order))
    return models


def _typical(chosen: DataFrame, models: list[Model]) -> dict[str, float]:
    """Bits a byte that the texts of a language cost under its tree, on the half of the sample that the models haven't seen."""
    shared = chosen.sparkSession.sparkContext.broadcast(models)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x for m in shared.value for x in m.languages]
        place = {x: i for i, x in enumerate(names)}
        for batch in batches:
            for piece, texts in sliced(batch, "text"):
                bits, size, _ = code_lengths(texts, shared.value)
                own = [(x, float(bits[i, place[x]]), int(size[i])) for i, x in enumerate(piece.column(0).to_pylist()) if x in place]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in own], type=kind) for j, kind in enumerate((pa.string(), pa.float64(), pa.int64()))], names=["lang", "bits", "size"])

    rows = chosen.filter("half = 1").mapInArrow(run, "lang string, bits double, size long").groupBy("lang").agg(F.sum("bits").alias("bits"), F.sum("size").alias("size")).filter("size > 0")
    return {r.lang: r.bits / r["size"] for r in rows.collect()}  # at most most_languages rows


def _has_letter(raw: bytes) -> bool:
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    return any(any(map(str.isalpha, reader.decode(raw[i : i + PIECE]))) for i in range(0, len(raw), PIECE))


def code_lengths(texts: Texts, models: list[Model]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """([text, language] code lengths in bits, each text's bytes, its ASCII letters), of the normalised texts."""
    width = [len(m.languages) for m in models]
    total = np.zeros((len(texts), sum(width)))
    size, ascii_letters = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    for norm, i, keys in _parts(texts, models[0].order):
        own = slice(i, i + len(norm))
        size[own] += np.diff(norm.offsets)
        ascii_letters[own] += per_text((norm.data >= 97) & (norm.data <= 122), norm.offsets)
        at = 0
        for m, w in zip(models, width, strict=True):
            if len(keys):
                total[own, at : at + w] += per_text(m.bits(keys, m.order), norm.offsets)
            at += w
    return total, size, ascii_letters


def score(texts: Texts, models: list[Model]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the language or -1, score, bits a byte) of each text.

    The score is the language's share among the languages, by their code lengths, times how well the text fits it at all: 1 where it costs what texts of the language cost,
    1/2 at FAR times that, SPARE bits more or less for what any short text may cost, and near 0 for other scripts, random letters and texts of which half is in another language.
    """
    n = len(texts)
    if not models:
        return np.full(n, -1), np.zeros(n), np.zeros(n)
    total, size, ascii_letters = code_lengths(texts, models)
    best = total.argmin(1)
    low = total.min(1)
    share = 1 / np.exp2(np.maximum(low[:, None] - total, -1000)).sum(1)
    bits = low / np.maximum(size, 1)
    typical = np.concatenate([np.full(len(m.languages), np.inf) if m.typical is None else m.typical for m in models])[best]
    ratio = np.where(np.isfinite(typical), np.maximum(low - SPARE, 0) / np.maximum(size * typical, 1e-9), 0.0)
    share = share / (1 + np.exp(np.clip((ratio - FAR) / 0.08, -50, 50)))
    # A text whose letters, if any, are all beyond ASCII is looked at by character: most signs there aren't letters.
    none = size == 0
    for i in np.flatnonzero((ascii_letters == 0) & ~none):
        none[i] = not _has_letter(texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes())
    return np.where(none, -1, best), np.where(none, 0.0, share), np.where(none, 0.0, bits)


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType())])


def predict(docs: DataFrame, models: list[Model], text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score and bits (code length a byte under the best language's tree)."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by train's sample_bytes

    def make():
        models = shared.value
        names = np.array([*(x for m in models for x in m.languages), "und"], dtype=object)

        def run(texts: Texts) -> dict:
            which, share, bits = score(texts, models)
            return {"lang_pred": names[which], "score": share, "bits": bits}

        return run

    return annotate(docs, text_col, RESULT, make)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5, is 0; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
