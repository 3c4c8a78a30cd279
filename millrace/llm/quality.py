"""Quality rules, and distribution divergence from language references.

References are learned from all rows with a language and a text: per language, the shares of character classes, and the
shares of its common words (those that make up at least `common_share` of its words). A document is compared with every
reference by Jensen-Shannon distance (base 2, 0 to 1) and keeps the least of each kind. Guards: the class distance needs
`min_chars` characters in words and the word distance `min_words` words; a reference needs `reference_words` words. What a
guard turns away passes.

Common words are a part of a language's words only, so a text without any of them is not at distance 1 but at the
reference's reach. The limit of the word distance is therefore a share of the reach, `far_share`, or for short texts what
chance explains, up to `most_share` of the reach (see word_limits); `max_word_distance` holds in any case.

Common words are found exactly in bounded memory: a word with a share of all of a language's words has at least that
share in some batch of it, so the words that reach it in some batch are the candidates, and only they are counted.

Defined results: a null or empty text has no words and fails the base rule; with no reference nothing fails by distance
(the distances are null); languages beyond the `most_languages` with the most words have no reference, their documents are compared with the others'; rows and repeated rows are all kept; columns named as a result give way.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ALNUM, NOSPACE, SLICE_BYTES, Runs, Texts, annotate, covered, per_text, sliced, stored
from .langid import KeyTable

#: ASCII classes, and beyond ASCII the Unicode blocks that a first byte of UTF-8, from the given one on, opens.
ASCII = ("lower", "upper", "digit", "space", "punctuation", "symbol")
BLOCKS = ((0xC0, "marks"), (0xC3, "latin"), (0xCB, "marks"), (0xCD, "greek"), (0xD0, "cyrillic"), (0xD4, "hebrew"), (0xD8, "arabic"), (0xE0, "indic"), (0xE2, "marks"), (0xE3, "kana"), (0xE4, "han"), (0xEA, "hangul"), (0xEE, "other"))
CLASSES = (*ASCII, *sorted({name for _, name in BLOCKS}))
SYMBOLS = b"#*$%&|<>"


def _class(b: int) -> int:
    c = chr(b)
    if 128 <= b < 192:
        return len(CLASSES)  # inside a character
    if b >= 192:
        return CLASSES.index([name for least, name in BLOCKS if least <= b][-1])
    if b in SYMBOLS:
        return 5
    for k, test in enumerate((str.islower, str.isupper, str.isdigit, str.isspace)):
        if test(c):
            return k
    return 4


CLASS_OF = np.array([_class(b) for b in range(256)], dtype=np.int64)
INNER = np.array([128 <= b < 192 for b in range(256)])
SYMBOL = np.array([b in SYMBOLS for b in range(256)])
LINE = np.array([b != 10 for b in range(256)])


def class_counts(texts: Texts) -> np.ndarray:
    """[text, class] characters."""
    width = len(CLASSES) + 1
    out = np.zeros((len(texts), width), dtype=np.int64)
    for part, i, _ in texts.parts(SLICE_BYTES):
        n = len(part)
        key = np.repeat(np.arange(n) * width, np.diff(part.offsets)) + CLASS_OF[part.data]
        out[i : i + n] += np.bincount(key, minlength=n * width).reshape(n, width)
    return out[:, :-1]


def _twins(runs: Runs, groups: np.ndarray, h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, equal, doubt): items sorted by group and hash; whether each equals the one before it; groups with a hash that stands for different bytes.

    Item i is the runs first[i] to first[i] + width - 1; hashes only propose, the bytes decide.
    """
    order = np.lexsort((h, groups))
    equal = np.zeros(len(order), dtype=bool)
    if len(order) < 2:
        return order, equal, np.zeros(0, dtype=np.int64)
    near = np.flatnonzero((h[order[1:]] == h[order[:-1]]) & (groups[order[1:]] == groups[order[:-1]])) + 1
    a, b = first[order[near - 1]], first[order[near]]
    alike = np.ones(len(near), dtype=bool)
    for k in range(width):
        alike &= runs.same(a + k, b + k)
    equal[near[alike]] = True
    return order, equal, np.unique(groups[order[near[~alike]]])


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The rules' counts of each text."""
    words = texts.runs(NOSPACE)
    n = words.counts()
    h = words.hashes()
    at, grams = words.grams(h, 3)
    doc = words.text_of()
    order, equal, doubt = _twins(words, doc[at], grams, at, 3)
    twin = equal.copy()
    twin[:-1] |= equal[1:]
    repeated = per_text(covered(at[order[twin]], 3, len(words)), words.bounds)
    lines = texts.runs(LINE)
    # A line with a word: the first word that ends after the line's start begins before its end.
    word = np.searchsorted(words.ends, lines.starts, "right")
    filled = np.flatnonzero(np.append(words.starts, len(texts.data))[word] < lines.ends)
    own = lines.text_of()[filled]
    line_order, earlier, more_doubt = _twins(lines, own, lines.hashes()[filled], filled, 1)
    dup = np.bincount(own[line_order[earlier]], minlength=len(texts)).astype(np.int64)
    for i in {*doubt.tolist(), *more_doubt.tolist()}:  # different bytes under one hash: count them plainly
        repeated[i], dup[i] = _plain_repeats(texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes())
    return {
        "n_words": n.astype(np.int64),
        "word_chars": texts.count(NOSPACE & ~INNER),
        "n_symbols": texts.count(SYMBOL),
        "n_dup_lines": dup,
        "n_repeat_words": repeated,
    }


def _plain_repeats(text: bytes) -> tuple[int, int]:
    """(words in repeated windows of 3, repeated lines) of one text."""
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", text) if x]
    seen = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return len(inside), len(lines) - len(set(lines))


@dataclass
class References:
    """classes[language, class]: shares; common[language]: (word hashes sorted, shares) of its common words."""

    languages: list[str]
    classes: np.ndarray
    common: list[tuple[np.ndarray, np.ndarray]]


def _by_language(docs: DataFrame, text_col: str, lang_col: str, fields: str, fn: Callable[[Texts], Iterator[tuple]]) -> DataFrame:
    """Rows (lang, fields...) that fn gives for the texts of one language of a slice."""
    schema = T.StructType.fromDDL(f"lang string, {fields}")
    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            number = np.asarray(batch.column(0).dictionary_encode().indices)
            order = np.argsort(number, kind="stable")
            sort, number = batch.take(pa.array(order)), number[order]
            edges = np.append(np.flatnonzero(np.append(True, number[1:] != number[:-1])), len(number)) if len(number) else []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                for piece, texts in sliced(sort.slice(lo, hi - lo), "text"):
                    cols = fn(texts)
                    yield pa.RecordBatch.from_arrays([pa.array([piece.column(0)[0].as_py()] * len(cols[0]), type=pa.string()), *(pa.array(c, type=arrow.field(i + 1).type) for i, c in enumerate(cols))], schema=arrow)

    return rows.mapInArrow(run, schema)


def _word_counts(texts: Texts) -> tuple[np.ndarray, np.ndarray, int]:
    h = texts.lowered().runs(ALNUM).hashes().view(np.int64)
    keys, n = np.unique(h, return_counts=True)
    return keys, n, len(h)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common_share: float = 0.003, reference_words: int = 1000, most_candidates: int = 1_000_000, most_languages: int = 512) -> References:
    """The references over all rows, of the `most_languages` languages with the most words. What reaches the driver is bounded by that many times 1 / common_share words."""
    sc = docs.sparkSession.sparkContext

    width = len(CLASSES)

    def first(texts: Texts):
        """Rows (class, word, n): characters of each class, all words as class -1, and as class -2 the words that are frequent here."""
        n = np.bincount(CLASS_OF, np.bincount(texts.data, minlength=256), width + 1)[:width].astype(np.int64)
        keys, times, total = _word_counts(texts)
        often = times >= common_share * total
        kinds = np.concatenate([np.arange(width), [-1], np.full(often.sum(), -2)])
        return kinds, np.concatenate([np.zeros(width + 1, dtype=np.int64), keys[often]]), np.concatenate([n, [total], times[often]])

    facts = stored(_by_language(docs, text_col, lang_col, "class int, word long, n long", first).groupBy("lang", "class", "word").agg(F.sum("n").alias("n")), "facts")
    known = facts.filter((F.col("class") == -1) & (F.col("n") >= reference_words)).orderBy(F.desc("n"), "lang").limit(most_languages)
    words = {r["lang"]: r["n"] for r in known.select("lang", "n").toArrow().to_pylist()}
    languages = sorted(words)
    if not languages:
        return References([], np.zeros((0, len(CLASSES))), [])
    limits = F.broadcast(docs.sparkSession.createDataFrame([(x, common_share * n) for x, n in words.items()], "lang string, least double"))  # most_languages rows
    facts = facts.join(limits, "lang")
    totals = facts.filter(F.col("class") >= 0).select("lang", "class", "n").toArrow().to_pylist()
    got = facts.filter(F.col("class") == -2).select("word").distinct().limit(most_candidates + 1).toArrow().column(0).to_numpy()
    only = sc.broadcast(np.sort(got)) if len(got) <= most_candidates else None

    def counted(texts: Texts):
        keys, n, _ = _word_counts(texts)
        if only is not None:
            keep = np.isin(keys, only.value)
            keys, n = keys[keep], n[keep]
        return keys, n

    sums = _by_language(docs, text_col, lang_col, "word long, n long", counted).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    common: dict[str, list[tuple[int, int]]] = {x: [] for x in languages}
    for r in sums.join(limits, "lang").filter(F.col("n") >= F.col("least")).toArrow().to_pylist():
        common[r["lang"]].append((r["word"], r["n"]))
    place = {x: i for i, x in enumerate(languages)}
    classes = np.zeros((len(languages), len(CLASSES)))
    for r in totals:
        classes[place[r["lang"]], r["class"]] = r["n"]
    out = [(np.array([w for w, _ in sorted(own)], dtype=np.int64), np.array([n / words[x] for _, n in sorted(own)])) for x, own in common.items()]
    return References(languages, classes / classes.sum(1, keepdims=True), out)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of the rows of p from q; rows sum to 1."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def distances(texts: Texts, ref: References) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """[text, language] class distances and word distances, and each text's words."""
    cls = class_counts(texts).astype(float)
    cls /= np.maximum(cls.sum(1, keepdims=True), 1)
    words = texts.lowered().runs(ALNUM)
    h, doc, n = words.hashes().view(np.int64), words.text_of(), words.counts()
    by_class = np.stack([js_distance(cls, q) for q in ref.classes], axis=1)
    by_word = np.empty((len(texts), len(ref.languages)))
    for j, (keys, share) in enumerate(ref.common):
        at = KeyTable(keys).find(h)
        known = at >= 0
        width = len(keys) + 1
        counts = np.bincount(doc[known] * width + at[known], minlength=len(texts) * width).reshape(len(texts), width).astype(float)
        counts[:, -1] = n - counts.sum(1)
        by_word[:, j] = js_distance(counts / np.maximum(n, 1)[:, None], np.append(share, max(0.0, 1 - share.sum())))
    return by_class, by_word, n


def reaches(ref: References) -> np.ndarray:
    """[language] the word distance of a text without common words."""
    return np.array([js_distance(np.append(np.zeros(len(share)), 1.0), np.append(share, max(0.0, 1 - share.sum()))) for _, share in ref.common])


def word_limits(ref: References, words: np.ndarray, far_share: float = 0.75, most_share: float = 0.9) -> np.ndarray:
    """[text, language] limits of the word distance. n words drawn from a reference of k common words have a squared distance of k / (8 n ln 2) on average; twice that is allowed to chance."""
    reach = reaches(ref)
    k = np.array([len(keys) for keys, _ in ref.common])
    chance = np.sqrt(2 * k / (8 * math.log(2) * np.maximum(words, 1)[:, None]))
    return np.clip(chance, far_share * reach, most_share * reach)


RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("class_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
)


def judge(docs: DataFrame, ref: References, text_col: str = "text", max_class_distance: float = 0.3, max_word_distance: float = 0.5, min_chars: int = 200, min_words: int = 50, far_share: float = 0.75, most_share: float = 0.9) -> DataFrame:
    """docs with the base counts, the least distances, base_failed and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(ref)

    def make():
        ref = shared.value

        def run(texts: Texts) -> dict:
            out = base_counts(texts)
            n = len(texts)
            out["base_failed"] = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
            none = np.full(n, None, dtype=object)
            if not ref.languages:
                return out | {"class_distance": none, "word_distance": none, "kept": ~out["base_failed"]}
            by_class, by_word, words = distances(texts, ref)
            ok_class = (out["word_chars"] < min_chars)[:, None] | (by_class <= max_class_distance)
            ok_word = (words < min_words)[:, None] | (by_word <= np.minimum(max_word_distance, word_limits(ref, words, far_share, most_share)))
            good = (ok_class & ok_word).any(1)
            return out | {"class_distance": by_class.min(1), "word_distance": by_word.min(1), "kept": ~out["base_failed"] & good}

        return run

    return annotate(docs, text_col, RESULT, make)
