"""Token ids of documents in ORC files.

A file holds rows (doc_id, part, n_tokens, ids) in ascending doc_id order, file after file; ids is a list of integers
in ORC's run-length encoding. Stripes are `stripe_bytes` long, a row index entry stands every `index_rows` rows, and
doc_id has Bloom filters, so a reader can take stripes in parallel and skip those that can't hold an id (see lookup()).
part is the place of the row's range among the ranges that the ids were dealt to.

Encoding: the text is cut at ASCII white space, and before an ASCII sign such as a comma that follows a letter up to U+00FF (not before ', |, <, >, _ or -); A-Z are
lowered where an ASCII character follows, with which nothing composes, and where that makes no added token. For a tokenizer
whose own splitting never crosses such a place the ids of the pieces, one after another, are the text's ids; a probe text and the
first text of every task are encoded both ways, and where the ids differ texts stay whole. A task keeps the ids of pieces by their bytes, up to
CACHE_BYTES, and drops them at its end.

Defined results: a null or empty text has only the end id; rows with a null doc_id come first; rows that share a doc_id
keep their own spans, in order of their text's hash; extra columns aren't stored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Runs, Texts, lists, scratch, sliced

#: Memory that the pieces of a task and their ids may take, about.
CACHE_BYTES = 64 << 20
#: What a piece takes beyond its bytes and ids.
_ENTRY = 200
#: Bytes of text that are encoded at once: of more of them fewer pieces are different.
_SLICE = 2 << 20
#: Pieces that the tokenizer gets at once.
_AT_ONCE = 1000
_CUT = np.array([b not in b" \t\n\r" for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
#: The second bytes of letters from U+00C0 on, of which the first is 0xC3.
_LATIN = np.array([128 <= b < 192 and b not in (0x97, 0xB7) for b in range(256)])
_CAPITAL = np.array([65 <= b <= 90 for b in range(256)])
_STOP = np.array([b in b'!"#$%&()*+,./:;=?@' for b in range(256)])

#: The characters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others follow from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_BYTE_CHARS = "".join(chr(b if b in _PRINTED else 256 + _OTHERS.index(b)) for b in range(256))

#: Text on which a tokenizer shows whether cutting leaves its ids alone.
_PROBE = "It's a=b c+d(e) f/g:h;i! j$$$ k%%% l&&& m### n\"o\" p@q r*s t_u v-w <x>y</x> It's The end, of.the  line.\n\nWe're 12.5, ok?,. \t A.B,C d'Or été, naïve. É! È$$ À×. x,y.z <|endoftext|>. 　a b. é, f."

_FOLD = {c: c + 32 for c in range(65, 91)}


def pieces(texts: Texts) -> Runs:
    """The pieces of each text."""
    data = texts.data
    runs = texts.runs(_CUT)
    at = np.zeros(len(data), dtype=bool)
    letter = _LETTER[data]
    letter[1:] |= _LATIN[data[1:]] & (data[:-1] == 0xC3)
    at[1:] = _STOP[data[1:]] & letter[:-1]
    at[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = False
    cuts = np.flatnonzero(at)
    starts = np.sort(np.concatenate([runs.starts, cuts]))
    return Runs(texts, starts, np.sort(np.concatenate([runs.ends, cuts])), np.searchsorted(starts, texts.offsets))


class Cache:
    """Ids by bytes in two generations: when the younger is full it becomes the older, whose entries are dropped unless asked for again."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held = limit // 2, 0
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def put(self, piece: bytes, ids: bytes) -> None:
        self.held += len(piece) + len(ids) + _ENTRY
        if self.held > self.limit:
            self.young, self.old, self.held = {}, self.young, len(piece) + len(ids) + _ENTRY
        self.young[piece] = ids

    def learn(self, pieces: list[bytes], ids: list[bytes]) -> None:
        """put() of each, at once where all of them have room."""
        size = sum(map(len, pieces)) + sum(map(len, ids)) + _ENTRY * len(pieces)
        if self.held + size <= self.limit:
            self.held += size
            self.young.update(zip(pieces, ids, strict=True))
        else:
            for piece, own in zip(pieces, ids, strict=True):
                self.put(piece, own)

    def find(self, pieces: list[bytes]) -> tuple[list[bytes | None], list[int]]:
        """The ids of the pieces, and the places of those that are unknown."""
        found, young, old, new = list(map(self.young.get, pieces)), self.young, self.old, []
        unknown = [i for i, x in enumerate(found) if x is None]
        if not old:
            return found, unknown
        for i in unknown:
            ids = young.get(pieces[i]) or old.get(pieces[i])
            if ids is None:
                new.append(i)
            else:
                found[i] = ids
                self.put(pieces[i], ids)
        return found, new


class Encoder:
    """A tokenizer with the ids of the pieces that it has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.cache = Cache()
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [x.lower().encode() for x in added]
        self.folds = self.whole([_PROBE])[0] == self.whole([_PROBE.translate(_FOLD)])[0]
        self.cuts = self.agrees(_PROBE)
        self.plain = self.cuts and self._plain()

    def whole(self, texts: list[str]) -> list[list[int]]:
        out = []
        for i in range(0, len(texts), _AT_ONCE):
            out += [x.ids for x in self.tokenizer.encode_batch_fast(texts[i : i + _AT_ONCE], add_special_tokens=False)]
        return out

    def folded(self, texts: Texts) -> Texts:
        """The texts with capitals lowered, or as they are."""
        if not self.folds:
            return texts
        capital = _CAPITAL[texts.data]
        capital[:-1] &= texts.data[1:] < 128
        data = texts.data | (capital.astype(np.uint8) << 5)
        raw = data.tobytes()
        return texts if any(x in raw for x in self.added) else Texts(data, texts.offsets)

    def agrees(self, text: str) -> bool:
        """Whether cutting leaves the ids of this text alone."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        runs = pieces(self.folded(Texts(data, np.array([0, len(data)]))))
        parts = self.whole([runs.texts.data[a:b].tobytes().decode() for a, b in zip(runs.starts, runs.ends, strict=True)])
        return [x for p in parts for x in p] == self.whole([text])[0]

    def _plain(self) -> bool:
        """Whether the model alone gives the ids of words of Latin letters, in lower case and as characters that stand for bytes."""
        words = ["a", "the", "The", "TOKENIZER", "zyxwvutsrq", "nation", "é", "Ñandú", "größe", "ÉTÉ", "onthered", "œuvre"]
        return [self._letters(w.encode()) for w in words] == self.whole(words)

    def _letters(self, word: bytes) -> list[int] | None:
        """The ids of a word of Latin letters; None if it is anything else."""
        if word.isalpha():
            return [t.id for t in self.tokenize(word.lower().decode())]
        if word.isascii():
            return None
        text = word.decode()
        # Up to this sign nothing is composed or decomposed.
        low = (text if max(text) <= "\u024f" else normalize("NFC", text)).lower()
        if not low.isalpha() or max(low) > "\u024f":
            return None
        return [t.id for t in self.tokenize(charmap_decode(low.encode(), "strict", _BYTE_CHARS)[0])]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the texts."""
        if not self.cuts:
            own = self.whole([texts.data[a:b].tobytes().decode() for a, b in zip(texts.offsets[:-1], texts.offsets[1:], strict=True)])
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
            return np.array([i for x in own for i in x], dtype=np.int32), bounds
        runs = pieces(self.folded(texts))
        _, first, which = np.unique(runs.hashes(), return_index=True, return_inverse=True)
        odd = np.flatnonzero(~runs.same(np.arange(len(runs)), first[which]))
        if len(odd):  # other bytes under one hash: pieces of their own
            which[odd] = len(first) + np.arange(len(odd))
            first = np.concatenate([first, odd])
        raw = runs.texts.data.tobytes()
        own = [raw[a:b] for a, b in zip(runs.starts[first].tolist(), runs.ends[first].tolist(), strict=True)]
        found, new = self.cache.find(own)
        for i, ids in zip(new, self._learn([own[i] for i in new]), strict=True):
            found[i] = ids
        n = np.array([len(x) for x in found], dtype=np.int64) >> 2
        ids = np.frombuffer(b"".join(found), dtype=np.int32)
        begin = np.cumsum(n) - n
        n = n[which]
        total = np.concatenate([[0], np.cumsum(n)])
        source = np.arange(total[-1]) + np.repeat(begin[which] - total[:-1], n)
        return ids[source], total[runs.bounds]

    def _learn(self, words: list[bytes]) -> list[bytes]:
        letters = self._letters if self.plain else lambda word: None
        out = list(map(letters, words))
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self.whole([words[i].decode() for i in rest]), strict=True):
            out[i] = ids
        packed = [array("i", x).tobytes() for x in out]
        self.cache.learn(words, packed)
        return packed


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a tokenizer file, without the ids of earlier tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].cache = Cache()
    return _encoders[path]


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", end_id: int | None = None) -> DataFrame:
    """docs with n_tokens and ids in place of the text; tokenizer: a path of a tokenizer file that every worker can read."""
    keep = [f for f in docs.schema.fields if f.name != text_col and f.name.lower() not in ("n_tokens", "ids")]
    out = T.StructType([*keep, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, looked = encoder(tokenizer), False
        for batch in batches:
            for piece, texts in sliced(batch, text_col, _SLICE):
                if enc.cuts and not looked and (size := np.diff(texts.offsets)).any():
                    i = int(np.flatnonzero(size)[0])
                    looked, enc.cuts = True, enc.agrees(texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode())
                ids, bounds = enc.encode(texts)
                if end_id is not None:
                    ids = np.insert(ids, bounds[1:], end_id)
                    bounds = bounds + np.arange(len(bounds))
                kept = [piece.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(bounds)), lists(ids, bounds, pa.int32())], names=out.fieldNames())
        enc.cache = Cache()

    return docs.select(*[F.col(f"`{f.name}`") for f in keep], F.col(f"`{text_col}`")).mapInArrow(run, out)


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = None, stripe_bytes: int = 8 << 20, index_rows: int = 1000, false_positives: float = 0.01) -> None:
    """ORC files of the token ids of docs under path, in ascending id order.

    The texts are dealt and sorted before they are encoded: they are smaller than their ids, and each is encoded once.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(f"`{text_col}`").alias("text_hash"), F.col(f"`{text_col}`").alias("text"))
    # Repeated rows tie in id and hash; by their own number they can be dealt to several tasks.
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("text_hash"), F.col("row")).drop("row").withColumn("part", F.spark_partition_id())
    encoded = encode(dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text_hash"), tokenizer, end_id=end_id)
    writer = encoded.select("doc_id", "part", "text_hash", "n_tokens", "ids").write.format("orc").option("compression", "zstd")
    options = {"orc.stripe.size": stripe_bytes, "orc.row.index.stride": index_rows, "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": false_positives}
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of files that write() made."""
    return spark.read.orc(path)


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The rows of some documents; stripes and row groups whose statistics or Bloom filters exclude them aren't read."""
    return read(spark, path).filter(F.col("doc_id").isin(ids))


def spans(stored: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """The files' rows with start: the number of ids of all documents before theirs.

    sizes: where part and n_tokens of the same rows can be read without the ids.

    Parts are summed first; a part's rows, dealt by range, are then numbered among themselves and shifted.
    """
    totals = (stored if sizes is None else sizes).groupBy("part").agg(F.sum("n_tokens").alias("own"))
    # One row for each part: as many as there are shuffle partitions.
    shift = totals.select(F.col("part").alias("of"), (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "text_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = stored.withColumn("start", F.sum("n_tokens").over(order) - F.col("n_tokens"))
    return placed.join(shift, placed["part"] == shift["of"]).withColumn("start", F.col("start") + F.col("before")).drop("of", "before")


def checksums(stored: DataFrame) -> DataFrame:
    """The files' rows with ids_crc32, of the ids as little-endian unsigned 32-bit integers, in place of the ids."""
    keep = [f for f in stored.schema.fields if f.name != "ids"]
    out = T.StructType([*keep, T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            flat = np.asarray(column.values)
            at = np.asarray(column.offsets)
            crc = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(crc, type=pa.int64())], names=out.fieldNames())

    return stored.select(*[f.name for f in keep], "ids").mapInArrow(run, out)


def roundtrip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write docs as ORC in the shared folder, and read back doc_id, start, n_tokens and ids_crc32."""
    path = scratch(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, end_id=end_id)
    back = read(docs.sparkSession, path)
    return spans(checksums(back), back.select("part", "n_tokens")).select("doc_id", "start", "n_tokens", "ids_crc32")
