"""How far the sources of a language diverge, term by term, by a heavy-light split of the terms.

A group is a (lang, source); terms are runs of letters (ASCII and anything beyond ASCII), A-Z lower-cased; a language keeps the terms
that at least `least` of its documents hold (V of them). Every group, and every language as a whole, gives each kept term
p = 1 + floor(10^9 (count + 1) / (N + V)), N its kept words. The divergence of a term, p against q, is f = floor((p - q)^2 / q).

For every ordered pair of groups of a language f is summed over all kept terms, also those that neither has. Terms that a third
of the groups or more hold are heavy: they are laid out in dense numpy tiles (terms x groups) and summed for all pairs. The others are light: where a
group lacks the term its p is one base number, so all light terms give f(base, base) at first; each posting (group, count) corrects its
group's row and column, grouped by equal counts; and where two groups share a posting list a pair correction makes up for what was corrected
twice. Both parts are integers and are added exactly. Cells are sums over tiles, so a task holds one tile and at most CELLS sums, and what it
sends is one row of sums a group.

A hot source is spread as well: words are counted in the tasks that read them, tiles are cut by the hash of the term, top lists are
thinned before they meet (Spark's window group limit).

Defined results: null text, lang and source are ''; a group without terms has p = base for all terms of its language; a language without kept
terms gives every pair 0; a language of one source gives no pairs; repeated rows count as documents; an empty table gives no rows; only the three columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Texts, _U, mix, schema, sliced, stored

UNIT = 10**9
#: Bytes of [^\x00-\x40\x5B-\x60\x7B-\x7F].
LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Bytes of text whose words are counted at once.
PIECE = 4 << 20
#: Postings of a tile, and sums a task holds.
TILE = 1 << 18
CELLS = 1 << 22

_COUNTS = schema("lang string, source string, term string, n long, docs long")


def _strings(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.tobytes()), pa.py_buffer(texts.data[at].tobytes())).cast(pa.string())


def count_words(texts: Texts, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(group, term, occurrences, texts) of each term of each group; group: the group's number of each text."""
    texts = texts.lowered()
    runs = texts.runs(LETTER)
    text = runs.text_of()
    key = mix(runs.hashes()) ^ mix(group[text].astype(np.uint64) + _U(1))
    while True:
        order = np.argsort(key, kind="stable")  # words of one key stay in the order of their texts
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[order][1:] != key[order][:-1]
        twin = np.flatnonzero(~fresh)
        a, b = order[twin - 1], order[twin]
        if (group[text[a]] == group[text[b]]).all() and runs.same(a, b).all():
            break
        number: dict[tuple[int, bytes], int] = {}  # two words have one key: number them instead
        key = np.array([number.setdefault((int(group[t]), texts.data[i:j].tobytes()), len(number)) for t, i, j in zip(text, runs.starts, runs.ends, strict=True)])
    first = np.flatnonzero(fresh)
    new_text = fresh.copy()
    new_text[1:] |= text[order][1:] != text[order][:-1]
    head = order[first]
    n = np.diff(np.append(first, len(key)))
    docs = np.add.reduceat(new_text.astype(np.int64), first) if len(first) else np.zeros(0, dtype=np.int64)
    return group[text[head]], _strings(texts, runs.starts[head], runs.ends[head]), n, docs


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of docs (lang, source, text), whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in sliced(batch, "text", PIECE):
                names = list(zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True))
                number = {x: i for i, x in enumerate(dict.fromkeys(names))}
                group, term, n, held = count_words(texts, np.array([number[x] for x in names], dtype=np.int64))
                each, index = list(number), pa.array(group)
                lang, source = (pa.array([x[k] for x in each], type=pa.string()).take(index) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([lang, source, term, pa.array(n), pa.array(held)], names=_COUNTS.fieldNames())

    return docs.mapInArrow(run, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, held: Column) -> Column:
    """p of a count; held: N + V."""
    return F.lit(1).cast("long") + F.expr("(cast(`{}` + 1 as decimal(20, 0)) * 1000000000) div `{}`".format(count, held))


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shares(count: np.ndarray, held: np.ndarray) -> np.ndarray:
    """p, exactly, for counts of any size."""
    if count.max(initial=0) < 9 * 10**9:
        return 1 + (count + 1) * UNIT // held
    return (1 + (count.astype(object) + 1) * UNIT // held.astype(object)).astype(np.int64)


def dense(term: np.ndarray, group: np.ndarray, n: np.ndarray, held: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Sums over the terms of a tile, for the pairs of groups lo..hi with all groups, laid out in full."""
    count = np.zeros((term.max() + 1, len(held)), dtype=np.int64)
    count[term, group] = n
    p = shares(count, held)
    return np.stack([apart(p[:, s : s + 1], p).sum(axis=0) for s in range(lo, hi)])


def sparse(term: np.ndarray, group: np.ndarray, n: np.ndarray, held: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The same from postings: a base, what each posting changes, and what pairs of postings of one term change."""
    base = shares(np.zeros(len(held), dtype=np.int64), held)
    none = apart(base[lo:hi, None], base)
    out = none * (term.max() + 1)
    kinds, many = np.unique(np.stack([group, n]), axis=1, return_counts=True)
    step = 1 + CELLS // (8 * len(held))
    for at in range(0, kinds.shape[1], step):
        g, times = kinds[0, at : at + step], many[at : at + step, None]
        p = shares(kinds[1, at : at + step], held[g])
        own = (g >= lo) & (g < hi)
        np.add.at(out, g[own] - lo, times[own] * (apart(p[own, None], base) - none[g[own] - lo]))
        np.add.at(out.T, g, times * (apart(base[lo:hi], p[:, None]) - apart(base[lo:hi], base[g][:, None])))
    order = np.lexsort((group, term))
    term, group, n = term[order], group[order], n[order]
    first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    size = np.diff(np.append(first, len(term)))
    for k in np.unique(size[size > 1]):
        lists = first[size == k]
        step = max(1, CELLS // (8 * int(k) ** 2))
        for at in range(0, len(lists), step):
            own = lists[at : at + step, None] + np.arange(k)
            g = group[own]
            p, b = shares(n[own], held[g]), base[g]
            i, j = np.nonzero(~np.eye(k, dtype=bool))
            gi, gj, pi, pj, bi, bj = g[:, i], g[:, j], p[:, i], p[:, j], b[:, i], b[:, j]
            inside = (gi >= lo) & (gi < hi)
            np.add.at(out, (gi[inside] - lo, gj[inside]), (apart(pi, pj) - apart(pi, bj) - apart(bi, pj) + apart(bi, bj))[inside])
    return out


def _partial(tiles: DataFrame) -> DataFrame:
    """(lang, of, sums): for each task, language and group the sums over its tiles with all groups of the language, its own included."""

    def rows(lang: str, lo: int, sums: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * sums.shape[1], type=pa.int32()), pa.array(sums.ravel()))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(sums), type=pa.string()), pa.array(np.arange(lo, lo + len(sums), dtype=np.int32)), lists], names=["lang", "of", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                lang, heavy = row.column(0)[0].as_py(), row.column(1)[0].as_py()
                postings, held = row.column(2).flatten(), row.column(3).flatten().to_numpy(zero_copy_only=False)
                words, *numbers = postings.flatten()
                term = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                group, n = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in numbers)
                step = max(1, CELLS // len(held))
                for lo in range(0, len(held), step):
                    sums = (dense if heavy else sparse)(term, group, n, held, lo, min(len(held), lo + step))
                    if step < len(held):  # too many groups to keep all pairs
                        yield rows(lang, lo, sums)
                    elif lang in kept:
                        kept[lang] += sums
                    else:
                        kept[lang] = sums
                if sum(x.size for x in kept.values()) > CELLS:
                    yield from (rows(x, 0, kept.pop(x)) for x in list(kept))
        yield from (rows(x, 0, kept[x]) for x in kept)

    return tiles.mapInArrow(run, "lang string, of int, sums array<long>")


class Terms:
    """What the audit needs of a table: kept (lang, source, term, n, total, groups), groups (lang, source, at, held), langs (lang, sources, helds, terms, held)."""

    def __init__(self, docs: DataFrame, text_col: str, lang_col: str, source_col: str, least: int):
        own = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(k) for c, k in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
        word = Window.partitionBy("lang", "term")
        seen = counts(own).withColumns({"in_docs": F.sum("docs").over(word), "total": F.sum("n").over(word), "groups": F.count(F.lit(1)).over(word), "first": F.min("source").over(word)})
        kept = seen.filter(F.col("in_docs") >= least)
        self.kept = stored(kept.select("lang", "source", "term", "n", "total", "groups", (F.col("source") == F.col("first")).alias("counts")), "terms")
        sums = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count_if("counts").alias("firsts"))
        every = own.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0, ["n", "firsts"])
        listed = every.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("g"), F.sum("firsts").alias("terms"), F.sum("n").alias("n"))
        held = F.transform("g", lambda x: x["n"] + F.col("terms"))
        self.langs = stored(listed.select("lang", F.col("g.source").alias("sources"), held.alias("helds"), "terms", (F.col("n") + F.col("terms")).alias("held")), "langs")
        each = self.langs.select("lang", "held", F.size("sources").alias("of"), "terms", F.posexplode(F.arrays_zip("sources", "helds")).alias("at", "g"))
        self.groups = stored(each.select("lang", "of", "terms", F.col("held").alias("lang_held"), "at", F.col("g.sources").alias("source"), F.col("g.helds").alias("held")), "groups")

    def placed(self) -> DataFrame:
        return self.kept.join(self.groups, ["lang", "source"])


def pairs(t: Terms) -> DataFrame:
    """(lang, source, item, value): the divergence of each source from each other source of its language."""
    heavy = F.col("groups") * 3 >= F.col("of")
    # A tile's terms: as many as make TILE postings if all groups had them, 64 to 4096.
    room = F.least(F.greatest(F.floor(F.lit(TILE) / F.col("of")), F.lit(64)), F.lit(4096))
    tile = F.pmod(F.xxhash64("term"), F.ceil(F.col("terms") / room))
    tiles = t.placed().groupBy("lang", heavy.alias("heavy"), tile.alias("tile")).agg(F.collect_list(F.struct("term", "at", "n")).alias("postings"))
    sums = _partial(tiles.join(t.langs.select("lang", "helds"), "lang").select("lang", "heavy", "postings", "helds"))
    sums = sums.select("lang", "of", F.posexplode("sums").alias("other", "value")).filter(F.col("of") != F.col("other"))
    none = t.groups.select("lang", F.col("at").alias("of"), F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("other"), F.lit(0).cast("long").alias("value")).filter(F.col("of") != F.col("other"))
    total = sums.unionByName(none).groupBy("lang", "of", "other").agg(F.sum("value").alias("value"))
    named = total.join(t.langs.select("lang", "sources"), "lang")
    return named.select("lang", F.col("sources")[F.col("of")].alias("source"), F.col("sources")[F.col("other")].alias("item"), "value")


def terms(t: Terms) -> DataFrame:
    """(lang, source, item, value): the terms that a source has more of than its language, by their divergence."""
    shared = t.placed().withColumns({"p": share("n", "held"), "q": share("total", "lang_held")}).filter(F.col("p") > F.col("q"))
    return shared.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs, and each group's `top` most telling terms."""
    t = Terms(docs, text_col, lang_col, source_col, least)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    best = terms(t).withColumn("rank", rank).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    every = pairs(t).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    return every.unionByName(best).select("lang", "source", "part", "item", "value", "rank")


#: DuckDB SQL for the rows of the query.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, (SELECT count(*) FROM k WHERE k.lang = x.lang)::HUGEINT AS v, coalesce((SELECT sum(total) FROM k WHERE k.lang = x.lang), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang FROM d) x),
g AS (SELECT lang, source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + l.v) AS p,
             1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS q
      FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
every AS (SELECT * FROM pair UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INT AS rank FROM every QUALIFY part = 'pair' OR rank <= 200
"""
