"""Each operator against a plain version on small fixtures, with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontam, langid, license, mixing, ngram_join, quality, sharding, tokens, toxicity, warc
from millrace.llm.common import ALNUM, NOSPACE, Texts, ranked

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RNG = random.Random(5)
SYLLABLES = ["an", "the", "on", "er", "ti", "re", "sh", "ou", "é", "ß"]


def word():
    return "".join(RNG.choice(SYLLABLES) for _ in range(RNG.randint(1, 4)))


def prose(n):
    return " ".join(word() + RNG.choice(["", "", ",", ".", "\n"]) for _ in range(n))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def table(spark, texts, **more):
    """Documents with the texts, a clashing column, and a repeated row and null id at the end."""
    rows = [(i, x, "en", f"s{i % 3}", 7) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")




def thue_morse(n):
    out = "a"
    while len(out) < n:
        out += out.translate({97: 98, 98: 97})
    return out


MORSE = [thue_morse(2048), thue_morse(2048).translate({97: 98, 98: 97})]
ODD = [None, "", " ", "...", "a", "A. b", "\n\n", "é", "日本語 テキスト", "x" * 5000, "word " * 9000, "😀 😀", "  \x1c", "Ⅷ½", "a\x00b", " ".join(MORSE), "\n".join([*MORSE, MORSE[0]])]


def texts_of(items):
    raw = [(x or "").encode() for x in items]
    return Texts(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


@pytest.mark.parametrize("member,pattern,lower", [(ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True), (NOSPACE, r"[^\x20\x09-\x0D]+", False)])
def test_words(member, pattern, lower):
    items = ODD + [prose(20) for _ in range(20)]
    t = texts_of(items)
    t = t.lowered() if lower else t
    runs = t.runs(member)
    for i, x in enumerate(items):
        x = re.sub("[A-Z]", lambda m: m[0].lower(), x or "") if lower else x or ""
        got = [t.data[runs.starts[j] : runs.ends[j]].tobytes().decode() for j in range(runs.bounds[i], runs.bounds[i + 1])]
        assert got == re.findall(pattern, x)
    h = runs.hashes()
    by = {}
    for j in range(len(runs)):
        assert by.setdefault(t.data[runs.starts[j] : runs.ends[j]].tobytes(), h[j]) == h[j]
    assert len(set(by.values())) == len(by)


def test_ranked_numbers_each_group(spark):
    rows = [(RNG.choice(["a", None, "b"]), RNG.randint(0, 5), i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long, i long")
    got = {}
    for r in ranked(df, ["g"], ["o", "i"], "place", "t").collect():
        got.setdefault(r.g, []).append((r.place, r.o, r.i))
    for g, own in got.items():
        assert [(o, i) for _, o, i in sorted(own)] == sorted((o, i) for x, o, i in rows if x == g)
        assert sorted(p for p, _, _ in own) == list(range(len(own)))


def test_very_long_texts_take_bounded_memory():
    """A text of 20 MB, 2 and 4, 5, 7, 8: the kernels' memory beside it, and some results by plain counts."""
    import tracemalloc

    rng = random.Random(6)
    some = [word() for _ in range(5000)]
    line = " ".join(rng.choice(some) for _ in range(20_000))
    text = "\n".join(line[i:] + line[:i] for i in range(0, len(line), len(line) // 3)) + " "
    t = texts_of([text * (20_000_000 // len(text.encode()) + 1)])
    size = len(t.data)
    model = langid._build({k: {"en": (np.arange(97, 123, dtype=np.int64), np.ones(26, dtype=np.int64))} if k == 0 else {} for k in range(5)}, ["en"], 4)
    enc = tokens.Encoder(TOKENIZER)
    runs = {
        "language": (lambda: langid.code_lengths(t, [model]), 2),
        "tokens": (lambda: enc.encode(t), 25),
        "words": (lambda: t.lowered().runs(ALNUM).hashes(), 12),
        "shingles": (lambda: ngram_join.shingle_sets(t, 5), 25),
        "quality": (lambda: quality.base_counts(t), 30),
    }
    for name, (run, most) in runs.items():
        tracemalloc.start()
        got = run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * size, (name, peak / size)
        if name == "quality":
            assert got["n_words"][0] == len(t.data.tobytes().split()) and got["n_repeat_words"][0] == got["n_words"][0]


# 1


def test_warc_roundtrip(spark):
    pages = [(1, "u", "same"), (5, "u", "same"), (3, None, "same"), (2, "u\r\nx", None), (4, "u", ""), (None, "u", "same"), (6, "u", "é" * 200_000 + "\r\n\r\n"), (7, "u", "WARC/1.1\r\n\r\n"), (5, "u", "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.roundtrip(df, segment_bytes=1000).collect()), key=repr)
    want = []
    for i, _, html in pages:
        body = (html or "").encode()
        head = max((j for j, _, h in pages if (h or "") == (html or "") and j is not None), default=None)
        revisit = i is not None and i != head
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", head if revisit else None))
    assert got == sorted(want, key=repr)
    few = [r for r in warc.roundtrip(df, least_shared=5).collect() if r.record_type == "revisit"]
    assert few == []
    assert warc.roundtrip(df.limit(0)).count() == 0


def test_warc_broken_segments(spark, tmp_path):
    rows = list(warc.records_of(1, "a", "u", b"x" * 3000, None, 1000, "d"))
    whole = warc.END.join([*rows, b""])
    import gzip

    (tmp_path / "a.gz").write_bytes(gzip.compress(whole) + gzip.compress(warc.END.join([*warc.records_of(2, "b", "u", b"y" * 3000, None, 1000, "d")][:2] + [b""])))
    got = {r.page_id: r for r in warc.read(spark, str(tmp_path)).collect()}
    assert got[1].ok and bytes(got[1].payload) == b"x" * 3000
    assert not got[2].ok
    one = gzip.compress(whole)
    for data in (whole, one, one + one, one[:-9], whole[:-1200]):
        texts = [b"".join(warc.inflated(data, k)) for k in (1, 7, 1 << 16)]
        assert texts[0] == texts[1] == texts[2]
        assert list(warc.parse(data, 1)) == list(warc.parse(data, 13)) == list(warc.parse(texts[2]))
    assert len(list(warc.parse(one + one))) == 2 * len(rows)
    assert [b for _, b in warc.parse(one)] == [r.partition(warc.END)[2] for r in rows]
    assert warc.dechunked(b"3;e=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == (b"abc", True)
    assert warc.dechunked(b"5\r\nabc") == (b"abc", False)
    assert warc.dechunked(b"zz\r\n") == (b"", False)


# 2


def plain_ppm(training, text, order=4):
    """Code lengths of a text by language, from raw counts: escape C, no exclusions."""
    norm = lambda x: re.sub(rb"[^a-z\x80-\xff]+", b" ", re.sub(rb"^[^a-z\x80-\xff]+", b"", re.sub(rb"[A-Z]", lambda m: m[0].lower(), x.encode())))
    out = {}
    for lang, texts in training.items():
        seen = {}
        for x in map(norm, texts):
            padded = b" " * order + x
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    seen.setdefault(padded[i - k : i], Counter())[padded[i]] += 1
        padded = b" " * order + norm(text)
        total = 0.0
        for i in range(order, len(padded)):
            for k in range(order, -1, -1):
                own = seen.get(padded[i - k : i])
                if own is None:
                    continue
                if padded[i] in own:
                    total -= math.log2(own[padded[i]] / (sum(own.values()) + len(own)))
                    break
                total -= math.log2(len(own) / (sum(own.values()) + len(own)))
            else:
                total += 8.0
        out[lang] = total
    return out


def test_language_code_lengths_from_raw_counts(spark, monkeypatch):
    """Counting, escapes and sums against a plain version; ten languages, so that they are kept in two groups; parts of a few bytes."""
    rng = random.Random(4)
    training = {f"l{j}": ["".join(rng.choice("abcdé "[: 2 + j % 5] + "xyz") for _ in range(rng.randint(1, 80))) for _ in range(6)] for j in range(10)}
    docs = spark.createDataFrame([(x, lang) for lang, own in training.items() for x in own * 2] + [(None, "l0"), ("zzz", None)], "text string, lang string")
    models = langid.train(docs)
    assert [len(m.languages) for m in models] == [8, 2]
    items = ["The Cat, sat", "Größe zz\x00q", "", "  abxé ba", "日本", prose(30), "x" * 300]
    for piece in (langid.PIECE, 7):
        monkeypatch.setattr(langid, "PIECE", piece)
        got, _, _ = langid.code_lengths(texts_of(items), models)
        for row, x in zip(got, items, strict=True):
            want = plain_ppm(training, x)
            assert np.allclose(row, [want[f"l{j}"] for j in range(10)], rtol=1e-4), x


def test_language_accuracy_and_bounds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out()), sample_bytes=1 << 18)
    got = langid.predict(docs.filter(langid.held_out()).select("doc_id", "text", "lang"), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    some = langid.sample(docs, "text", "lang", 1 << 16, 1 << 16, 512)
    held = {r.lang: (r.n, r.b) for r in some.groupBy("lang").agg(F.count("text").alias("n"), F.sum(F.octet_length("text")).alias("b")).collect()}
    assert len(held) == 4 and all(b <= 1 << 14 or n == 1 for n, b in held.values())
    assert langid.sample(docs, "text", "lang", 1 << 16, 1 << 16, 3).select("lang").distinct().count() == 3


def test_language_score_tells_what_fits(spark):
    """Clean texts score above a half; random letters, other scripts and texts of which half is in another language below."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = langid.train(docs.filter(~langid.held_out()))
    assert all(1 < x < 4 for m in models for x in m.typical)
    clean = langid.predict(docs.select("doc_id", "text", "lang"), models)
    assert clean.filter("score < 0.5").count() <= 3  # texts that mix two languages
    by = {r.lang: r.t[:1500] for r in docs.filter("length(text) > 1500 AND NOT text LIKE '%$$$%'").groupBy("lang").agg(F.min_by("text", "doc_id").alias("t")).collect()}
    whole = list(by.values())
    odd = ["zzqx vvkj wwpq jjxz " * 10, "日本語のテキストです。" * 20, *[a[:400] + " " + b[400:800] for a, b in itertools.combinations(whole, 2)]]
    got = [r.score for r in langid.predict(spark.createDataFrame([(x,) for x in [*odd, *whole, "the"]], "text string").coalesce(1), models).collect()]
    assert max(got[: len(odd)]) < 0.01 and min(got[len(odd) :]) > 0.5, got


def test_language_of_odd_texts(spark):
    docs = table(spark, ODD)
    model = langid.train(table(spark, [prose(50) for _ in range(5)]))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    assert [got[i] for i in range(4)] == [("und", 0.0)] * 4
    assert got[4][0] == "en" and got[11] == ("und", 0.0)
    assert "score" in langid.predict(docs, model).columns and len(langid.predict(docs, model).columns) == 7
    blank = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, blank).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


# 3


def plain_license(text):
    w = alnum(text)
    base = [(i, label) for p, label in license.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    labels, best = {x for _, x in base}, 0.0
    for t in license.notices():
        for start in range(-200, len(w)):
            there = lambda i, x: 0 <= i < len(w) and w[i] == x
            got = sum(idf for x, place, idf in t["index"] if there(start + place, x)) / t["total"]
            if got >= license.SUPPORT and all(there(start + p + k, x) for p, ws in t["phrases"] for k, x in enumerate(ws)):
                labels.add(t["label"])
                best = max(best, got)
    places = [i for i, _ in base]
    return (len(w), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(min(1.0, best) if best else 0.5 * bool(base), 6))


def test_license_scan(spark):
    lines = ["Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.", "All rights\nreserved.", "cc", "by cc BY by", "the MIT", "Apache License, Version 2.0", "x" + "general public license", "public domain; general PUBLIC  license", license.TEXTS[0][1], license.TEXTS[2][1][40:], "x " + license.TEXTS[8][1]]
    items = ODD + lines + ["\n".join(lines * 3)] + [f"{prose(9)}\n{x} {prose(5)}" for x in lines]
    got = license.scan(table(spark, items).select("doc_id", "text", F.lit(1).alias("labels"))).collect()
    assert len(got) == len(items)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 6)) == plain_license(items[r.doc_id]), items[r.doc_id]
    assert license.scan(table(spark, ["x"]).limit(0)).count() == 0


def test_whole_licences_are_found(spark):
    """Every text, its first word gone, inside prose; and one more text given as files would be."""
    more = license.paragraphs("house", "The tenant shall water the ferns on alternate Tuesdays and return the brass key to the porter before leaving the premises.")
    items = [f"{prose(30)}\n\n{' '.join(text.split()[1:])} changed words\n{prose(5)}" for _, text in license.TEXTS] + [f"x {more[0][1]} y"]
    got = {r.doc_id: r.labels.split(",") for r in license.scan(table(spark, items), templates=[*license.TEMPLATES, *more]).collect()}
    for i, (label, _) in enumerate(license.TEXTS):
        assert label in got[i], (label, got[i])
    assert got[len(items) - 1] == ["house"]
    assert "gpl-2.0" not in got[[x for x, _ in license.TEXTS].index("gpl-3.0")]


def test_dense_licence_words_are_linear(spark):
    import time

    took = []
    for n in (8_000, 8_000, 64_000):
        began = time.time()
        license.scan(table(spark, ["license version 4 0 apache mozilla " * (n // 6)])).collect()
        took.append(time.time() - began)
    assert took[2] < 8 * took[1] + 4


# 4


def test_token_files(spark):
    enc = tokens.Encoder(TOKENIZER)
    assert enc.cuts and enc.plain
    items = ODD + [prose(40) for _ in range(20)] + ["It's we'LL <|endoftext|>.x,y a.b. 1.5,2 É.é", "İ.I, ǅ.", "ΑΣ ẞ ﬁ ª º Straße's a\u0301. x\u0301,"]
    df = table(spark, items)
    df = df.union(df.limit(1)).union(spark.createDataFrame([(None, "no id", "en", "s", 1)], df.schema))
    got = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in tokens.roundtrip(df, TOKENIZER, 2).collect()}
    rows = sorted(df.collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id)
    start, want = 0, {}
    for r in rows:
        ids = [*enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        want[r.doc_id, start] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want
    assert tokens.roundtrip(df.limit(0), TOKENIZER, 2).count() == 0


def test_token_lookup(spark, tmp_path):
    df = table(spark, [prose(10) for _ in range(50)])
    tokens.write(df, str(tmp_path / "t"), TOKENIZER, end_id=2)
    found = tokens.lookup(spark, str(tmp_path / "t"), [7, 49])
    assert sorted(r.doc_id for r in found.collect()) == [7, 49]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()


# 5


def test_decontamination(spark):
    bench = [prose(30) for _ in range(6)] + ["short item", "x", None, "...", "one two three four five six seven eight nine ten"]
    items = ODD + [f"{prose(20)} {' '.join(alnum(b)[3:17])} {prose(9)}" for b in bench if b] + ["SHORT, item! X", bench[0] + " " + bench[0]] + [prose(60) for _ in range(10)]
    b = spark.createDataFrame([*enumerate(bench), (0, bench[1]), (None, "null item words")], "item_id long, text string")
    win = {}
    for i, x in [*((str(i), x) for i, x in enumerate(bench)), ("0", bench[1]), ("", "null item words")]:
        w = alnum(x)
        for j in range(max(1, len(w) - 9)) if w else []:
            win.setdefault(tuple(w[j : j + 10]), set()).add(i)
    for size in (2 << 20, 40):  # one pass, several passes
        got = {r.doc_id: r for r in decontam.digest(decontam.find(table(spark, items).withColumn("ITEMS", F.lit(1)), b, pattern_bytes=size)).collect()}
        for i, x in enumerate(items):
            w, hit, found = alnum(x), set(), set()
            for n in {len(k) for k in win}:
                for a in range(len(w) - n + 1):
                    if own := win.get(tuple(w[a : a + n])):
                        hit |= set(range(a, a + n))
                        found |= own
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)), x
    assert decontam.find(table(spark, ["x"]), b.limit(0)).first().n_words == 1
    assert decontam.find(table(spark, ["x"]).limit(0), b).count() == 0


# 6


def toxic_tables(spark):
    rows = []
    for i in range(300):
        bad = i % 7 == 0
        rows.append((i, prose(30) + (f" {RNG.choice(['grumbly', 'grumblish', 'vexing'])} {word()}" if bad else ""), int(bad)))
    docs = spark.createDataFrame([(i, x) for i, x, _ in rows] + [(1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 0), (1002, 1), (5, None)], "doc_id long, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


def plain_toxicity(training, text, k=25, sharpness=4.0, prior_weight=0.5, half=40.0):
    """Cosines with all examples (text, label), and the score, from raw counts."""

    def tf(x):
        w = [y.encode() for y in alnum(x)]
        return Counter([(0, y) for y in w] + [(n, y[:n]) for y in w for n in (4, 5, 6) if len(y) > n])

    rows = [(tf(x), y) for x, y in training]
    size = Counter(y for _, y in rows)
    df = {c: Counter(t for own, y in rows if y == c for t in own) for c in (0, 1)}

    def scale(t):
        g = 0.0
        for c in (0, 1):
            for n, col in ((df[c][t], df[0][t] + df[1][t]), (size[c] - df[c][t], len(rows) - df[0][t] - df[1][t])):
                g += 2 * n * math.log(n * len(rows) / (size[c] * col)) if n else 0.0
        return math.log((1 + len(rows)) / (df[0][t] + df[1][t])) * (g / (g + half)) ** 2

    def vector(own):
        v = {t: (1 + math.log(n)) * scale(t) for t, n in own.items() if df[0][t] + df[1][t]}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    q = vector(tf(text))
    cosines = [sum(q.get(t, 0.0) * x for t, x in vector(own).items()) for own, _ in rows]
    best = sorted(((c, y) for c, (_, y) in zip(cosines, rows, strict=True)), reverse=True)[:k] if q else []
    votes = [(c**sharpness, y) for c, y in best]
    prior = size[1] / len(rows)
    return cosines, (sum(v * y for v, y in votes) + prior_weight * prior) / (sum(v for v, _ in votes) + prior_weight)


def test_toxicity_neighbours_votes_and_scores(spark):
    docs, labels, truth = toxic_tables(spark)
    index = toxicity.train(docs.filter(~toxicity.held_out()), labels)
    got = {r.doc_id: r for r in toxicity.score(docs.withColumn("SCORE", F.lit(1)), index).collect()}
    assert all((got[i].score >= 0.3) == bool(y) for i, y in truth.items())
    assert got[1000].score == got[1001].score == pytest.approx(index.prior)
    held = {r.doc_id for r in docs.filter(toxicity.held_out()).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    names = [i for i in truth if i not in held]
    for i in [*range(0, 300, 11), 7, 14]:
        cosines, score = plain_toxicity([(texts[j], truth[j]) for j in names], texts[i])
        assert got[i].score == pytest.approx(index.calibrated(np.array([score]))[0]), i
        best = sorted(cosines, reverse=True)[:3]
        assert sorted(cosines[names.index(int(j))] for j in got[i].evidence) == pytest.approx(sorted(c for c in best if c > 0)), i
    assert toxicity.score(docs.limit(0), index).count() == 0
    bare = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, bare).collect()} == {0.0}


def test_toxicity_sample_is_bounded_by_texts(spark):
    """An id that repeats with other texts, and a row that repeats, bring no more than their chosen texts."""
    docs, labels, _ = toxic_tables(spark)
    more = spark.createDataFrame([(7, f"grumbly {prose(5)} {i}") for i in range(3000)] + [(14, "vexing again")] * 500, "doc_id long, text string")
    index = toxicity.train(docs.unionByName(more), labels, rows_per_class=100)
    assert len(index.names) == 200 and index.toxic.sum() == 100


def test_toxicity_scores_are_shares(spark):
    """Words that speak for a label with known chances: of held-out rows that score s about s are toxic."""
    rng = random.Random(4)
    strength = {"grumbly": 0.9, "vexing": 0.6, "gnarly": 0.3, "plain": 0.05}
    rows = [(i, f"{prose(15)} {w} {w} {prose(5)}", int(rng.random() < strength[w])) for i in range(2400) for w in [rng.choice(list(strength))]]
    docs = spark.createDataFrame([(i, x) for i, x, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    index = toxicity.train(docs.filter(~toxicity.held_out()), labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs.filter(toxicity.held_out()), index).collect()}
    y = np.array([rows[i][2] for i in got])
    p = np.array(list(got.values()))
    brier = ((p - y) ** 2).mean()
    assert brier < y.mean() * (1 - y.mean()) * 0.75
    for lo, hi in ((0, 0.2), (0.2, 0.5), (0.5, 1.01)):
        own = (p >= lo) & (p < hi)
        assert own.sum() < 30 or abs(y[own].mean() - p[own].mean()) < 0.12, (lo, own.sum(), y[own].mean(), p[own].mean())
    assert abs(p.mean() - y.mean()) < 0.06


def test_toxicity_prunes_no_neighbour():
    """Many blocks of few examples against the full product, with ties."""
    rng = np.random.RandomState(2)
    n, width, k = 700, 60, 5
    dense = np.where(rng.rand(n, width) < 0.1, rng.randint(1, 4, (n, width)), 0).astype(float)
    dense[: n // 2] *= np.arange(width) < width // 2
    index = toxicity.Index(None, np.ones(width), np.zeros(n), np.ones(n), [""] * n, 0.1, k, 4.0, 0.5)
    example, term = np.nonzero(dense)
    index.build(term, example, dense[example, term])
    q = np.where(rng.rand(90, width) < 0.1, rng.rand(90, width), 0)
    text, at = np.nonzero(q)
    got = index.nearest(np.searchsorted(text, np.arange(91)), at, q[text, at])
    want = q @ dense.T
    near = np.argsort(-got, axis=1, kind="stable")[:, :k]
    assert np.allclose(np.take_along_axis(np.maximum(got, 0), near, 1), -np.sort(-want, axis=1)[:, :k])
    assert (got < 0).any() and np.allclose(got[got >= 0], want[got >= 0])


# 7


def plain_join(rows):
    sets = {}
    for i, x in rows:
        w = alnum(x)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    links, root = Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (min(j for j in sets if sets[j] == sets[i]) if sets[i] else i, find(i), links[i]) for i in sets}


@pytest.mark.parametrize("small", [24, 2])
def test_ngram_join(spark, monkeypatch, small):
    """With small = 2 most buckets are crowds, dealt into blocks of five classes."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 5 if small == 2 else 500)
    texts = list(ODD)
    for _ in range(4):
        base = prose(120).split()
        for _ in range(9):
            own = list(base)
            for _ in range(RNG.randint(0, 3)):
                own[RNG.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [prose(60) for _ in range(20)] + texts[20:30] + ["A b, c"] * 3
    rows = list(enumerate(texts))
    df = table(spark, texts)
    got = {r.doc_id: (r.class_id, r.group_id, r.n_links) for r in ngram_join.near_duplicates(df).collect()}
    assert got == plain_join(rows)


def test_ngram_join_edges(spark):
    """Repeated rows, null ids, and an id with two texts: all are linked by their texts."""
    a, b, c = prose(30), prose(30), prose(30)
    df = spark.createDataFrame([(1, a), (1, a), (2, a), (2, b), (None, a), (None, c), (None, c + " "), (3, None), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.group_id, r.n_links) for r in ngram_join.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 1, 1, 3), (1, 1, 1, 3), (2, 1, 1, 3), (2, 2, 2, 0), (None, 1, 1, 3), (None, None, None, 1), (None, None, None, 1), (3, 3, 3, 0), (3, 3, 3, 0)], key=repr)
    assert ngram_join.near_duplicates(df.limit(0)).count() == 0
    left = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(df.withColumn("MARK", F.lit(1))).collect()), key=repr)
    assert len([x for x in left if x[0] is None]) == 1 and [x for x in left if x[0] is None][0][1].strip() == c.strip()
    assert [x for x in left if x[0] is not None] == sorted([(1, a), (2, b), (3, None), (3, None)], key=repr)


def test_recall_of_the_whole_join(spark):
    """Pairs at and just above the threshold, by construction: of 200 shingles each, 178 to 196 shared."""
    rng, rows = random.Random(3), []
    for i in range(400):
        base = [f"w{rng.randrange(10**9)}" for _ in range(204)]
        other = list(base)
        for k in rng.sample(range(6, 198, 8), rng.randint(1, 4)):
            other[k] = f"v{rng.randrange(10**9)}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    sets = {i: {tuple(w[k : k + 5]) for k in range(200)} for i, x in rows for w in [x.split()]}
    linked = [i for i in range(400) if len(sets[2 * i] & sets[2 * i + 1]) >= 0.8 * len(sets[2 * i] | sets[2 * i + 1])]
    found = {r.doc_id for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).filter("n_links > 0").collect()}
    assert len(linked) > 300 and not found - {x for i in linked for x in (2 * i, 2 * i + 1)}
    assert sum(2 * i in found for i in linked) >= 0.99 * len(linked)


def test_bands_reach_their_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.9), (0.9, 0.99)):
        b, r = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**r) ** b >= recall
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.01, 0.999, 10)


# 8


def test_quality(spark):
    items = ODD + [prose(80) for _ in range(40)] + ["a b c " * 30, "l1\nl1\n \nl1", "#$ %& | <x>", " ".join(w + "%%%" for w in prose(200).split())]
    docs = table(spark, items)
    clean = items[len(ODD) : len(ODD) + 40]
    ref = quality.learn(docs.filter((F.col("doc_id") >= len(ODD)) & (F.col("doc_id") < len(ODD) + 40)), reference_words=100)
    got = {r.doc_id: r for r in quality.judge(docs.withColumn("kept", F.lit(0)), ref).collect()}
    for i, x in enumerate(items):
        x = x or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        rep = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(rep)), x[:50]
        assert r.base_failed == (len(w) < 50 or 100 * len(rep) > 50 * len(w))
        assert not (r.kept and r.base_failed)
    assert not got[len(items) - 1].kept and all(got[i].kept for i in range(len(ODD), len(ODD) + 40))
    # Distances by the definition.
    chars = Counter(quality.CLASSES[quality._class(b)] for x in clean for c in x for b in c.encode()[:1])
    total = sum(chars.values())
    assert {"latin", "marks"} < set(quality.CLASSES)
    q = [chars[c] / total for c in quality.CLASSES]
    assert np.allclose(ref.classes[0], q)
    own = Counter(quality.CLASSES[quality._class(c.encode()[0])] for c in items[20])
    p = [own[c] / len(items[20]) for c in quality.CLASSES]
    js = sum(0.5 * a * math.log2(a / ((a + b) / 2)) for x, y in ((p, q), (q, p)) for a, b in zip(x, y, strict=True) if a)
    assert got[20].class_distance == pytest.approx(math.sqrt(js))
    words = Counter(w for x in clean for w in alnum(x))
    assert len(ref.common[0][0]) == sum(n >= 0.003 * sum(words.values()) for n in words.values())
    assert quality.judge(docs.limit(0), ref).count() == 0
    assert quality.judge(docs, quality.learn(docs.limit(0))).filter("class_distance IS NULL").count() == len(items)


def test_quality_with_thousands_of_languages(spark):
    """More languages than references: no plan grows with them, and the largest ones teach."""
    rows = [(i, f"word{i % 3} common " * (40 if i < 20 else 3), f"l{i}", "s", 1) for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")
    ref = quality.learn(docs, reference_words=5, most_languages=20)
    assert ref.languages == sorted(f"l{i}" for i in range(20)) and all(len(k) == 2 for k, _ in ref.common)
    assert quality.judge(docs.limit(30), ref).filter("word_distance IS NOT NULL").count() == 30


def test_quality_rejects_word_salad(spark):
    """Words are long runs of the language's syllables: the characters are right, but none of them is common."""
    rng = random.Random(8)
    common = [f"{a}{b}" for a in ("an", "the", "on") for b in ("er", "ti", "re", "sh", "ou")]
    rare = lambda: "".join(rng.choice(SYLLABLES[:8]) for _ in range(rng.randint(4, 7)))
    text = lambda n, share: " ".join(rng.choice(common) if rng.random() < share else rare() for _ in range(n))
    sizes = [50, 60, 80, 100, 200, 400, 1000, 5000]
    clean, salad = [text(n, 0.3) for n in sizes * 20], [text(n, 0) for n in sizes * 3]
    docs = table(spark, clean + salad + [text(49, 0)])
    ref = quality.learn(docs.filter(F.col("doc_id") < len(clean)))
    got = {r.doc_id: r for r in quality.judge(docs, ref).collect()}
    assert all(got[i].class_distance <= 0.3 and got[i].word_distance <= 0.5 for i in range(len(clean) + len(salad)))
    assert [i for i in range(len(clean)) if not got[i].kept] == []
    assert [i for i in range(len(clean), len(clean) + len(salad)) if got[i].kept] == []
    assert not got[len(clean) + len(salad)].kept and got[len(clean) + len(salad)].base_failed


# 9


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * RNG.randint(0, 30)), RNG.choice(["a", "b", "c", None, "d"]) if i % 3 else "hot") for i in range(600)] + [(9, None, "empty")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", mixing.size_of())
    got = mixing.copies(df, ["doc_id"]).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, x, s in rows:
        size[s] += len((x or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, left = set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in size if s not in full]
        level = (left - sum(2 * size[s] for s in full)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    target = {s: 2 * size[s] if s in full else level * weight[s] for s in size}
    taken = Counter()
    for r in got:
        assert r.copies <= 2 and r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source]
        taken[r.source] += r.copies * r.size
    for s in size:
        assert abs(taken[s] - target[s]) <= 60
    again = mixing.copies(df, ["doc_id"]).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mix_agrees_however_rows_lie(spark):
    """Rows that share id, size and source, some alike in all columns, over several layouts."""
    rows = [(i % 5, f"{'ab'[i % 2]} w{i % 7} x", "s", i % 3) for i in range(200)] + [(None, "n o n", None, 1), ("", None, "s", 1)][:1] * 9 + [(1, None, "s", 0), (1, "s", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, other int")
    seen = set()
    for n in (1, 2, 3, 5, 7):
        for order in ("text", "other"):
            lay = df.orderBy(order).repartition(n) if n > 1 else df.orderBy(F.desc(order)).coalesce(1)
            seen.add(tuple(sorted(map(repr, mixing.mix(lay).collect()))))
    assert len(seen) == 1
    (rows_out,) = seen
    assert any("text=None" in r or "source=None" in r for r in rows_out)


def test_mix_emits_what_it_takes(spark):
    df = spark.createDataFrame([(i, "w " * (i % 9), f"s{i % 2}") for i in range(100)] + [(1, "twin words", "s1")] * 3 + [(None, "no id", None)], "doc_id long, text string, source string")
    out = mixing.mix(df)
    assert out.columns == df.columns
    want = mixing.copies(df.select("doc_id", mixing.row_hash(df).alias("h"), "source", mixing.size_of().alias("size")), ["doc_id", "h"])
    assert out.count() == want.agg(F.sum("copies")).first()[0]
    assert mixing.mix(df.limit(0)).count() == 0


# 10


def plain_shards(rows, limit):
    h = {k: int(hashlib.md5(f"{'' if i is None else i}:{x or ''}".encode()).hexdigest()[:15], 16) for k, (i, x) in enumerate(rows)}
    out = {}

    def split(own, depth):
        held = sum(len((rows[k][1] or "").encode()) for k in own)
        if held <= limit or depth == 60:
            for k in own:
                out[k] = (f"{h[k]:060b}"[:depth], held)
            return
        for bit in (0, 1):
            part = [k for k in own if h[k] >> (59 - depth) & 1 == bit]
            if part:
                split(part, depth + 1)

    split(list(h), 0)
    return out


@pytest.mark.parametrize("limit", [10, 300, 10**9])
def test_sharding(spark, limit):
    rows = [(i, prose(RNG.randint(0, 12))) for i in range(150)] + [(None, None), (7, ""), (8, "x" * 500)] + [(9, "twin text")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("SHARD", F.lit(1))
    got = sharding.shard(df, limit).collect()
    want = sorted((i or -1, x or "", *s) for (i, x), s in zip(rows, plain_shards(rows, limit).values(), strict=True))
    rows_by = plain_shards(rows, limit)
    want = sorted((i if i is not None else -1, x or "", *rows_by[k]) for k, (i, x) in enumerate(rows))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", r.shard, r.shard_bytes) for r in got) == want
    load = {}
    for r in got:
        load.setdefault((r.shard, r.page), []).append(r.n_bytes)
    assert all(sum(x) <= limit or len([b for b in x if b]) == 1 for x in load.values())
    assert sharding.shard(df.limit(0)).count() == 0


# The pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sf = "/root/testdata/sf0.001"
    for name, stage in cp.STAGES[:3]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns, name
        if name == "ngram_jaccard_join":
            plain = plain_join([(r.doc_id, r.text) for r in docs.collect()])
            assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, g, _) in plain.items() if i == g)
        if name == "benchmark_decontamination":
            win = {tuple(w[j : j + 10]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in [alnum(r.text)] for j in range(max(1, len(w) - 9)) if w}
            clean = [r.doc_id for r in docs.collect() for w in [alnum(r.text)] if not any(tuple(w[a : a + n]) in win for n in {len(k) for k in win} for a in range(len(w)))]
            assert sorted(r.doc_id for r in kept.collect()) == sorted(clean)
        path = str(tmp_path / name)
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
    mixed = cp.mix(spark, docs, sf)
    assert mixed.columns == docs.columns and mixed.count() > docs.count()
    out = cp.shard(spark, mixed, sf)
    assert out.count() == mixed.count() and out.agg(F.max("shard_bytes")).first()[0] <= 1 << 20
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf).count() == 0


def plain_mix(rows):
    """Rows (id, text, lang, source, n) as often as systematic sampling takes them; ids are unique."""
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    held = Counter()
    for r in rows:
        held[r[3]] += size[r[0]]
    order = sorted((x for x in held if x is not None), key=lambda x: x.encode()) + [None] * (None in held)
    weight = {x: (3, 1, 2)[i % 3] for i, x in enumerate(order)}
    full, total = set(), 1.5 * sum(held.values())
    while True:
        free = [x for x in held if x not in full]
        level = (total - sum(2 * held[x] for x in full)) / sum(weight[x] for x in free) if free else 0
        over = {x for x in free if level * weight[x] > 2 * held[x]}
        if not over:
            break
        full |= over
    out = []
    for x in held:
        rate = (2 * held[x] if x in full else level * weight[x]) / held[x] if held[x] else 0
        u = int(hashlib.md5(("9" if x is None else f"9:{x}").encode()).hexdigest()[:13], 16) / 2**52
        for place, r in enumerate(sorted((r for r in rows if r[3] == x), key=lambda r: (size[r[0]], r[0]))):
            out += [r] * (math.floor((place + 1) * rate + u) - math.floor(place * rate + u))
    return out


def test_pipeline_from_end_to_end(spark):
    """run() against plain versions of its stages, each over what the one before keeps."""
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs.filter(~langid.held_out()))).collect()
    fits = {r.doc_id for r in found if r.lang_pred != "und" and r.score >= cp.LEAST_SCORE}
    rows = [r for r in rows if r[0] in fits]
    rows = [r for r, (i, (_, g, _)) in zip(rows, plain_join([(r[0], r[1]) for r in rows]).items(), strict=True) if i == g]
    win = {tuple(w[j : j + 10]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in [alnum(r.text)] for j in range(max(1, len(w) - 9)) if w}
    sizes = {len(k) for k in win}
    rows = [r for r in rows for w in [alnum(r[1])] if not any(tuple(w[a : a + n]) in win for n in sizes for a in range(len(w)))]
    rows = plain_mix(rows)
    shards = plain_shards([(r[0], r[1]) for r in rows], 1 << 20)
    want = sorted((*r, shards[k][0]) for k, r in enumerate(rows))
    got = cp.run(spark, sf)
    assert sorted((r.doc_id, r.text, r.lang, r.source, r.n_chars, r.shard) for r in got.collect()) == want
    assert 100 < len(want) and len(fits) > 190
