"""Centroid clustering, divergence of sources and page extraction against plain versions."""

import hashlib
import html
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import balltree, divergence, sitetree

RNG = random.Random(11)


# 11


def plain_clusters(rows, k=16, rounds=3, dims=64):
    kept = [(i, tuple(max(-balltree.HELD, min(balltree.HELD, math.floor(64 * x))) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [c for _, c in first]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        own = {}
        for _, x in kept:
            own.setdefault(near(x)[1], []).append(x)
        cents = [tuple(sum(col) // len(own[j]) for col in zip(*own[j])) if j in own else c for j, c in enumerate(cents)]
    found = [(i, *near(x)[::-1]) for i, x in kept]
    held = {}
    for _, j, d in found:
        held[j] = held.get(j, 0) + d
    return sorted((-1 if i is None else i, j, d, held[j], sum(held.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, j, d in found)


def vectors(n, spread=1.0):
    return [(i, [float(np.float32(RNG.gauss(0, spread) + (i % 3))) for _ in range(64)]) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 9, 300])
def test_clusters(spark, n):
    rows = vectors(n)
    if n == 300:
        rows += [(7, rows[3][1]), (None, rows[4][1]), (None, rows[5][1]), (301, None), (302, []), (303, [0.5] * 63), (304, [0.5] * 63 + [None]), (305, [float("nan")] * 64), (306, [float("inf")] + [0.0] * 63), (307, [0.0] * 65)]
        rows += [(308, [3.0e38] * 64), (309, [-3.0e38] * 64)] + [(310, rows[0][1])] * 40
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("Cluster", F.lit("x")).withColumn("id", F.lit(1)).repartition(3)
    got = balltree.digest(balltree.cluster(df)).collect()
    want = plain_clusters([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == want


@pytest.mark.parametrize("n", [1, 31, 64, 1000, balltree.BLOCK])
def test_tree_gives_the_sums_of_a_scan(n):
    rng = np.random.default_rng(n)
    x = (rng.normal(size=(n, 64)) * 2 + rng.integers(0, 4, size=(n, 1)) * 200).astype(np.int32)
    order, radii, sums = balltree.grow(x)
    assert sorted(order) == list(range(n)) and (sums[0] == x.sum(axis=0)).all()
    cents = np.concatenate([x[:3], np.full((2, 64), 200), np.full((2, 64), 200), rng.integers(-5, 900, size=(4, 64))]).astype(np.int64)
    counts, totals, compared = balltree.filtered(x[order], radii, sums, cents)
    best, _ = balltree.nearest(x, cents)
    assert (counts == np.bincount(best, minlength=len(cents))).all()
    assert all((totals[j] == x[best == j].sum(axis=0)).all() for j in range(len(cents)))
    assert compared <= n
    if n == balltree.BLOCK:  # far groups of vectors go as whole balls
        apart = np.stack([np.full(64, 200 * j) for j in range(4)]).astype(np.int64)
        assert balltree.filtered(x[order], radii, sums, apart)[2] < n / 10


def test_distances_of_large_components_are_exact():
    x = np.array([[balltree.HELD] * 64, [-balltree.HELD + 1] * 64, [5] * 64], dtype=np.int32)
    c = np.array([[-balltree.HELD] * 64, [3] * 64], dtype=np.int64)
    best, d = balltree.nearest(x, c)
    assert [(int(j), int(v)) for j, v in zip(best, d)] == [min((sum((int(a) - int(b)) ** 2 for a, b in zip(r, q)), j) for j, q in enumerate(c))[::-1] for r in x]


# 12


def plain_audit(rows, least=3, top=200):
    texts = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {x[0] for x in texts}:
        held = Counter(w for g, _, ws in texts if g == lang for w in set(ws))
        kept = [w for w, n in held.items() if n >= least]
        own = {s: Counter(w for g, t, ws in texts if (g, t) == (lang, s) for w in ws if held[w] >= least) for s in {x[1] for x in texts if x[0] == lang}}
        whole = sum(own.values(), Counter())

        def p(c, w):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        for s, c in own.items():
            got = [(sum((p(c, w) - p(d, w)) ** 2 // p(d, w) for w in kept), t) for t, d in own.items() if t != s]
            out += [(lang, s, "pair", t, v, i + 1) for i, (v, t) in enumerate(sorted(got, key=lambda x: (-x[0], x[1].encode())))]
            got = [((p(c, w) - p(whole, w)) ** 2 // p(whole, w), w) for w in kept if c[w] and p(c, w) > p(whole, w)]
            out += [(lang, s, "term", w, v, i + 1) for i, (v, w) in enumerate(sorted(got, key=lambda x: (-x[0], x[1].encode()))[:top])]
    return sorted(out)


def audited(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("TERM", F.lit(1)).withColumn("n", F.lit("x")).repartition(3)
    return sorted(tuple(r) for r in divergence.audit(df).collect())


def test_divergence(spark):
    words = ["the", "of", "Été", "ß", "日本", "run", "x", "RUN", "it's"] + [f"rare{chr(97 + i)}" for i in range(26)]
    rows = [(" ".join(RNG.choices(words, k=RNG.randint(0, 30))), RNG.choice(["en", "de"]), f"s{RNG.randint(0, 5)}") for _ in range(120)]
    rows += [(None, None, None), ("", "en", ""), ("a b a", None, "s1"), ("12 34", "fr", "s1"), ("12", "fr", "s2"), ("once", "xx", None), ("word " * 50000, "en", "s1")]
    rows += [("only here and here", "en", "s9")] * 40
    assert audited(spark, rows) == plain_audit(rows)
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_divergence_of_many_sources(spark):
    rows = [(" ".join(["all", *RNG.choices([f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)], k=8)]), "en", f"s{i % 40}") for i in range(400)]
    assert audited(spark, rows) == plain_audit(rows)


def test_dense_and_sparse_agree():
    rng = np.random.default_rng(3)
    count = rng.integers(0, 4, size=(50, 9)) * (rng.random((50, 9)) < 0.4)
    count[count.sum(axis=1) == 0, 0] = 1
    held = rng.integers(10, 10**6, size=9)
    term, group = np.nonzero(count)
    whole = divergence.dense(term, group, count[term, group], held, 0, 9)
    assert not (divergence.sparse(term, group, count[term, group], held, 0, 9) - whole)[~np.eye(9, dtype=bool)].any()
    part = np.concatenate([divergence.sparse(term, group, count[term, group], held, lo, min(9, lo + 4)) for lo in (0, 4, 8)])
    assert not (part - whole)[~np.eye(9, dtype=bool)].any()
    big = np.array([10**10, 5], dtype=np.int64)
    assert list(divergence.shares(big, np.array([3 * 10**10, 7 * 10**9]))) == [1 + 10**9 * (10**10 + 1) // (3 * 10**10), 1 + 10**9 * 6 // (7 * 10**9)]


def test_words_are_counted_exactly():
    raw = ["a b A", "b c", "", "été ÉTÉ été", "a"]
    data = [x.encode() for x in raw]
    texts = divergence.Texts(np.frombuffer(b"".join(data), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64))
    group, term, n, docs = divergence.count_words(texts, np.array([0, 1, 1, 0, 0]))
    assert sorted(zip(group.tolist(), term.to_pylist(), n.tolist(), docs.tolist())) == sorted([(0, "a", 3, 2), (0, "b", 1, 1), (0, "été", 2, 1), (0, "ÉtÉ", 1, 1), (1, "b", 1, 1), (1, "c", 1, 1)])


# 13


def text_of(page):
    return sitetree.kept(page, set())


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\nb"),
        ("<article><h1>T &amp; U</h1><p>one\n two&nbsp;three<br>four</p></article>out", "T & U\none two three four"),
        ("<p><b>bold <i>it</b> rest</i></p>", "bold it rest"),
        ("<article><p>x<script>var a='</p>';</script>y</p></article>", "xy"),
        ("<b><p>in</b> side</p>after</b>", "in side\nafter"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<nav>n</nav><header>h</header><aside>s</aside><form>f</form><div class='cookie-notice'>c</div><p>text</p><footer>&copy;</footer>", "text"),
        ("<article><header><h1>T</h1></header><p>x</p><div class=userComments>c</div><footer>f</footer></article>", "T\nx"),
        ("<div class='has-sidebar'><p>x</p></div><div id=sidebar2>s</div><p hidden>h</p><p style='display: none'>n</p>", "x"),
        ("<main><p>m</p><article><p>a</p></article></main>", "a"),
        ("<main><p>m</p></main><p>o</p>", "m"),
        ("<div role=main><p>m</p></div><p>o</p>", "m"),
        ("<div id=content><p>c</p></div><p>o</p>", "c"),
        ("<article></article><p>o</p>", "o"),
        ("a < b <3 & c<!-- x > --> d <!-- never", "a < b <3 & c d"),
        ("<p title=\"a > b\">x</p><p title=\"open>y</p>", "x\ny"),
        ("<p>x</p><di", "x"),
        ("<title>t<p>x</p>", "x"),
        ("<P CLASS=AD>ad</P><DIV>x</DIV></nothing></p>", "x"),
        ("<p>&lt;b&gt; &am &#x41;&#0;</p>", "<b> &am A\ufffd"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<p " * 5000, ""),
    ],
)
def test_blocks(page, want):
    assert text_of(page) == want


def phrase(n):
    return " ".join("".join(RNG.choices("abcdefghij", k=5)) for _ in range(n))


def site(n, declared=False):
    """Pages of a layout without telling names: a fixed menu, a rotating teaser, the text, a fixed line inside it, a fixed foot."""
    out = []
    for i in range(n):
        paragraphs = [phrase(12) for _ in range(RNG.randint(1, 5))]
        body = f"<h1>{phrase(3)} {i}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        note = "<div class=x4>Read our letter every week</div>"
        inner = f"<article>{body}{note}</article>" if declared else f"<div class=x2>{body}{note}</div>"
        page = f"<body><div class=x1><ul><li>Start</li><li>News</li><li>Item {i % 3}</li></ul></div>{inner}<div class=x3>All rights with us</div></body>"
        out.append((page, "\n".join(html.unescape(x) for x in re.findall(r"<(?:h1|p)>(.*?)</", body))))
    return out


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("TEXT", F.lit("clash")).withColumn("n_chars", F.lit("x")).withColumn("cut", F.lit(1)).repartition(3)
    return df, {r.page_id: r for r in sitetree.extract(df).collect()}


def test_site_tree_removes_what_a_host_repeats(spark):
    rows, want = [], {}
    for host, declared in (("a.example", False), ("b.example", True)):
        for page, text in site(40, declared):
            want[len(rows)] = text
            rows.append((len(rows), f"https://{host}/{len(rows)}", page))
    copies = len(rows)
    copied, text = site(1)[0]
    for i in range(60):  # copies, exact but for one paragraph, of one article make a host of their own
        rows.append((len(rows), "http://U:p@C.example:80/x", copied.replace("</h1>", f"</h1><p>edit {i}</p>") if i % 2 else copied))
    single = len(rows)
    rows += [(single, "http://one.example", site(1)[0][0]), (single + 1, None, site(1)[0][0]), (single + 2, None, None), (single + 3, "http://a.example/", ""), (None, "http://a.example/z", "<p>only</p>"), (7, rows[7][1], rows[7][2])]
    df, got = extracted(spark, rows)
    for i, t in want.items():
        assert got[i].text == t and got[i].n_chars == len(t), i
    for i in range(copies, single):
        assert text.split("\n")[-1] in got[i].text and text.split("\n")[0] in got[i].text
    assert "Start" in got[single].text and "Start" in got[single + 1].text and got[single + 2].text == "" and got[single + 3].text == "" and got[None].text == "only"
    assert sitetree.extract(df).count() == len(rows) and "TEXT" not in sitetree.extract(df).columns
    assert sitetree.extract(df.limit(0)).count() == 0


def test_importance_is_entropy(spark):
    """The tree's figures against sums over all pages, in plain words."""
    pages = [p for p, _ in site(12)] + [p for p, _ in site(3)] * 2
    df = spark.createDataFrame([("h", p) for p in pages], "host string, html string")
    nodes, texts = sitetree.tree(sitetree.seen(df))
    seen, layouts, parent = {}, {}, {}
    for p in pages:
        page = sitetree.Page(p)
        rank, blocks = page.chosen()
        head = page.heading(rank, blocks)
        for e, t in blocks:
            node, up, depth, _, _ = page.elements[e]
            seen.setdefault(node, {}).setdefault(t, set()).add(head)
            parent[node] = (up, depth)
        for x, s in zip(page.elements[1:], page.styles[1:]):
            layouts.setdefault(x[0], {}).setdefault(tuple(s), set()).add(head)
    got = {r.node: r for r in nodes.collect()}
    assert set(got) == set(seen)
    for node, held in seen.items():
        m = len(set().union(*held.values()))
        own = [(len(x), 1 - math.log(len(x)) / math.log(m)) for x in held.values()]
        up, depth = parent[node]
        some = [len(x) for x in layouts.get(up, {}).values()]
        p = -sum(n / sum(some) * math.log(n / sum(some), sum(some)) for n in some) if sum(some) > 1 else 0.0
        c = sum(n * v for n, v in own) / sum(n for n, _ in own)
        assert got[node].pages == m and got[node].content == pytest.approx(c) and (got[node].presentation or 0) == pytest.approx(p, abs=1e-9)
        assert got[node].weight == pytest.approx((1 - 0.9**depth) * p + 0.9**depth * c)
    assert {(r.node, r.item): r.n for r in texts.collect()} == {(node, sitetree.digest(t)): len(x) for node, held in seen.items() for t, x in held.items()}


def test_articles_of_the_test_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in sitetree.extract(df).collect()}
    for r in df.collect():
        article = re.sub(r"<br>|</?b>", " ", re.sub(r"</?(?:p|h1)>", "\n", r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]))
        assert got[r.page_id] == "\n".join(x for x in (" ".join(html.unescape(line).split()) for line in article.split("\n")) if x)
