"""Main text of web pages by a site style tree.

Pages of one host are merged into one tree. Its element nodes are the paths of block elements (tag and classes, digits alike); each
remembers the layouts (sequences of children, runs of like children folded) and the texts it was seen with, and on how many different pages. A
node's presentation importance is the entropy of its layouts, to the base of the number of pages; the content importance of a text is
1 - log n / log m for a text on n of a node's m pages (1: only here, 0: everywhere), that of a node the mean over what it holds. A node
at depth d below the body weighs (1 - 0.9^d) x its parent's presentation + 0.9^d x its content. On each page branches go whose node weighs
less than NODE, and single blocks whose own text weighs less than OWN in a node that stays.

What authors declare counts as certain in the tree: nothing that is named as navigation, header, footer, sidebar, notice, advert,
form, comment section or script weighs anything (NOISE_TAGS, NOISE_WORDS), and where a page declares its article (article, else main, else
role=main, else itemprop=articleBody or a name of REGION_NAMES) that is all that weighs; inside it, text is only taken for a notice of the site if its own content importance is below
DECLARED, nearly all articles having it. Pages with one heading (or, undeclared, one longest block) count as one page, so that copies of an article don't make it
look like a frame. A node needs evidence: 5 different pages (10 in a declared article) and 1/256 of the host's.

Every step is keyed by host and node or spread by rows: statistics are distinct narrow rows, counted with partial aggregates, so a host may
hold any share of the pages; what a host's tree rejects is at most some 256 x the blocks of a page, and meets the pages by a join on the host.

A block is text between block elements' edges; character references are decoded, white space (br too) becomes one space, blocks are joined
by a newline. Broken markup is read as browsers do: p, li, dt, dd, option and table cells end where the next begins, unknown end tags are ignored, an unfinished tag or comment
at the end goes. Defined results: a null or empty page has an empty text; a page without a host (null url) is judged by what it declares
alone; repeated rows are pages with one heading; an empty table gives no rows; input columns named text or n_chars give way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import schema, sliced, stored, without

DECAY = 0.9
NODE, OWN, DECLARED = 0.4, 0.2, 0.05
PAGES, ARTICLES, SHARE = 5, 10, 256

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes iframe noembed xmp".split())
NOISE_TAGS = frozenset("head nav footer aside form script style noscript template iframe object svg math button select textarea dialog menu canvas audio video noframes noembed datalist title option".split())
NOISE_ROLES = frozenset("navigation contentinfo complementary search form dialog alertdialog alert menu menubar toolbar banner".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget widgets footer share sharing social related recommended recommendations comment comments disqus replies respond".split()
)
#: Of these, what stands within a line and doesn't divide a block.
WITHIN = frozenset("script style template noscript iframe object svg math button select textarea canvas audio video datalist".split())
#: Names of a page's head, which an article may have too: there they hold its title.
HEAD_WORDS = frozenset("header masthead topbar banner".split())
#: Names that declare an article without its tag.
REGION_NAMES = frozenset("article article-body article-content post-content post-body entry-content main-content content story story-body main".split())
#: What ends where another of its kind begins, and how far up that is looked for.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select", "datalist"})}

_REST = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""([^\s"'<>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")
_MODIFIER = re.compile(r"^(?:has|with|no|without|is)[-_]", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def digest(*parts: object) -> int:
    """A 64-bit hash that is the same in every process."""
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(maxsize=1 << 14)
def _node(parent: int, sign: str) -> int:
    return digest(parent, sign)


@lru_cache(maxsize=1 << 12)
def _read_tag(tag: str, attrs: str) -> tuple[str, bool, bool, int]:
    """(sign, noise anywhere, noise outside an article, rank of the declaration of a main region; 0: none) of an element."""
    own = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in reversed(list(_ATTR.finditer(attrs)))} if attrs.strip(" /") else {}
    classes = own.get("class", "").split()
    names = [c for c in [*classes, *own.get("id", "").split()] if not _MODIFIER.match(c)]
    words = {w.lower().rstrip("0123456789") for c in names for w in _WORD.findall(c)}
    roles = {r.lower() for r in own.get("role", "").split()}
    region = {"article": 4, "main": 3}.get(tag) or (2 if "main" in roles else 1 if own.get("itemprop", "").lower() == "articlebody" or (tag in ("div", "section") and {c.lower() for c in names} & REGION_NAMES) else 0)
    hidden = "hidden" in own or own.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(own.get("style", "")))
    named = tag not in ("html", "body") and bool(words & NOISE_WORDS)
    noise = tag in NOISE_TAGS or hidden or named or bool(roles & NOISE_ROLES)
    head = tag == "header" or (tag not in ("html", "body") and bool(words & HEAD_WORDS))
    return tag + "".join("." + re.sub(r"\d+", "0", c) for c in sorted(classes)), noise, head, region


class Page:
    """The blocks of a page that no declaration turns away, and its layouts.

    blocks: (owner, text); an element is (node, parent's node, depth, region's rank, region's element or -1); styles: folded children by element.
    """

    def __init__(self, html: str):
        self.elements: list[tuple[int, int, int, int, int]] = [(0, 0, 0, 0, -1)]
        self.styles: list[list[str]] = [[]]
        self.blocks: list[tuple[int, str]] = []
        self.h1: dict[int, str] = {}
        self._read(html)

    def _read(self, html: str) -> None:
        stack = [("", 0, False, True)]  # tag, element, whether it or what is around it is noise, whether it is a block
        opened: dict[str, int] = {}
        parts: list[str] = []
        size, pos = len(html), 0

        def flush() -> None:
            if parts:
                text = " ".join("".join(parts).split())
                parts.clear()
                if text:
                    self.blocks.append((stack[-1][1], text))
                    if any(s[0] == "h1" for s in stack[-3:]):
                        self.h1.setdefault(self.elements[stack[-1][1]][4], text)

        def pop() -> None:
            tag, _, _, block = stack[-1]
            if block:
                flush()
            stack.pop()
            opened[tag] -= 1

        def close(kinds: set[str], stop: set[str]) -> None:
            if any(opened.get(k) for k in kinds):
                for at in range(len(stack) - 1, 0, -1):
                    if stack[at][0] in kinds:
                        while len(stack) > at:
                            pop()
                        return
                    if stack[at][0] in stop:
                        return

        while pos < size:
            lt = html.find("<", pos)
            text = html[pos : lt if lt >= 0 else size]
            if text and not stack[-1][2]:
                parts.append(unescape(text) if "&" in text else text)
            if lt < 0:
                break
            after = html[lt + 1 : lt + 2]
            if after == "!" or after == "?":
                end = html.find("-->", lt + 4) + 3 if html.startswith("<!--", lt) else html.find(">", lt) + 1
                if end < 3:
                    break
                pos = max(end, lt + 2)
                continue
            ending = after == "/"
            name = _NAME.match(html, lt + 1 + ending)
            if not name:
                if ending:  # a bogus comment
                    pos = html.find(">", lt) + 1 or size
                else:
                    if not stack[-1][2]:
                        parts.append("<")
                    pos = lt + 1
                continue
            tag, rest = name[0].lower(), _REST.match(html, name.end())
            if not rest:  # the page ends inside a tag
                break
            pos = rest.end()
            if ending:
                if opened.get(tag):
                    at = len(stack) - 1
                    while tag in INLINE and not stack[at][3] and stack[at][0] != tag:
                        at -= 1
                    if tag not in INLINE or stack[at][0] == tag:  # a line's mark doesn't end the block it is in
                        while stack[-1][0] != tag:
                            pop()
                        pop()
                elif tag == "p":
                    flush()
                continue
            if tag == "br" or tag == "hr":
                parts.append(" ") if tag == "br" else flush()
                continue
            if tag in VOID:
                continue
            inline = tag in INLINE or tag in WITHIN
            attrs = rest[0][:-1]
            if not attrs and tag in INLINE:
                stack.append((tag, stack[-1][1], stack[-1][2], False))
                opened[tag] = opened.get(tag, 0) + 1
                continue
            if not inline:
                flush()
                if opened.get("p"):
                    close({"p"}, set())
                if tag in CLOSES:
                    close(*CLOSES[tag])
            sign, noise, head, region = _read_tag(tag, attrs if len(attrs) < 1000 else attrs[:1000])
            _, up, noisy, _ = stack[-1]
            node, _, depth, rank, root = self.elements[up]
            noisy = noisy or noise or (head and not rank)
            if tag in RAW:
                stop = re.compile(f"</{tag}", re.I).search(html, pos)
                if stop:
                    end = html.find(">", stop.end())
                    pos = end + 1 if end >= 0 else size
                elif tag == "title":
                    pos = size if (end := html.find("<", pos)) < 0 else end
                else:
                    break
                continue
            element = up
            if not inline and not noisy:
                element = len(self.elements)
                if region > rank:  # a region starts a tree of its own
                    rank, root, node, depth = region, element, region, 0
                parent = node
                style = self.styles[up]
                if not style or style[-1] != sign:
                    style.append(sign)
                self.elements.append((_node(node, sign), parent, depth + 1, rank, root))
                self.styles.append([])
            stack.append((tag, element, noisy, not inline))
            opened[tag] = opened.get(tag, 0) + 1
        while len(stack) > 1:
            pop()
        flush()

    def chosen(self) -> tuple[int, list[tuple[int, str]]]:
        """(rank of the region the page declares, its blocks); 0 and all blocks where it declares none."""
        rank = max((self.elements[e][3] for e, _ in self.blocks), default=0)
        return rank, [b for b in self.blocks if self.elements[b[0]][3] == rank]

    def heading(self, rank: int, blocks: list[tuple[int, str]]) -> str:
        """What tells a page from copies of it."""
        if rank:
            for e, _ in blocks:
                if title := self.h1.get(self.elements[e][4]):
                    return title
        return max((t for _, t in blocks), key=len, default="")


_SEEN = schema("host string, style boolean, node long, parent long, depth int, declared boolean, item long, head long")


def seen(pages: DataFrame) -> DataFrame:
    """What each page (host, html) brings to the tree of its host: a row for each block's text and each element's layout."""
    names = _SEEN.fieldNames()[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, _ in sliced(batch, "html"):
                rows: list[tuple] = []
                own: list[int] = []
                for i, html in enumerate(piece.column(1).to_pylist()):
                    page = Page(html or "")
                    rank, blocks = page.chosen()
                    head = digest(page.heading(rank, blocks))
                    for e, text in blocks:
                        node, parent, depth, _, _ = page.elements[e]
                        rows.append((False, node, parent, depth, rank > 0, digest(text), head))
                    if not rank:
                        rows += [(True, x[0], x[1], x[2], False, digest(*s), head) for x, s in zip(page.elements[1:], page.styles[1:], strict=True)]
                    own += [i] * (len(rows) - len(own))
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(own, type=pa.int64())), *[pa.array(c, type=k) for c, k in zip(columns, [pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()], strict=True)]], names=["host", *names])

    return pages.mapInArrow(run, _SEEN)


def tree(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of seen() rows: nodes (host, node, declared, pages, all, presentation, content, weight) and texts (host, node, item, n, content, weight)."""
    rows = stored(rows.distinct(), "seen")
    every = rows.groupBy("host").agg(F.count_distinct("head").alias("all"))
    text = rows.filter(~F.col("style"))
    items = text.groupBy("host", "node", "parent", "depth", "declared", "item").agg(F.count(F.lit(1)).alias("n"))
    pages = text.groupBy("host", "node").agg(F.count_distinct("head").alias("pages"))
    layout = rows.filter("style").groupBy("host", "node", "item").agg(F.count(F.lit(1)).alias("n"))
    layout = layout.groupBy("host", "node").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    entropy = F.when(F.col("n") > 1, (F.log("n") - F.col("nlogn") / F.col("n")) / F.log("n")).otherwise(F.lit(0.0))
    layout = layout.select("host", F.col("node").alias("parent"), F.greatest(entropy, F.lit(0.0)).alias("presentation"))
    held = items.join(pages, ["host", "node"]).join(layout, ["host", "parent"], "left").join(every, "host")
    content = F.when(F.col("pages") > 1, 1 - F.log("n") / F.log("pages")).otherwise(F.lit(1.0))
    near = F.pow(F.lit(DECAY), F.col("depth"))
    weigh: Column = F.when(F.col("declared"), F.col("content")).otherwise((1 - near) * F.coalesce("presentation", F.lit(0.0)) + near * F.col("content"))
    held = stored(held.withColumn("content", content).withColumn("weight", weigh), "texts")
    nodes = held.groupBy("host", "node", "declared", "pages", "all").agg(F.max("presentation").alias("presentation"), (F.sum(F.col("n") * F.col("content")) / F.sum("n")).alias("content"), (F.sum(F.col("n") * F.col("weight")) / F.sum("n")).alias("weight"))
    return nodes, held.select("host", "node", "declared", "pages", "all", "item", "n", "content", "weight")


def rejected(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(host, cut): what the host's tree turns away, a list of (node, text); a null text is the whole branch."""
    known = (F.col("pages") >= F.when(F.col("declared"), ARTICLES).otherwise(PAGES)) & (F.col("pages") * SHARE >= F.col("all"))
    low = nodes.filter(known & ~F.col("declared") & (F.col("weight") < NODE)).select("host", "node", F.lit(None).cast("long").alias("item"))
    own = texts.filter(known & (F.col("weight") < F.when(F.col("declared"), DECLARED).otherwise(OWN))).select("host", "node", "item")
    return low.unionByName(own).groupBy("host").agg(F.collect_set(F.struct("node", "item")).alias("cut"))


def kept(html: str, cut: set[tuple[int, int | None]]) -> str:
    page = Page(html)
    _, blocks = page.chosen()
    out = []
    for e, text in blocks:
        node = page.elements[e][0]
        if not cut or ((node, None) not in cut and (node, digest(text)) not in cut):
            out.append(text)
    return "\n".join(out)


def host_of(url: str) -> Column:
    """A url's host, empty for none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages, without their html, with text and n_chars, its code points."""
    own = without(pages, ["text", "n_chars", html_col])
    columns = own.columns
    tagged = pages.select(host_of(url_col).alias("site__host"), F.col(f"`{html_col}`").alias("site__html"), *[F.col(f"`{c}`") for c in columns])
    rows = seen(tagged.filter(F.col("site__host") != "").select(F.col("site__host").alias("host"), F.col("site__html").alias("html")))
    cut = stored(rejected(*tree(rows)).withColumnsRenamed({"host": "site__of", "cut": "site__cut"}), "cut")
    met = tagged.join(cut, F.col("site__host") == F.col("site__of"), "left").select(*[F.col(f"`{c}`") for c in columns], "site__of", "site__cut", "site__html")
    out = T.StructType([*own.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str | None, set[tuple[int, int | None]]] = {None: set()}
        for batch in batches:
            for piece, _ in sliced(batch, "site__html"):
                hosts = piece.column(len(columns)).to_pylist()
                texts = []
                for i, html in enumerate(piece.column(len(columns) + 2).to_pylist()):
                    if hosts[i] not in sets:
                        if len(sets) > 256:
                            sets = {None: set()}
                        sets[hosts[i]] = {(x["node"], x["item"]) for x in piece.column(len(columns) + 1)[i].as_py()}
                    texts.append(kept(html or "", sets[hosts[i]]))
                column = pa.array(texts, type=pa.string())
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(columns)], column, pa.array(np.array([len(t) for t in texts], dtype=np.int64))], names=out.fieldNames())

    return met.mapInArrow(run, out)
