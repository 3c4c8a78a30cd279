"""Text functions as Column expressions. Patterns run with Unicode classes and Unix lines, as rx() makes them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, limits and messages that results depend on.
TERMINAL = "。！？.!?」』）)]"
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
HEADER = r"^#{1,6}\s+\S"
BULLET = r"^\s*[-*+]\s+\S"
NUMBERED = r"^\s*\d+\.\s+\S"
BOLD = r"\*\*.+?\*\*|__.+?__"
TABLE = r"\|.+\|"
RULE = r"^\s*---+\s*$"
THINK = r"<think>(.*?)</think>"
KANJI = r"[\x{4e00}-\x{9fff}]"
CJK_RUN = r"[\x{4e00}-\x{9fff}\x{3040}-\x{309f}\x{30a0}-\x{30ff}]+"
WEEKDAYS = ("月", "火", "水", "木", "金", "土", "日")


def rx(pattern: str, flags: str = "") -> str:
    """A Java pattern with Unicode classes and \\n as the only line end."""
    return f"(?dU{flags}){pattern}"


def one_of(ranges: str) -> str:
    """A Java class of ranges of characters (as a-z, \\x7f-\\x{9f}). Below U+0100 it names each: these are looked up as bits, ranges tried in turn."""
    sign = r"\\x\{[0-9a-f]+\}|\\x[0-9a-f]{2}|[^\\]"
    point = lambda x: int(x.strip("\\x{}"), 16) if len(x) > 1 else ord(x)
    out = []
    for a, b in re.findall(f"({sign})(?:-({sign}))?", ranges):
        lo, hi = point(a), point(b or a)
        out += [rf"\x{{{p:x}}}" for p in range(lo, min(hi, 255) + 1)]
        if hi > 255:
            out.append(rf"\x{{{max(lo, 256):x}}}-\x{{{hi:x}}}")
    return "".join(out)


def like(c: Column, pattern: str, flags: str = "") -> Column:
    return c.rlike(rx(pattern, flags))


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def full(c: Column) -> Column:
    """Null where empty."""
    return F.when(c != "", c)


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(c, F.lit(WHITE))


def ends_in(c: Column, signs: str = TERMINAL) -> Column:
    """Whether the last character is one of these."""
    return F.right(c, F.lit(1)).isin(*signs)


def last_line(c: Column) -> Column:
    return strip(F.substring_index(c, "\n", -1))


def looks_truncated(answer: Column) -> Column:
    a = strip(text(answer))
    last = last_line(a)
    return (
        F.when(a == "", True)
        .when(ends_in(a), False)
        .when(like(last, HEADER), True)
        .when(F.contains(last, F.lit("|")) & ~F.endswith(last, F.lit("|")), True)
        .when(ends_in(last, "、，,：:"), True)
        .when(F.right(last, F.lit(1)).rlike(KANJI) & (F.length(a) > 200), True)
        .otherwise(False)
    )


def record_truncated(finish_reason: Column, answer: Column, loop_counts: bool = True) -> Column:
    """loop_counts: a tool loop that ran out is complete."""
    ends = ["stop", "tool_loop_exhausted"] if loop_counts else ["stop"]
    return F.when(finish_reason == "length", True).when(finish_reason.isin(ends), False).otherwise(looks_truncated(answer))


def has_markdown(c: Column) -> Column:
    t = text(c)
    marks = like(t, HEADER, "m") | like(t, BULLET, "m") | like(t, NUMBERED, "m") | like(t, BOLD) | like(t, TABLE) | like(t, RULE, "m")
    return (strip(t) != "") & marks


def qa_short_violation(c: Column, most: int = 200) -> Column:
    return (F.length(text(c)) > most) | like(text(c), BOLD)


def think_leak(c: Column) -> Column:
    return like(text(c), r"<(?:/)?redacted_thinking>")


def sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(text(c), r"[。！？\n]"), strip), lambda s: s != "")


def sentence_count(c: Column) -> Column:
    return F.size(sentences(c))


def extract_thinking(c: Column) -> Column:
    """Struct (thinking, body): the first block's inside, null if there is none, and the text without all blocks."""
    inside = F.when(like(c, THINK, "s"), strip(F.regexp_extract(c, rx(THINK, "s"), 1)))
    return F.struct(inside.alias("thinking"), strip(F.regexp_replace(c, rx(THINK, "s"), "")).alias("body"))


def empty_think_delta(c: Column) -> Column:
    return strip(c).isin("</think>", "<think></think>")


def strip_think(c: Column) -> Column:
    """Without complete blocks, stray closing tags, and what follows an opening tag that nothing closes."""
    body = strip(F.regexp_replace(text(c), rx(THINK, "s"), ""))
    body = F.replace(body, F.lit("</think>"), F.lit(""))
    return strip(F.regexp_replace(body, rx("<think>.*$", "s"), ""))


def sanitize_thinking(c: Column) -> Column:
    """A trace without tags; null if nothing is left."""
    return full(strip(F.regexp_replace(text(c), rx("</?think>"), "")))


def clip_middle(c: Column, head: int = 500, tail: int = 500) -> Column:
    return F.when(F.length(c) <= head + tail, c).otherwise(F.concat(F.left(c, F.lit(head)), F.lit("\n...\n"), F.right(c, F.lit(tail))))


def clip(c: Column, n: int) -> Column:
    """The first n characters and an ellipsis where there are more."""
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("…"))).otherwise(c)


def clip_within(c: Column, n: int) -> Column:
    """As clip(), n with the ellipsis."""
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n - 1)), F.lit("…"))).otherwise(c)


def snippet(c: Column, query: str, most: int = 200) -> Column:
    """The text around the first place of the query's first term that occurs, or of its first character that does."""
    terms = [t for t in query.strip().split()]
    low = F.lower(c)

    def first(parts: list[str]) -> Column:
        found = [F.when(F.locate(p.lower(), low) > 0, F.locate(p.lower(), low)) for p in parts]
        return F.coalesce(*found, F.lit(None).cast("int"))

    place = F.coalesce(first(terms) if terms else F.lit(None).cast("int"), first(list(query.strip())) if query.strip() else F.lit(None).cast("int")) - 1
    start0 = F.greatest(F.lit(0), place - most // 2)
    end = F.least(F.length(c), start0 + most)
    start = F.when(end - start0 < most, F.greatest(F.lit(0), end - most)).otherwise(start0)
    cut = F.concat(F.when(start > 0, "…").otherwise(""), F.substring(c, start + 1, end - start), F.when(end < F.length(c), "…").otherwise(""))
    return F.when(text(c) == "", "").when(F.length(c) <= most, c).when(place.isNull(), clip_within(c, most)).otherwise(cut)


def tokenize(c: Column) -> Column:
    """Lower-case ASCII words in order, then of each CJK run its characters and its pairs of characters."""
    low = F.lower(text(c))
    words = F.regexp_extract_all(low, F.lit("[a-z0-9]+"), F.lit(0))
    runs = F.regexp_extract_all(low, F.lit(CJK_RUN), F.lit(0))

    def grams(run: Column) -> Column:
        return F.concat(F.regexp_extract_all(run, F.lit("(?s)."), F.lit(0)), F.regexp_extract_all(run, F.lit("(?s)(?=(..))"), F.lit(1)))

    return F.concat(words, F.flatten(F.transform(runs, grams)))


def sanitize(c: Column) -> Column:
    """Line ends as \\n, and no control characters but tab and line feed."""
    return F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), r"[\x00-\x08\x0b-\x1f]", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, rx(r"[\s\x1c-\x1f]+"), " "))


def fnv_key(*parts: Column) -> Column:
    """FNV-1a of 32 bits over the parts' code points, joined by U+001E, in base 36."""
    joined = F.concat_ws("\x1e", *[text(p) for p in parts])
    points = F.transform(F.regexp_extract_all(joined, F.lit("(?s)."), F.lit(0)), lambda ch: F.ascii(ch).cast("long"))
    h = F.aggregate(points, F.lit(2166136261).cast("long"), lambda acc, x: (acc.bitwiseXOR(x) * F.lit(16777619)).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.lower(F.conv(h.cast("string"), 10, 36))


def parse_duration(c: Column) -> Column:
    """Seconds of texts such as 1h30m; null where there is nothing to read."""
    n = {u: F.transform(F.regexp_extract_all(c, F.lit(rf"(\d+)\s*{u}"), F.lit(1)), lambda x: x.cast("long")) for u in "hms"}
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
    return F.when(c.rlike(r"\d+\s*[hms]"), total(n["h"]) * 3600 + total(n["m"]) * 60 + total(n["s"]))


def format_duration(seconds: Column) -> Column:
    s = F.greatest(F.lit(0), seconds.cast("long"))
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    part = lambda x, u: F.when(x > 0, F.concat(x.cast("string"), F.lit(u))).otherwise("")
    return F.concat(part(h, "h"), part(m, "m"), F.when((r > 0) | ((h == 0) & (m == 0)), F.concat(r.cast("string"), F.lit("s"))).otherwise(""))


def date_context(ts: Column) -> Column:
    """The sentence that tells a model the date in Tokyo; ts is UTC."""
    local = F.from_utc_timestamp(ts, "Asia/Tokyo")
    day = F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(local) + 1)
    return F.concat(F.lit("今日は "), F.date_format(local, "yyyy年MM月dd日"), F.lit(" ("), day, F.lit(") です。タイムゾーンは Asia/Tokyo です。"))


def overflow_characters(c: Column) -> Column:
    """How many characters an error message says a prompt has."""
    said = F.regexp_extract(c, r"(?i)prompt contains (\d+) characters", 1)
    value = F.regexp_extract(c, r'(?i)"parameter"\s*:\s*"input_text"\s*,\s*"value"\s*:\s*(\d+)', 1)
    return F.coalesce(full(said), full(value)).cast("long")


def overflow_tokens(c: Column) -> Column:
    return full(F.regexp_extract(c, r"(?i)prompt contains at least (\d+) input tokens", 1)).cast("long")


def is_overflow(c: Column) -> Column:
    low = F.lower(c)
    said = F.contains(low, F.lit("maximum context length")) | F.contains(low, F.lit("input_tokens")) | (F.contains(low, F.lit("prompt contains")) & F.contains(low, F.lit("characters")))
    return said | overflow_tokens(c).isNotNull() | overflow_characters(c).isNotNull()


def effective_max_tokens(requested: Column, model_len: Column, prompt_tokens: Column, margin: int = 32, least: int = 64) -> Column:
    """What is left of the context for an answer, no more than requested and no less than `least`."""
    return F.least(requested, F.greatest(F.lit(least), model_len - prompt_tokens - margin))


def input_char_budget(model_len: Column, max_tokens: Column, per_token: int = 128) -> Column:
    return F.greatest(F.lit(0), model_len - max_tokens) * per_token


def bumped_max_tokens(current: Column, cap: Column) -> Column:
    """Half as much again, at least one more, at most the cap."""
    return F.least(F.greatest(F.floor(current * 1.5), current + 1), cap)


def backoff_delay(attempt: Column, base: float = 1.0, most: float = 60.0) -> Column:
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt))
