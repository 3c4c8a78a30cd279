"""Versioned quality signals: each gives a score from 0 to 1, a raw value as text, and whether it rejects outright."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import parse
from . import text as t

# The patterns that results depend on.
TEMPLATE_LEAKS = (r"<\|im_start\|>", r"<\|redacted_im_end\|>", r"<\|endoftext\|>", r"<\|im_end\|>", r"\nim_start\|", r"\nassistant\n", r"\nuser\n")
FACT_NUMBER = r"(?:\d+\s*℃|\d+\s*度|\d+\s*mm|\d+\s*%|\d{1,2}:\d{2})"
VIRTUAL_DATA = r"(?:仮想データ|架空|推測値|（例）|\(例\)|サンプルデータ|ダミーデータ)"
#: What that pattern matches, word by word; none of the characters has another case.
VIRTUAL_WORDS = ("仮想データ", "架空", "推測値", "（例）", "(例)", "サンプルデータ", "ダミーデータ")
PROSE_MARKS = r"(?:```|^\s*[-*+]\s|^\s*\d+\.\s|\|[^\n]+\||^\s*#{1,6}\s)"
ACTION_CLAIM = r"(?:検索した|調べた|確認した|調査した|参照した|web(?:で|を|上で)|インターネットで|ネットで|I searched|I looked up|I found online|according to (?:my )?search)"
TOOL_INTENT = (
    r"(use\s+(?:search|calc|fetch_url|the)\s+function|call\s+(?:search|calc|fetch_url)\b|"
    r"(?:we|let's|should|will)\s+(?:use|call)\s+(?:search|calc|fetch_url|a\s+search)|"
    r"search\s+function|fetch_url|tool\s+(?:usage|function)|検索ツール|ツールで|ツールを使|関数を呼|web_search|<tool_call\b)"
)
# The script that answers are written in.
JAPANESE = r"\x{3040}-\x{30ff}\x{4e00}-\x{9fff}"


@dataclass(frozen=True)
class Limits:
    """The thresholds of the signals."""

    len_a: tuple[int, int] = (30, 4000)
    len_t: tuple[int, int] = (20, 8000)
    ratio: tuple[float, float] = (0.05, 10.0)
    ratio_good: tuple[float, float] = (0.5, 3.0)
    script: str = JAPANESE
    script_share: float = 0.6
    repeat_ng: float = 0.25
    repeat_run: int = 30
    style_rules: dict[str, dict] = field(default_factory=dict)


@dataclass(frozen=True)
class Signal:
    """build(limits) gives (score, raw, hard)."""

    code: str
    version: str
    build: Callable[[Limits], tuple[Column, Column, Column]]

    def result(self, limits: Limits) -> Column:
        score, raw, hard = self.build(limits)
        return F.struct(F.lit(self.code).alias("code"), F.lit(self.version).alias("version"), score.cast("double").alias("score"), raw.cast("string").alias("raw"), F.coalesce(hard, F.lit(False)).alias("hard"))


def answer() -> Column:
    return t.text(F.col("answer"))


def trace() -> Column:
    return F.coalesce(t.full(F.col("thinking_trace")), t.full(F.col("reasoning")), F.lit(""))


def whole() -> Column:
    a, tt = answer(), trace()
    return F.when((tt != "") & (a != ""), F.concat(tt, F.lit("\n"), a)).when(tt != "", tt).otherwise(a)


def thinking() -> Column:
    return F.coalesce(F.col("mode") == "thinking", F.lit(False))


def _yes(good: Column, raw: Column) -> tuple[Column, Column, Column]:
    return F.when(good, 1.0).otherwise(0.0), raw, ~good


def _only(when: Column, found: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """Neutral elsewhere."""
    return F.when(when, found[0]).otherwise(1.0), F.when(when, found[1]), when & found[2]


def _span(n: Column, lo: int, hi: int) -> tuple[Column, Column, Column]:
    mid = (lo + hi) / 2
    half = max(1.0, (hi - lo) / 2)
    return F.greatest(F.lit(0.0), 1 - F.abs(n - mid) / half), n, (n < lo) | (n > hi)


def _ratio(x: Limits) -> tuple[Column, Column, Column]:
    r = F.try_divide(F.length(trace()), F.length(answer()))
    empty = answer() == ""
    score = F.when(empty, 0.0).when(r.between(*x.ratio_good), 1.0).otherwise(0.5)
    return _only(thinking(), (score, F.when(~empty, r), empty | (r < x.ratio[0]) | (r > x.ratio[1])))


def _truncated(x: Limits) -> tuple[Column, Column, Column]:
    reason = F.col("finish_reason")
    guess = t.looks_truncated(answer()) & ~F.coalesce(reason == "tool_loop_exhausted", F.lit(False))
    bad = F.when(reason == "length", True).when(reason == "stop", False).otherwise(guess)
    return _yes(~bad, F.when(reason.isin("length", "stop"), reason).when(bad, "heuristic").otherwise("ok"))


def _think_tags(x: Limits) -> tuple[Column, Column, Column]:
    both = F.concat(answer(), t.text(F.col("thinking_trace")))
    opened, closed = F.regexp_count(both, F.lit("<think>")), F.regexp_count(both, F.lit("</think>"))
    return _only(thinking(), _yes(opened == closed, F.concat_ws("/", opened.cast("string"), closed.cast("string"))))


def _language(x: Limits) -> tuple[Column, Column, Column]:
    bare = F.regexp_replace(answer(), t.rx(r"[\s\p{P}]+"), "")
    share = F.coalesce(F.try_divide(F.length(F.regexp_replace(bare, f"[^{t.one_of(x.script)}]+", "")), F.length(bare)), F.lit(0.0))
    return share, share, (share < x.script_share) | (share <= 0)


def _repeat_grams(x: Limits) -> tuple[Column, Column, Column]:
    share = parse.repeat_share(answer())
    return _only(F.length(answer()) >= 8, (1 - share, share, share > x.repeat_ng))


def longest_run(c: Column) -> Column:
    runs = F.transform(F.regexp_extract_all(c, F.lit(r"(?s)((.)\2+)"), F.lit(1)), F.length)
    return F.when(c == "", 0).otherwise(F.coalesce(F.array_max(runs), F.lit(1)))


def _repeat_run(x: Limits) -> tuple[Column, Column, Column]:
    run = longest_run(answer())
    return F.when(run <= 5, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - (run - 5) / 50)), run, run > x.repeat_run


def _style(x: Limits) -> tuple[Column, Column, Column]:
    score, hard = F.lit(1.0), F.lit(False)
    for style, rule in x.style_rules.items():
        mine = F.col("style_id") == style
        own = style_adherence(answer(), rule)
        score = F.when(mine, own).otherwise(score)
        hard = F.when(mine, own < rule.get("least", 0.3)).otherwise(hard)
    return score, score, hard


def style_adherence(c: Column, rule: dict) -> Column:
    """0.7 of the share of sentences that end as the rule says plus 0.3 of the share of its keywords that occur."""
    parts = t.sentences(c)
    fits = F.size(F.filter(parts, lambda s: t.like(s, "|".join(rule["endings"]))))
    share = F.when(F.size(parts) > 0, F.try_divide(fits, F.size(parts))).otherwise(0.0)
    words = rule.get("keywords", ())
    if not words:
        return share
    hits = sum((F.contains(c, F.lit(w)).cast("int") for w in words), F.lit(0))
    return F.when(F.size(parts) > 0, 0.7 * share + 0.3 * F.least(F.lit(1.0), hits / len(words))).otherwise(0.0)


def has_tools() -> Column:
    return F.coalesce(F.size(F.col("tools")), F.lit(0)) > 0


def has_calls() -> Column:
    return F.coalesce(F.exists("tool_calls", lambda c: c["name"].isNotNull() & ~c["name"].isin("", "<malformed>")), F.lit(False))


def _tools(pattern: str, where: Callable[[], Column]) -> Callable[[Limits], tuple[Column, Column, Column]]:
    return lambda x: _only(has_tools() & ~has_calls(), _yes(~t.like(where(), pattern, "i"), t.full(F.regexp_extract(where(), t.rx(f"({pattern})", "i"), 1))))


def _leak(x: Limits) -> tuple[Column, Column, Column]:
    n = F.coalesce(F.size("suspected_unparsed_tool_calls"), F.lit(0))
    n = F.when(n > 0, n).otherwise(0)
    return _yes(n == 0, n)


def _format(x: Limits) -> tuple[Column, Column, Column]:
    style = F.col("style_id")
    bad = (
        F.when(parse.triple_repeat(answer()), "triple_repeat")
        .when((style == "prose") & (t.has_markdown(answer()) | t.like(answer(), PROSE_MARKS, "m")), "markdown")
        .when((style == "qa_short") & t.qa_short_violation(answer()), "qa_short")
        .when((style == "dialog") & (t.think_leak(answer()) | t.has_markdown(answer())), "dialog")
    )
    return _yes(bad.isNull(), bad)


def ends_well(c: Column) -> Column:
    a = t.strip(t.text(c))
    fences = F.regexp_count(a, F.lit("```"))
    return (a != "") & (fences % 2 == 0) & (F.endswith(a, F.lit("```")) | t.ends_in(a))


def control_issue(c: Column) -> Column:
    """What the first character is that no text should have; null if there is none."""
    bad = "[" + t.one_of(r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}\x{fffd}\x{e000}-\x{f8ff}\x{f0000}-\x{10ffff}") + "]"
    first = t.full(F.regexp_extract(c, f"({bad})", 1))
    return (
        F.when(first.isNull(), F.lit(None))
        .when(first.rlike(r"[\x00-\x1f\x7f-\x{9f}]"), F.concat(F.lit("ctrl:"), F.ascii(first).cast("string")))
        .when(first.rlike(r"\x{fffd}"), "replacement_char")
        .when(first.rlike(r"[\x{e000}-\x{f8ff}]"), "private_use")
        .otherwise("supplementary_private")
    )


def template_leak(c: Column) -> Column:
    """The first of the patterns that occurs; one pass, which stops at no other signs than they begin with, tells whether any does."""
    return F.when(t.like(c, rf"(?=[<\n])(?:{'|'.join(TEMPLATE_LEAKS)})", "i"), F.coalesce(*[F.when(t.like(c, p, "i"), F.lit(p)) for p in TEMPLATE_LEAKS]))


def _virtual(x: Limits) -> tuple[Column, Column, Column]:
    # Looking for bytes is many times faster than a pattern.
    said = reduce(or_, (F.contains(answer(), F.lit(w)) for w in VIRTUAL_WORDS))
    return _yes(~said, F.when(said, t.full(F.regexp_extract(answer(), t.rx(f"({VIRTUAL_DATA})", "i"), 1))))


def _none(issue: Column) -> tuple[Column, Column, Column]:
    return _yes(issue.isNull(), issue)


def _either(find: Callable[[Column], Column]) -> Callable[[Limits], tuple[Column, Column, Column]]:
    return lambda x: _none(F.coalesce(find(whole()), find(t.text(F.col("prompt")))))


SIGNALS: dict[str, Signal] = {
    s.code: s
    for s in (
        Signal("LEN-A", "v1", lambda x: _span(F.length(answer()), *x.len_a)),
        Signal("LEN-T", "v1", lambda x: _only(thinking(), _span(F.length(trace()), *x.len_t))),
        Signal("RATIO-TA", "v1", _ratio),
        Signal("TRUNC", "v2", _truncated),
        Signal("THINK-TAG", "v1", _think_tags),
        Signal("LANG-JA", "v1", _language),
        Signal("REPEAT-NG", "v1", _repeat_grams),
        Signal("REPEAT-CHAR", "v1", _repeat_run),
        Signal("STYLE-ADH", "v1", _style),
        Signal("TOOL-PLAN", "v1", _tools(TOOL_INTENT, trace)),
        Signal("TOOL-CLAIM", "v1", _tools(ACTION_CLAIM, answer)),
        Signal("TOOL-LEAK", "v1", _leak),
        Signal("FACT-HALL", "v1", _tools(FACT_NUMBER, answer)),
        Signal("VIRT-DATA", "v1", _virtual),
        Signal("STYLE-FMT", "v1", _format),
        Signal("END-WELL", "v1", lambda x: _yes(ends_well(whole()), ends_well(whole()))),
        Signal("CTRL-CHAR", "v1", _either(control_issue)),
        Signal("TPL-LEAK", "v1", _either(template_leak)),
        Signal("SYNTAX-BREAK", "v1", lambda x: _none(parse.syntax_break(whole()))),
    )
}
#: The two lists that runs use; DUP-GLOB (operators.dedup) and SAMP-OUT (operators.score) look at all records.
STAT = ("LEN-A", "LEN-T", "RATIO-TA", "TRUNC", "THINK-TAG", "LANG-JA", "REPEAT-NG", "REPEAT-CHAR", "STYLE-ADH", "TOOL-PLAN", "TOOL-CLAIM", "TOOL-LEAK", "FACT-HALL", "VIRT-DATA", "STYLE-FMT")
SCREENING = ("THINK-TAG", "END-WELL", "TRUNC", "REPEAT-NG", "REPEAT-CHAR", "CTRL-CHAR", "LANG-JA", "LEN-A", "LEN-T", "TPL-LEAK", "SYNTAX-BREAK")
#: The screening rule that a signal stands for.
RULES = {"THINK-TAG": "R-01", "END-WELL": "R-02", "TRUNC": "R-02", "REPEAT-NG": "R-03", "REPEAT-CHAR": "R-03", "CTRL-CHAR": "R-04", "LANG-JA": "R-05", "LEN-A": "R-06", "LEN-T": "R-06", "TPL-LEAK": "R-08", "SYNTAX-BREAK": "R-09"}

_BLANK = {
    "prompt": "string", "answer": "string", "mode": "string", "thinking_trace": "string", "reasoning": "string", "finish_reason": "string", "style_id": "string",
    "tools": "array<string>", "tool_calls": "array<struct<name:string>>", "suspected_unparsed_tool_calls": "array<string>",
}


def evaluate(records: DataFrame, codes: Iterable[str] = STAT, limits: Limits | None = None) -> DataFrame:
    """records with signals, an array of (code, version, score, raw, hard); columns they lack count as null."""
    limits = limits or Limits()
    missing = {c: F.lit(None).cast(k) for c, k in _BLANK.items() if c not in records.columns}
    found = records.withColumns(missing).withColumn("signals", F.array(*[SIGNALS[c].result(limits) for c in codes]))
    return found.drop(*missing)


# The keys of a judge's rubrics.
HEALTH_KEYS, PROMPT_HEALTH_KEYS = tuple(f"L-0{i}" for i in range(1, 6)), tuple(f"P-0{i}" for i in range(1, 6))


def judged(code: str, version: str, score: Column, raw: Column, hard: Column | None = None) -> Column:
    """A judge's result in the form of the rule signals."""
    return Signal(code, version, lambda x: (score, raw, F.lit(False) if hard is None else hard)).result(Limits())


def llm_health(marks: Column) -> Column:
    """LLM-HEALTH of marks by key; it never rejects."""
    return judged("LLM-HEALTH", "health_rubric.ja.v1.0", rubric_mean(marks, list(HEALTH_KEYS)), F.to_json(marks))


def llm_prompt_health(marks: Column) -> Column:
    return judged("LLM-PROMPT-HEALTH", "prompt_health_rubric.ja.v1.0", rubric_mean(marks, list(PROMPT_HEALTH_KEYS)), F.to_json(marks))


def llm_self(said: Column, least: float | None = None) -> Column:
    """LLM-SELF of a judge's text: 1 outside thinking mode, 0.5 without thinking or answer; below `least`, if there is one, it rejects."""
    blank = (trace() == "") | (answer() == "")
    score = F.when(~thinking(), 1.0).when(blank, 0.5).otherwise(parse_self(said))
    asked = thinking() & ~blank
    return judged("LLM-SELF", "v1", score, F.when(asked, score), asked & (score < least) if least is not None else None)


def rubric_mean(scores: Column, keys: list[str]) -> Column:
    """A judge's marks of 1 to 5 as a score: their mean over keys, a missing one counting 3, by 5."""
    return sum((F.coalesce(F.try_element_at(scores, F.lit(k)).cast("double"), F.lit(3.0)) for k in keys), F.lit(0.0)) / len(keys) / 5


def parse_rubric(c: Column, keys: list[str]) -> Column:
    """Marks from a judge's text: its first flat JSON object; rounded half to even, within 1 to 5, 3 where unreadable."""
    raw = F.from_json(F.regexp_extract(c, r"(?s)(\{[^{}]*\})", 1), "map<string,string>")
    mark = lambda k: F.try_element_at(raw, F.lit(k)).try_cast("double")
    return F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*[F.when(mark(k).isNull(), 3).otherwise(F.greatest(F.lit(1), F.least(F.lit(5), F.bround(mark(k)).cast("int")))) for k in keys]))


def parse_pair(c: Column) -> Column:
    """a, b or tie."""
    said = F.lower(F.get_json_object(F.regexp_extract(c, r"(?s)(\{[^{}]*\})", 1), "$.winner"))
    return F.when(said.isin("a", "b"), said).otherwise("tie")


def parse_self(c: Column) -> Column:
    said = F.get_json_object(F.regexp_extract(c, r"(?s)(\{[^{}]*\})", 1), "$.score").try_cast("double")
    return F.when(said.isNull(), 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), said)))
