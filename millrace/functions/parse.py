"""Parsers that no built-in function covers, as Arrow and pandas UDFs."""

from __future__ import annotations

import ast
import json
import operator
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache, reduce
from html.parser import HTMLParser
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


#: Bytes of texts that are objects at once.
PIECE = 1 << 20


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about PIECE bytes, or of one text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PIECE, "right")))
        yield texts.slice(at, to - at)
        at = to


def _each(c: Column, find: Callable[[str], Any], kind: T.DataType) -> Column:
    """find of each text; a batch's texts aren't all objects at once."""
    out = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(s: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], type=out), *[pa.array([find(x) for x in own.to_pylist()], type=out) for own in pieces(s)]])

    return run(c)


def _points(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _fours(points: np.ndarray) -> np.ndarray:
    """A 64-bit word for each four characters in a row; equal words are equal characters: those beyond 16 bits are numbered first."""
    if points.max() >= 1 << 16:
        points = np.unique(points, return_inverse=True)[1].astype(np.uint64)
    a, b, c, d = (points[i : len(points) - 3 + i] for i in range(4))
    return a << np.uint64(48) | b << np.uint64(32) | c << np.uint64(16) | d


def _share(s: str) -> float:
    points = _points(s)
    if len(points) < 4:
        return 0.0
    g = np.sort(_fours(points))
    same = g[1:] == g[:-1]
    twin = np.zeros(len(g), dtype=bool)
    twin[1:] |= same
    twin[:-1] |= same
    return float(twin.mean())


def repeat_share(c: Column) -> Column:
    """The share of character 4-grams that occur more than once; 0 for shorter texts."""

    return _each(c, _share, T.DoubleType())


#: Texts up to this length are looked at by a table that all of them share.
SHORT = 8192


@cache
def _short_looks(least: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, place, place + unit) of all looks at texts up to `longest`, by end: those of a text are the ones that end within it."""
    units = np.arange(least, longest)
    looks = np.maximum(0, longest - 4) // units
    unit = np.repeat(units, looks)
    place = (np.arange(looks.sum()) - np.repeat(np.cumsum(looks) - looks, looks)) * unit
    order = np.argsort(place + unit, kind="stable")
    return (place + unit + 4)[order], place[order], (place + unit)[order]


def _tripled(s: str, least: int = 4, at_once: int = 1_000_000) -> bool:
    """Three equal units in a row are 2 * unit characters that each equal the one a unit on.

    Such a stretch holds a multiple of the unit from which four characters lie within it, so for each unit only its
    multiples are looked at, by words of four characters; what matches is measured. That is n log n looks in all.
    """
    points = _points(s)
    n = len(points)
    if n < 3 * least:
        return False
    g = _fours(points)

    def stands(p: int, k: int) -> bool:
        a = max(0, p - 2 * k)
        same = points[a : min(n - k, p + 2 * k)] == points[a + k : min(n, p + 3 * k)]
        off = np.flatnonzero(~same)
        i = np.searchsorted(off, p - a)
        left = off[i - 1] if i else -1
        right = off[i] if i < len(off) else len(same)
        return right - left - 1 >= 2 * k

    if n <= SHORT:
        end, first, second = _short_looks(least, SHORT)
        upto = np.searchsorted(end, n, "right")
        hit = np.flatnonzero(g[first[:upto]] == g[second[:upto]])
        p, q = first[hit], second[hit]
        for on in (4, 8):  # of a unit of k characters k + 1 lie within the stretch
            going = (q - p < on + 3) | ((q + on < len(g)) & (g[np.minimum(p + on, len(g) - 1)] == g[np.minimum(q + on, len(g) - 1)]))
            p, q = p[going], q[going]
        return any(stands(i, j - i) for i, j in zip(p.tolist(), q.tolist(), strict=True))
    units = np.arange(least, n // 3 + 1)
    looks = (n - 4) // units
    cuts = np.searchsorted(np.cumsum(looks), np.arange(at_once, looks.sum() + at_once, at_once))
    for lo, hi in zip([0, *cuts], [*cuts, len(units)], strict=True):
        u, m = units[lo:hi], looks[lo:hi]
        unit = np.repeat(u, m)
        place = (np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)) * unit
        hit = np.flatnonzero(g[place] == g[place + unit])
        if any(stands(p, k) for p, k in zip(place[hit].tolist(), unit[hit].tolist(), strict=True)):
            return True
    return False


def triple_repeat(c: Column) -> Column:
    """Whether a phrase of four characters or more stands three times in a row."""

    return _each(c, _tripled, T.BooleanType())


_CLOSES = {"(": ")", "{": "}", "[": "]"}


def _break(s: str) -> str | None:
    if s.count("```") % 2:
        return "unclosed_fence"
    if (s.count("`") - 3 * s.count("```")) % 2:
        return "unclosed_backtick"
    want: list[str] = []
    for m in re.finditer(r"[(){}\[\]]", s):
        sign = m[0]
        if sign in _CLOSES:
            want.append(_CLOSES[sign])
        elif not want or want.pop() != sign:
            return f"mismatch:{sign}"
    if want:
        return f"unclosed:{want[-1]}"
    return "unclosed_dollar" if re.sub(r"(?s)\\.", "", s).count("$") % 2 else None


def syntax_break(c: Column) -> Column:
    """The first of: odd fences, odd backticks, brackets that don't match, odd dollar signs; else null."""

    return _each(c, _break, T.StringType())


def nfkc(c: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return run(c)


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.hidden, self.in_title = 0, False
        self.title: list[str] = []
        self.body: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden += tag in ("script", "style", "nav", "footer")
        self.in_title |= tag == "title"

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "nav", "footer"):
            self.hidden = max(0, self.hidden - 1)
        if tag == "title":
            self.in_title = False

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title.append(data)
        elif not self.hidden and data.strip():
            self.body.append(data.strip())


def _readable(html: str | None, most: int) -> str:
    page = _Page()
    page.feed(html or "")
    page.close()
    out = f"Title: {''.join(page.title).strip()}\nBody: " + "\n".join(page.body)
    return out if len(out) <= most else out[:most] + "\n... (truncated)"


def html_text(c: Column, most: int = 8000) -> Column:
    """Title and visible text of a page, cut at `most` characters."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: _readable(x, most))

    return run(c)


_OPS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod, ast.Pow: operator.pow, ast.USub: operator.neg, ast.UAdd: operator.pos}


def _value(node: ast.AST) -> float:
    match node:
        case ast.Expression(body=body):
            return _value(body)
        case ast.Constant(value=bool()):
            raise ValueError
        case ast.Constant(value=int() | float() as v):
            return v
        case ast.BinOp(left=a, op=op, right=b) if type(op) in _OPS:
            x, y = _value(a), _value(b)
            if isinstance(op, ast.Pow) and (abs(x) > 1e6 or abs(y) > 64):
                raise ValueError
            return _OPS[type(op)](x, y)
        case ast.UnaryOp(op=op, operand=a) if type(op) in _OPS:
            return _OPS[type(op)](_value(a))
    raise ValueError


def _calc(s: str | None) -> float | None:
    try:
        return float(_value(ast.parse((s or "").strip(), mode="eval")))
    except (ValueError, SyntaxError, ZeroDivisionError, OverflowError, TypeError, MemoryError, RecursionError):
        return None


def calc(c: Column) -> Column:
    """The value of an arithmetic expression; null if it isn't one."""

    @F.pandas_udf(T.DoubleType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(_calc)

    return run(c)


CALLS = T.StructType(
    [
        T.StructField("calls", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("name", "arguments", "raw")]))),
        T.StructField("cleaned", T.StringType()),
        T.StructField("hints", T.ArrayType(T.StringType())),
    ]
)


def _object_end(s: str, start: int) -> int | None:
    """Past the brace that closes the one at start; braces within strings don't count."""
    depth = 0
    for m in re.compile(r'"(?:\\.|[^"\\])*(?:"|$)|[{}]', re.S).finditer(s, start):
        depth += {"{": 1, "}": -1}.get(m[0], 0)
        if depth == 0 and m[0] == "}":
            return m.end()
    return None


def _call(raw: str) -> dict | None:
    try:
        found = json.loads(raw)
    except ValueError:
        return None
    if not isinstance(found, dict) or not isinstance(found.get("name"), str) or "arguments" not in found:
        return None
    given = found["arguments"] if isinstance(found["arguments"], dict) else {}
    return {"name": found["name"], "arguments": json.dumps(given, ensure_ascii=False, sort_keys=True), "raw": raw.strip()}


def find_calls(s: str | None, known: frozenset[str]) -> dict:
    """Tool calls in tags, JSON fences, and, of known tools, bare JSON; what remains; hints at calls that weren't read.

    Tags are taken first, then fences that meet no tag, then bare objects that meet neither. A tag around something
    else is cut out as well and becomes a hint; up to five hints come from what remains.
    """
    s = s or ""
    taken: list[tuple[int, int, dict | None]] = []
    hints: list[str] = []
    free = lambda a, b: all(b <= x or a >= y for x, y, _ in taken)

    def enclosed(opening: str, closing: str, flags: int = 0):
        for m in re.finditer(opening, s, flags):
            a = s.find("{", m.end())
            b = _object_end(s, a) if a >= 0 else None
            c = s.find(closing, b) if b is not None else -1
            if c >= 0:
                yield m.start(), c + len(closing), s[a:b]

    for a, b, raw in enclosed(r"<tool_call>", "</tool_call>"):
        call = _call(raw)
        taken.append((a, b, call))
        if call is None and s[a:b].strip():
            hints.append(s[a:b].strip())
    tags = len(taken)
    fences: list[tuple[int, int, dict | None]] = []
    for a, b, raw in enclosed(r"```(?:json)?", "```", re.I):
        call = _call(raw)
        if call and all(b <= x or a >= y for x, y, _ in fences):
            fences.append((a, b, call))
    taken += [f for f in fences if all(f[1] <= x or f[0] >= y for x, y, _ in taken[:tags])]
    at = s.find("{") if known else -1
    while at >= 0:
        end = _object_end(s, at) if free(at, at + 1) else None
        if end is not None:
            call = _call(s[at:end])
            if call and call["name"] in known:
                taken.append((at, end, call))
        at = s.find("{", end if end is not None else at + 1)
    kept, place = [], 0
    for a, b, _ in sorted(taken, key=lambda x: x[0]):
        kept.append(s[place:a])
        place = b
    cleaned = "".join([*kept, s[place:]]).strip()
    rest: list[str] = []
    for pattern, before in ((r"<tool_call\b[^>]*>", 0), (r'"name"\s*:\s*"([^"\\]+)"', 16)):
        for m in re.finditer(pattern, cleaned, re.I if not before else 0):
            hint = cleaned[max(0, m.start() - before) : m.end() + 80].strip()
            if hint and hint not in rest and len(rest) < 5:
                rest.append(hint)
    for hint in rest:
        if hint not in hints:
            hints.append(hint)
            if len(hints) >= 5:
                break
    return {"calls": [c for _, _, c in taken if c], "cleaned": cleaned, "hints": hints}


def tool_calls(c: Column, known: list[str]) -> Column:
    """Struct (calls, cleaned, hints) of a completion."""
    names = frozenset(known)

    @F.pandas_udf(CALLS)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([find_calls(x, names) for x in s], columns=["calls", "cleaned", "hints"])

    return run(c)


def _prompts(s: str | None) -> list[str]:
    """Strings of every JSON array in a text; doubled quotes are repaired; else its quoted strings."""
    out: list[str] = []
    for m in re.finditer(r"\[.*?\]", s or "", re.S):
        for candidate in (m[0], m[0].replace('""', '"')):
            try:
                found = json.loads(candidate)
            except ValueError:
                continue
            out += [x.strip() for x in found if isinstance(x, str) and x.strip()]
            break
    return out or [x.strip() for x in re.findall(r'"((?:\\.|[^"\\])+)"', s or "") if x.strip()]


def prompt_array(c: Column) -> Column:
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(_prompts)

    return run(c)


def _json_text(c: Column) -> Column:
    """A text as json.dumps writes it, without escapes beyond ASCII."""
    named = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    put = lambda x, signs: reduce(lambda y, kv: F.replace(y, F.lit(kv[0]), F.lit(kv[1])), signs.items(), x)
    common = put(c, named)
    rare = put(common, {chr(i): f"\\u{i:04x}" for i in range(32) if chr(i) not in named})
    return F.coalesce(F.concat(F.lit('"'), F.when(c.rlike(r"[\x00-\x07\x0b\x0e-\x1f]"), rare).otherwise(common), F.lit('"')), F.lit("null"))


def _sorted_json(s: str | None) -> str:
    return json.dumps(json.loads(s) if s else None, sort_keys=True, ensure_ascii=False)


def record_hash(prompt: Column, answer: Column, mode: Column, sampling: Column, system_prompt: Column, config_hash: Column, thinking: Column) -> Column:
    """A record's stable key, of its JSON with sorted keys; sampling is JSON text, and all that Python reads."""
    parts = {"answer": _json_text(answer), "config_hash": _json_text(config_hash), "mode": _json_text(mode), "prompt": _json_text(prompt), "sampling": _each(sampling, _sorted_json, T.StringType()), "system_prompt": _json_text(system_prompt)}
    body = F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), x) for k, x in parts.items()], F.when(mode == "thinking", F.concat(F.lit('"thinking_trace": '), _json_text(thinking))))
    return F.concat(F.lit("sha256-"), F.sha2(F.concat(F.lit("{"), body, F.lit("}")), 256))
