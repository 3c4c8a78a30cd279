"""Functions of whole records: tool calls, turns, chat results, browse state, status lines, text reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import parse
from . import text as t
from .signals import TOOL_INTENT

# Labels, limits and messages that results depend on.
WEATHER = {0: "快晴", 1: "晴れ", 2: "晴れ時々曇り", 3: "曇り", 45: "霧", 48: "霧氷", 51: "弱い霧雨", 53: "霧雨", 55: "強い霧雨", 61: "弱い雨", 63: "雨", 65: "強い雨", 71: "弱い雪", 73: "雪", 75: "強い雪", 80: "にわか雨", 81: "にわか雨", 82: "激しいにわか雨", 95: "雷雨"}
TOOL_NAME = r"(?:use|call|invoke|using|calling)\s+(?:the\s+)?([a-z_][a-z0-9_]*)"
NO_INVENTION = "ツールを使わずに架空のデータ・出典・URL を作らないでください。推測でツールを使ったかのように装ってはいけません。"


def has_calls(calls: Column, strict: bool = True) -> Column:
    """Whether some call has a name; strict: not an empty one and not that of a malformed call."""
    named = lambda c: c["name"].isNotNull() & (~c["name"].isin("", "<malformed>") if strict else F.lit(True))
    return F.coalesce(F.exists(calls, named), F.lit(False))


def calls_of_turns(turns: Column) -> Column:
    """All named calls of the assistant's turns."""
    spoke = F.filter(F.coalesce(turns, F.array().cast("array<struct<role:string,tool_calls:array<struct<name:string>>>>")), lambda x: x["role"] == "assistant")
    return F.filter(F.flatten(F.filter(F.transform(spoke, lambda x: x["tool_calls"]), lambda c: c.isNotNull())), lambda c: c["name"].isNotNull())


def merge_hints(*hints: Column, most: int = 5) -> Column:
    return F.slice(F.array_distinct(F.flatten(F.array(*[F.coalesce(h, F.array().cast("array<string>")) for h in hints]))), 1, most)


def plans_tools(c: Column) -> Column:
    return (t.strip(t.text(c)) != "") & t.like(t.text(c), TOOL_INTENT, "i")


def planned_tool(c: Column, known: list[str]) -> Column:
    """The longest known name that stands in the text as a word, else the known one that the text says to use."""
    found = [F.when(t.like(c, rf"(?<![a-z0-9_]){_quoted(n)}(?![a-z0-9_])", "i"), F.lit(n)) for n in sorted(known, key=lambda n: (-len(n), n))]
    said = F.lower(F.regexp_extract(c, t.rx(TOOL_NAME, "i"), 1))
    return F.when(t.strip(t.text(c)) != "", F.coalesce(*found, F.when(said.isin(known), said)))


def _quoted(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in s)


def unparsed_call(raw: Column) -> Column:
    return F.contains(F.lower(t.text(raw)), F.lit("<tool_call"))


def needs_recovery(tools: Column, calls: Column, thinking: Column, answer: Column, hints: Column) -> Column:
    """Tools were offered, none was called, and the text plans to or a call went unread."""
    said = F.concat_ws("\n", t.full(thinking), t.full(answer))
    return (F.coalesce(F.size(tools), F.lit(0)) > 0) & (F.coalesce(F.size(calls), F.lit(0)) <= 0) & (plans_tools(said) | (F.coalesce(F.size(hints), F.lit(0)) > 0))


def normalize_result(calls: Column, answer: Column, thinking: Column, raw: Column, known: list[str]) -> Column:
    """Struct (tool_calls, answer, thinking, hints): calls as given, else those in the answer, the thinking, the raw completion."""
    thought = t.sanitize_thinking(thinking)
    a, b, c = (parse.tool_calls(x, known) for x in (t.strip(t.text(answer)), F.coalesce(thought, F.lit("")), t.text(raw)))
    none = lambda x: F.when(F.size(x) > 0, x)
    given = none(calls)
    found = F.coalesce(given, none(a["calls"]), none(b["calls"]), none(c["calls"]), F.array().cast("array<struct<name:string,arguments:string,raw:string>>"))
    late = F.when(given.isNull() & (F.size(a["calls"]) == 0) & (F.size(b["calls"]) == 0) & (F.size(c["calls"]) == 0), c["hints"])
    return F.struct(found.alias("tool_calls"), a["cleaned"].alias("answer"), t.full(b["cleaned"]).alias("thinking"), merge_hints(a["hints"], b["hints"], late).alias("hints"))


def normalize_arguments(arguments: Column) -> Column:
    """A map of arguments without nulls and blanks, its values stripped."""
    return F.map_filter(F.transform_values(arguments, lambda k, v: t.strip(v)), lambda k, v: v.isNotNull() & (v != ""))


def call_key(name: Column, arguments: Column) -> Column:
    """Name and arguments in key order: equal for calls that do the same."""
    ordered = F.array_sort(F.map_entries(normalize_arguments(arguments)))
    return F.to_json(F.struct(name.alias("name"), ordered.alias("arguments")))


def reconstruct_raw(reasoning: Column, content: Column) -> Column:
    return F.concat_ws("\n", F.when(t.text(reasoning) != "", F.concat(F.lit("<think>"), reasoning, F.lit("</think>"))), t.full(content))


def first_filled(*cols: Column) -> Column:
    return F.coalesce(*[F.when(t.strip(c) != "", c) for c in cols])


def tool_names(tools: Column) -> Column:
    """Distinct names of function schemas held as JSON texts."""
    return F.array_distinct(F.filter(F.transform(tools, lambda x: F.get_json_object(x, "$.function.name")), lambda n: n.isNotNull()))


def adhoc_tool(tool: Column) -> Column:
    """A schema as it is, or wrapped; one without name, description or parameters raises."""
    get = lambda k: F.get_json_object(tool, f"$.{k}")
    whole = F.coalesce((get("type") == "function") & get("function").startswith("{"), F.lit(False))
    ok = (t.text(get("name")) != "") & (t.text(get("description")) != "") & F.coalesce(get("parameters").startswith("{"), F.lit(False))
    wrapped = F.concat(F.lit('{"type":"function","function":{"name":'), F.to_json(F.array(get("name"))).substr(F.lit(2), F.length(F.to_json(F.array(get("name")))) - 2), F.lit(',"description":'), F.to_json(F.array(get("description"))).substr(F.lit(2), F.length(F.to_json(F.array(get("description")))) - 2), F.lit(',"parameters":'), get("parameters"), F.lit("}}"))
    return F.when(whole, tool).when(ok, wrapped).otherwise(F.raise_error(F.concat(F.lit("ad-hoc tool lacks name, description or parameters: "), tool)))


def usage_hint(tools: Column, default: str) -> Column:
    """The lines that tell a model which tools it has; tools: array of (name, description, rule)."""
    line = lambda x: F.concat(F.lit("- "), x["name"], F.lit(": "), F.coalesce(t.full(x["rule"]), x["description"]))
    some = F.exists(tools, lambda x: t.text(x["rule"]) != "")
    return F.when(F.coalesce(some, F.lit(False)), F.array_join(F.concat(F.array(F.lit("利用可能なツール:")), F.transform(tools, line), F.array(F.lit(NO_INVENTION))), "\n")).otherwise(default)


def fill(template: Column, **values: Column) -> Column:
    """A template with its {placeholders} filled."""
    return reduce(lambda c, kv: F.replace(c, F.lit("{" + kv[0] + "}"), kv[1]), values.items(), template)


def tokens_label(prompt: Column, completion: Column) -> Column:
    dash = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    return F.when(prompt.isNull() & completion.isNull(), "-").otherwise(F.concat(dash(prompt), F.lit("/"), dash(completion)))


def status_label(finish_reason: Column, answer: Column) -> Column:
    return F.when(t.record_truncated(finish_reason, answer, loop_counts=False), "truncated").otherwise(F.coalesce(finish_reason, F.lit("-")))


def browse_state(url: Column) -> Column:
    """Struct (category, style_id, page from 0) of a browse URL."""
    get = lambda k: t.full(F.parse_url(url, F.lit("QUERY"), F.lit(k)))
    page = F.regexp_extract(t.text(get("page")), r"^\s*(\d+)", 1).try_cast("int")
    return F.struct(F.try_url_decode(get("category")).alias("category"), F.try_url_decode(get("style_id")).alias("style_id"), F.coalesce(F.when(page >= 1, page - 1), F.lit(0)).alias("page"))


def browse_path(category: Column, style: Column, page: Column) -> Column:
    part = lambda k, c: F.when(t.text(c) != "", F.concat(F.lit(f"{k}="), F.url_encode(c)))
    query = F.concat_ws("&", part("category", category), part("style_id", style), F.when(page > 0, F.concat(F.lit("page="), (page + 1).cast("string"))))
    return F.when(query == "", "/outputs").otherwise(F.concat(F.lit("/outputs?"), query))


def profile_ready(profiles: Column, name: Column) -> Column:
    return F.coalesce(F.exists(profiles, lambda p: (p["name"] == name) & p["ready"]), F.lit(False))


def status_line(error: Column, status: Column, active: Column, target: Column, progress: Column, profiles: Column) -> Column:
    more = F.when(t.text(progress) != "", F.concat(F.lit(" ("), progress, F.lit(")"))).otherwise("")
    return (
        F.when(t.text(error) != "", F.concat(F.lit("error: "), error))
        .when((status == "switching") & (t.text(active) != "") & (t.text(target) != ""), F.concat(F.lit("switching "), active, F.lit("→"), target, more))
        .when((status == "starting") & (t.text(target) != ""), F.concat(F.lit("starting "), target, more))
        .when(t.text(active) != "", F.concat(F.lit("active="), active, F.when(profile_ready(profiles, active), " ready").otherwise(" not ready")))
        .otherwise(F.concat(F.lit("status="), status))
    )


def weather_label(code: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in WEATHER.items() for x in kv])
    return F.when(code.isNull(), "不明").otherwise(F.coalesce(F.try_element_at(known, code), F.concat(F.lit("コード"), code.cast("string"))))


def search_results(query: Column, top_k: Column, hits: Column, most: int = 500) -> Column:
    """Numbered lines of hits (title, url, snippet); longer snippets are cut with a mark."""
    short = lambda c: F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("\n[truncated]"))).otherwise(c)
    line = lambda x, i: F.concat_ws("\n", F.concat((i + 1).cast("string"), F.lit(". "), x["title"]), F.when(t.text(x["url"]) != "", F.concat(F.lit("   url: "), x["url"])), F.when(t.text(x["snippet"]) != "", F.concat(F.lit("   snippet: "), short(x["snippet"]))))
    return F.concat_ws("\n", F.concat(F.lit("[search results for '"), query, F.lit("', top_k="), top_k.cast("string"), F.lit("]")), t.full(F.array_join(F.transform(hits, line), "\n")))


def prompt_characters(messages: Column, tools: Column) -> Column:
    """About how many characters a request holds: its messages' contents and calls, and the tools, as JSON."""
    each = F.transform(messages, lambda m: F.coalesce(F.length(m["content"]), F.lit(0)) + F.coalesce(F.length(m["tool_calls"]), F.lit(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) + F.coalesce(F.length(tools), F.lit(0))


def clamp(value: Column, probed: Column) -> Column:
    return F.when(probed.isNull(), value).otherwise(F.least(value, probed))


def retry_without_tools(error: Column, had_tools: Column) -> Column:
    return had_tools & (t.is_overflow(error) | F.contains(error, F.lit("prompt too long")))


def fallback_metrics() -> list[Column]:
    """Aggregates over used (boolean), succeeded (boolean) and tool_calls: how often the fallback was used, and helped."""
    used = F.coalesce(F.col("used"), F.lit(False))
    return [F.count_if(used).alias("used"), F.count_if(used & (F.coalesce(F.col("succeeded"), F.lit(False)) | has_calls(F.col("tool_calls"), strict=False))).alias("rescued")]


def schema_version_ok(version: Column) -> Column:
    return F.coalesce(version.try_cast("int") >= 1, F.lit(False))


def batch_size(asked: Column, remaining: Column, default: int = 8) -> Column:
    return F.greatest(F.lit(1), F.least(F.coalesce(asked, F.lit(default)), remaining))


def incremental_report(total: Column, full: Column, partial: Column, new: Column, calls: Column, saved: Column, missed: Column) -> Column:
    """The text report of an incremental run; missed is left out when 0."""
    line = lambda label, c: F.concat(F.lit(label), c.cast("string"))
    return F.concat_ws("\n", line("input: ", total), line("  reused: ", full), line("  partly reused: ", partial), line("  new: ", new), line("judge calls: ", calls), line("judge calls saved: ", saved), F.when(missed > 0, line("  rescore misses: ", missed)))
