"""Chat messages: a model server's response, and the turns of a tool loop, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as t

RESPONSE = "choices array<struct<finish_reason: string, message: struct<content: string, reasoning_content: string, reasoning: string, tool_calls: array<string>>>>, usage struct<prompt_tokens: int, completion_tokens: int>"
MALFORMED = "<malformed>"


def tool_call(entry: Column) -> Column:
    """(name, arguments, raw) of a call as JSON; arguments may be an object or a string that holds one, anything else is malformed."""
    name, raw = F.get_json_object(entry, "$.function.name"), F.coalesce(F.get_json_object(entry, "$.function.arguments"), F.lit("{}"))
    whole = F.get_json_object(entry, "$.function").isNotNull()
    ok = name.isNotNull() & F.startswith(F.trim(raw), F.lit("{")) & F.try_parse_json(raw).isNotNull()
    return F.struct(
        F.when(ok, name).otherwise(MALFORMED).alias("name"),
        F.when(ok, raw).otherwise("{}").alias("arguments"),
        F.when(whole, raw).otherwise(entry).alias("raw"),
    )


def chat_result(response: Column) -> Column:
    """(thinking, answer, finish_reason, prompt_tokens, completion_tokens, tool_calls) of a chat completion as JSON; null without a choice.

    The reasoning field is the thinking; without one it is taken out of the content.
    """
    data = F.from_json(response, RESPONSE)
    choice = F.get(data["choices"], F.lit(0))
    message = choice["message"]
    content = t.text(message["content"])
    reasoning = F.coalesce(F.nullif(message["reasoning_content"], F.lit("")), F.nullif(message["reasoning"], F.lit("")))
    found = t.extract_thinking(content)
    parsed = F.struct(
        F.coalesce(reasoning, found["thinking"]).alias("thinking"),
        F.when(reasoning.isNotNull(), t.strip(content)).otherwise(found["body"]).alias("answer"),
        choice["finish_reason"].alias("finish_reason"),
        data["usage"]["prompt_tokens"].alias("prompt_tokens"),
        data["usage"]["completion_tokens"].alias("completion_tokens"),
        F.transform(F.coalesce(message["tool_calls"], F.array().cast("array<string>")), tool_call).alias("tool_calls"),
    )
    return F.when(choice.isNotNull(), parsed)


MESSAGE = "struct<role: string, content: string, tool_calls: array<struct<id: string, name: string, arguments: string>>, tool_call_id: string, name: string>"


def tool_turn(messages: Column, key: Column, content: Column, calls: Column, results: Column) -> Column:
    """messages with the assistant's turn and its calls' results; calls: (name, arguments); results: (name, content), in the calls' order.

    A call's id is made from key and its place, so a rerun gives the same ids.
    """
    call_id = lambda i: F.concat(F.lit("call_"), F.left(F.sha1(F.concat_ws(":", key.cast("string"), i.cast("string"))), F.lit(24)))
    asked = F.transform(calls, lambda c, i: F.struct(call_id(i).alias("id"), c["name"].alias("name"), c["arguments"].alias("arguments")))
    none = F.lit(None)
    said = F.struct(F.lit("assistant").alias("role"), content.alias("content"), asked.alias("tool_calls"), none.alias("tool_call_id"), none.alias("name")).cast(MESSAGE)
    told = F.transform(results, lambda r, i: F.struct(F.lit("tool").alias("role"), r["content"].alias("content"), none.alias("tool_calls"), call_id(i).alias("tool_call_id"), r["name"].alias("name")).cast(MESSAGE))
    return F.concat(messages, F.array(said), told)


def search_text(*fields: Column) -> Column:
    """The fields that aren't empty, a line each."""
    return F.concat_ws("\n", *[F.nullif(f.cast("string"), F.lit("")) for f in fields])
