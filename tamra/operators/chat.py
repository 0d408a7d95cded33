"""Conversations as training text, tool marks, parsed completions, sanity checks."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


# Marks of the text format.
BOS, QUOTE, THINK = "<bos>", '<|"|>', "<|think|>"
TURN, TURN_END = "<|turn>", "<turn|>"
CHANNEL, CHANNEL_END = "<|channel>", "<channel|>"
TOOL, TOOL_END = "<|tool>", "<tool|>"
CALL, CALL_END = "<|tool_call>", "<tool_call|>"
RESPONSE, RESPONSE_END = "<|tool_response>", "<tool_response|>"
MEDIA = {"image": "<|image|>", "audio": "<|audio|>", "video": "<|video|>"}
SYSTEM_ROLES = ("system", "developer")
SCHEMA_WORDS = ("description", "type", "properties", "required", "nullable")

CALL_TYPE = "array<struct<id:string,name:string,arguments:string>>"
RESPONSE_TYPE = "array<struct<name:string,response:string>>"
PART_TYPE = "array<struct<type:string,text:string>>"
# Columns a conversation table may have besides ``conv_id, turn, role, text``.
OPTIONAL = {"reasoning": "string", "reasoning_content": "string", "tool_calls": CALL_TYPE, "tool_responses": RESPONSE_TYPE, "tool_call_id": "string",
            "name": "string", "parts": PART_TYPE}


# ---- values in the notation of the format: small helpers for one value --------------------

def _quoted(text: str) -> str:
    return f"{QUOTE}{text}{QUOTE}"


def _by_key(mapping: Mapping) -> list[tuple]:
    return sorted(mapping.items(), key=lambda item: str(item[0]).lower())


def notation(value, quote_keys: bool = False) -> str:
    """A JSON value in the notation of the format, keys sorted."""
    if isinstance(value, str):
        return _quoted(value)
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, Mapping):
        return "{" + ",".join(f"{_quoted(k) if quote_keys else k}:{notation(v, quote_keys)}" for k, v in _by_key(value)) + "}"
    if isinstance(value, Sequence):
        return "[" + ",".join(notation(v, quote_keys) for v in value) + "]"
    return str(value)


def _loads(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return text


def _call(name: str, arguments: str | None) -> str:
    value = _loads(arguments)
    inner = notation(value)[1:-1] if isinstance(value, Mapping) else (arguments or "")
    return f"{CALL}call:{name}{{{inner}}}{CALL_END}"


def _response(name: str | None, body) -> str:
    value = body if isinstance(body, Mapping) else {"value": body}
    return f"{RESPONSE}response:{name or 'unknown'}{notation(value)}{RESPONSE_END}"


def _names(items: Sequence[str]) -> str:
    return "[" + ",".join(_quoted(i) for i in items) + "]"


def _kind(schema: Mapping) -> str:
    return str(schema.get("type", "")).upper()


def _properties(properties: Mapping, skip: Sequence[str] = ()) -> str:
    return ",".join(f"{k}:{{{_parameter(v)}}}" for k, v in _by_key(properties) if k not in skip and isinstance(v, Mapping))


def _items(items: Mapping) -> str:
    shown = []
    for key, value in _by_key(items):
        if value is None:
            continue
        if key == "properties":
            shown.append(f"properties:{{{_properties(value) if isinstance(value, Mapping) else ''}}}")
        elif key == "required":
            shown.append(f"required:{_names(value)}")
        elif key == "type":
            shown.append(f"type:{notation(value.upper() if isinstance(value, str) else [v.upper() for v in value])}")
        else:
            shown.append(f"{key}:{notation(value, True)}")
    return ",".join(shown)


def _parameter(schema: Mapping) -> str:
    kind, shown = _kind(schema), []
    if schema.get("description"):
        shown.append(f"description:{_quoted(schema['description'])}")
    if kind == "STRING" and schema.get("enum"):
        shown.append(f"enum:{notation(schema['enum'], True)}")
    if kind == "ARRAY" and isinstance(schema.get("items"), Mapping) and schema["items"]:
        shown.append(f"items:{{{_items(schema['items'])}}}")
    if schema.get("nullable"):
        shown.append("nullable:true")
    if kind == "OBJECT":
        own = schema.get("properties")
        inner = _properties(own) if isinstance(own, Mapping) else _properties(schema, SCHEMA_WORDS)
        shown.append(f"properties:{{{inner}}}")
        if schema.get("required"):
            shown.append(f"required:{_names(schema['required'])}")
    return ",".join([*shown, f"type:{_quoted(kind)}"])


def declare_tool(tool: Mapping) -> str:
    """The declaration of one tool; tools are few and the same for a whole table."""
    function = tool["function"]
    text = f"declaration:{function['name']}{{description:{_quoted(function.get('description') or '')}"
    parameters = function.get("parameters")
    if parameters:
        text += ",parameters:{"
        if parameters.get("properties"):
            text += f"properties:{{{_properties(parameters['properties'])}}},"
        if parameters.get("required"):
            text += f"required:{_names(parameters['required'])},"
        if parameters.get("type"):
            text += f"type:{_quoted(_kind(parameters))}}}"
    if "response" in function:
        response = function["response"]
        text += ",response:{"
        if response.get("description"):
            text += f"description:{_quoted(response['description'])},"
        if _kind(response) == "OBJECT":
            text += f"type:{_quoted('OBJECT')}}}"
    return TOOL + (text + "}").strip() + TOOL_END


@F.pandas_udf(T.StringType())
def _calls_text(calls):
    """Tool calls of a turn, from the JSON of the array. Arguments may nest, hence no column expression."""
    return calls.map(lambda js: "".join(_call(c.get("name"), c.get("arguments")) for c in json.loads(js)) if js else "")


@F.pandas_udf(T.StringType())
def _responses_text(responses):
    return responses.map(lambda js: "".join(_response(r.get("name"), _loads(r.get("response"))) for r in json.loads(js)) if js else "")


# ---- column functions ----------------------------------------------------------------------

def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_thinking(text: Column) -> Column:
    """Model text without its thinking blocks."""
    kept = F.transform(F.split(text, r"<channel\|>"), lambda part: F.substring_index(part, CHANNEL, 1))
    return strip(F.array_join(kept, ""))


def _media(kind: Column) -> Column:
    chosen = F.lit("")
    for name, mark in MEDIA.items():
        chosen = F.when(kind == name, mark).otherwise(chosen)
    return chosen


def _content(model: Column) -> Column:
    """Text of a turn: plain, or the parts one after the other."""
    def clean(text: Column) -> Column:
        return F.when(model, strip_thinking(text)).otherwise(strip(text))

    parts = F.array_join(F.transform("parts", lambda p: F.when(
        p["type"] == "text", clean(F.coalesce(p["text"], F.lit("")))).otherwise(_media(p["type"]))), "")
    return F.when(F.col("parts").isNotNull(), parts).otherwise(F.coalesce(clean(F.col("text")), F.lit("")))


def _answers(turn_calls: Column, followers: Column) -> Column:
    """Tool messages that follow a turn with calls, named by the call they answer."""
    def one(f: Column) -> Column:
        named = F.aggregate(turn_calls, F.coalesce(f["name"], F.lit("unknown")),
                            lambda acc, c: F.when(c["id"].eqNullSafe(f["tool_call_id"]), c["name"]).otherwise(acc))
        texts = F.array_join(F.transform(F.filter(f["parts"], lambda p: p["type"] == "text"), lambda p: F.coalesce(p["text"], F.lit(""))), "")
        body = F.when(f["parts"].isNotNull(), texts).otherwise(f["text"])
        shown = F.when(body.isNull(), "None").otherwise(F.concat(F.lit(QUOTE), body, F.lit(QUOTE)))
        media = F.coalesce(F.array_join(F.transform(f["parts"], lambda p: _media(p["type"])), ""), F.lit(""))
        return F.concat(F.lit(f"{RESPONSE}response:"), named, F.lit("{value:"), shown, F.lit("}" + RESPONSE_END), media)

    return F.array_join(F.transform(followers, one), "")


def render_turns(turns: DataFrame, tools: Sequence[Mapping] = (), enable_thinking: bool = False) -> DataFrame:
    """``conv_id, turn, piece, after``: the text each turn adds, and what it ended with.

    A leading system turn goes into the system block; tool messages appear with the call they answer.
    """
    full = turns
    for column, kind in OPTIONAL.items():
        if column not in full.columns:
            full = full.withColumn(column, F.lit(None).cast(kind))
    ordered = W.partitionBy("conv_id").orderBy("turn")
    whole = W.partitionBy("conv_id")
    rows = full.withColumn("_first", F.row_number().over(ordered) == 1)
    rows = rows.withColumn("_system", F.col("_first") & F.col("role").isin(*SYSTEM_ROLES))
    in_loop = ~F.col("_system")
    rows = (
        rows.withColumn("_last_user", F.max(F.when(in_loop & (F.col("role") == "user"), F.col("turn"))).over(whole))
        .withColumn("_before", F.last(F.when(in_loop & (F.col("role") != "tool"), F.col("role")), ignorenulls=True)
                    .over(ordered.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("_owner", F.last(F.when(F.col("role") != "tool", F.col("turn")), ignorenulls=True)
                    .over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    )
    follower = F.when(F.col("role") == "tool", F.struct("turn", "tool_call_id", "name", "text", "parts"))
    rows = rows.withColumn("_followers", F.array_sort(F.collect_list(follower).over(W.partitionBy("conv_id", "_owner"))))

    model = F.col("role") == "assistant"
    has_calls = F.coalesce(F.size("tool_calls") > 0, F.lit(False))
    legacy = F.coalesce(F.size("tool_responses") > 0, F.lit(False))
    header = F.when(model & (F.col("_before") == "assistant"), "").otherwise(
        F.concat(F.lit(TURN), F.when(model, "model").otherwise(F.col("role")), F.lit("\n")))
    thought = F.coalesce(F.when(F.col("reasoning") != "", F.col("reasoning")), F.col("reasoning_content"), F.lit(""))
    thinking = F.when(
        (thought != "") & has_calls & (F.col("turn") > F.coalesce(F.col("_last_user"), F.lit(-1))),
        F.concat(F.lit(f"{CHANNEL}thought\n"), thought, F.lit(f"\n{CHANNEL_END}"))).otherwise("")
    native = "tool_calls" in turns.columns
    calls = F.when(has_calls, _calls_text(F.to_json("tool_calls"))).otherwise("") if native else F.lit("")
    old_answers = _responses_text(F.to_json("tool_responses")) if "tool_responses" in turns.columns else F.lit("")
    answers = F.when(legacy, old_answers).when(has_calls, _answers(F.col("tool_calls"), F.col("_followers"))).otherwise("")
    made = rows.select(
        "conv_id", "turn", "role", "_system", "text", "parts", header.alias("_header"), thinking.alias("_thinking"), calls.alias("_calls"),
        answers.alias("_answers"), has_calls.alias("_has_calls"), _content(model).alias("_content"))
    answered = F.col("_answers") != ""
    shown_media = F.coalesce(F.exists("parts", lambda p: p["type"].isin(*MEDIA)), F.lit(False))
    after = F.when(shown_media, "media").when(answered, "tool_response").when(F.col("_has_calls"), "tool_call")
    filled = F.length(strip(F.col("_content"))) > 0
    end = F.when(F.coalesce(after == "tool_call", F.lit(False)), RESPONSE).when(answered & ~filled, "").otherwise(TURN_END + "\n")
    body = F.concat("_header", "_thinking", "_calls", "_answers", "_content", end)

    intro = F.lit(TURN + "system\n" + (THINK + "\n" if enable_thinking else ""))
    outro = F.lit("".join(declare_tool(t) for t in tools) + TURN_END + "\n")
    spaced = F.array_join(F.transform("parts", lambda p: F.concat(strip(F.coalesce(p["text"], F.lit(""))), F.lit(" "))), "")
    system = F.concat(intro, F.coalesce(F.when(F.col("parts").isNotNull(), spaced).otherwise(strip(F.col("text"))), F.lit("")), outro)
    opening = F.concat(intro, outro) if tools or enable_thinking else F.lit("")
    kind = "tool" if tools else ("think" if enable_thinking else None)
    first = F.row_number().over(W.partitionBy("conv_id").orderBy("turn")) == 1
    shown = made.withColumn("_open", F.when(first & ~F.col("_system"), opening).otherwise(""))
    return shown.filter((F.col("role") != "tool") | (F.col("_open") != "")).select(
        "conv_id", "turn",
        F.when(F.col("_system"), system).when(F.col("role") == "tool", F.col("_open")).otherwise(F.concat("_open", body)).alias("piece"),
        F.when(F.col("_system") | (F.col("role") == "tool"), F.lit(kind)).otherwise(after).alias("after"))


def render(turns: DataFrame, tools: Sequence[Mapping] = (), enable_thinking: bool = False, generation_prompt: bool = False) -> DataFrame:
    """``conv_id, text``: one training text per conversation. The result row is the conversation itself."""
    pieces = render_turns(turns, tools, enable_thinking)
    joined = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "piece", "after"))).alias("_p"))
    text = F.concat(F.lit(BOS), F.array_join(F.transform("_p", lambda p: p["piece"]), ""))
    if generation_prompt:
        last = F.element_at("_p", -1)["after"]
        text = F.concat(text, F.when(F.coalesce(last.isin("tool_response", "tool_call"), F.lit(False)), "").otherwise(f"{TURN}model\n"))
    return joined.select("conv_id", text.alias("text"))


# The response grammar. The content runs up to the end of the turn or an open response.
ANSWER = (r"(?s)^(?:<\|channel>thought\n(.*?)<channel\|>)?(<\|tool_call>.*<tool_call\|>)?"
          r"((?!<turn\|>|<\|tool_response>).+?(?=<turn\|>|<\|tool_response>|\z))?")
CALLS = r"(?s)<\|tool_call>(.*?)<tool_call\|>"
ONE_CALL = r"(?s)call:(\w+)(\{.*\})"


def parse_responses(df: DataFrame, column: str = "completion") -> DataFrame:
    """Add ``thinking, content, tool_calls`` (name and raw arguments); absent parts are empty."""
    raw = F.col(column)
    calls = F.transform(
        F.filter(F.regexp_extract_all(F.regexp_extract(raw, ANSWER, 2), F.lit(CALLS), F.lit(1)), lambda c: F.regexp_like(c, F.lit(ONE_CALL))),
        lambda c: F.struct(F.regexp_extract(c, ONE_CALL, 1).alias("name"), F.regexp_extract(c, ONE_CALL, 2).alias("arguments")))
    return (df.withColumn("thinking", F.regexp_extract(raw, ANSWER, 1)).withColumn("content", F.regexp_extract(raw, ANSWER, 3))
            .withColumn("tool_calls", calls))


def valid_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, first_role_ok, alternates, no_empty, valid``.

    After an optional system turn the first turn is the user's, user and assistant alternate, and no
    turn is blank. Tool turns do not count for the alternation.
    """
    ordered = W.partitionBy("conv_id").orderBy("turn")
    talk = F.when(F.col("role").isin("user", "assistant"), F.col("role"))
    before = F.last(talk, ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    rows = turns.withColumn("_before", before).withColumn("_talk", talk)
    return rows.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.coalesce(F.bool_and((F.col("role") == "user") | F.col("_before").isNotNull() | F.col("_talk").isNull()), F.lit(False)).alias("first_role_ok"),
        F.coalesce(F.bool_and(F.col("_talk").isNull() | F.col("_before").isNull() | (F.col("_talk") != F.col("_before"))), F.lit(True)).alias("alternates"),
        F.bool_and(F.coalesce(F.regexp_like("text", F.lit(r"(?U)\S")), F.lit(False))).alias("no_empty"),
    ).withColumn("valid", F.col("first_role_ok") & F.col("alternates") & F.col("no_empty"))
