"""Queries over conversations. Thinking, tool calls and tool answers are derived from the turns."""

from pyspark.sql import functions as F

from tamra.operators import chat
from tamra.plans.registry import query, table

_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def thinking_turns(spark, sf):
    """Every assistant turn of each third conversation starts with a thinking block."""
    marked = (F.col("role") == "assistant") & (F.col("conv_id") % 3 == 0)
    block = F.concat(F.lit("<|channel>thought\nhm "), F.col("turn").cast("string"), F.lit("<channel|> "))
    return table(spark, sf, "conversations").withColumn("text", F.when(marked, F.concat(block, "text")).otherwise(F.col("text")))


_PIECES = f"""p AS (SELECT conv_id, turn, CASE
   WHEN role IN ('system', 'developer') AND turn = min(turn) OVER (PARTITION BY conv_id) THEN '<|turn>system' || chr(10) || {_STRIP.format('text')} || '<turn|>' || chr(10)
   ELSE CASE WHEN role = 'assistant' AND lag(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'assistant' THEN ''
        ELSE '<|turn>' || CASE role WHEN 'assistant' THEN 'model' ELSE role END || chr(10) END || {_STRIP.format('text')} || '<turn|>' || chr(10) END AS piece FROM conversations)"""


@query("v1_render", f"WITH {_PIECES} SELECT conv_id, '<bos>' || string_agg(piece, '' ORDER BY turn) || '<|turn>model' || chr(10) AS text FROM p GROUP BY 1")
def render(spark, sf):
    return chat.render(thinking_turns(spark, sf), generation_prompt=True)


@query("v2_strip_thinking", f"SELECT conv_id, turn, {_STRIP.format('text')} AS text FROM conversations")
def strip_thinking(spark, sf):
    return thinking_turns(spark, sf).select("conv_id", "turn", chat.strip_thinking(F.col("text")).alias("text"))


def tool_turns(spark, sf):
    """Even conversations call a tool in each assistant turn; every second one of them gets an answer."""
    turns = table(spark, sf, "conversations").withColumn("turn", F.col("turn") * 10)
    calling = (F.col("role") == "assistant") & (F.col("conv_id") % 2 == 0)
    arguments = F.concat(F.lit('{"b": '), F.col("conv_id").cast("string"), F.lit(', "a": "x", "C": [true, {"k": 1.5}]}'))
    call = F.array(F.struct(F.concat(F.lit("c"), F.col("turn").cast("string")).alias("id"), F.lit("lookup").alias("name"), arguments.alias("arguments")))
    none = F.lit(None).cast("string")
    spoken = turns.withColumn("reasoning", F.when(F.col("role") == "assistant", "because")).withColumn(
        "tool_calls", F.when(calling, call)).withColumn("tool_call_id", none)
    answers = turns.filter(calling & (F.col("conv_id") % 4 == 0)).select(
        "conv_id", (F.col("turn") + 5).alias("turn"), F.lit("tool").alias("role"), F.lit("found").alias("text"), none.alias("reasoning"),
        F.lit(None).cast(chat.CALL_TYPE).alias("tool_calls"), F.concat(F.lit("c"), F.col("turn").cast("string")).alias("tool_call_id"))
    return spoken.unionByName(answers)


@query("v3_v4_tools", f"""
WITH t AS (SELECT conv_id, turn, role, {_STRIP.format('text')} AS text, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before,
     max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS last_user, row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AS first FROM conversations),
  p AS (SELECT conv_id, turn, CASE WHEN first AND role IN ('system', 'developer') THEN '<|turn>system' || chr(10) || text || '<turn|>' || chr(10)
    ELSE CASE WHEN role = 'assistant' AND before = 'assistant' THEN '' ELSE '<|turn>' || CASE role WHEN 'assistant' THEN 'model' ELSE role END || chr(10) END
      || CASE WHEN role = 'assistant' AND conv_id % 2 = 0 THEN
           CASE WHEN turn > coalesce(last_user, -1) THEN '<|channel>thought' || chr(10) || 'because' || chr(10) || '<channel|>' ELSE '' END
           || '<|tool_call>call:lookup{{a:<|"|>x<|"|>,b:' || conv_id || ',C:[true,{{k:1.5}}]}}<tool_call|>'
           || CASE WHEN conv_id % 4 = 0 THEN '<|tool_response>response:lookup{{value:<|"|>found<|"|>}}<tool_response|>' ELSE '' END ELSE '' END
      || text || CASE WHEN role = 'assistant' AND conv_id % 4 = 2 THEN '<|tool_response>'
           WHEN role = 'assistant' AND conv_id % 4 = 0 AND text = '' THEN '' ELSE '<turn|>' || chr(10) END END AS piece FROM t)
SELECT conv_id, '<bos>' || string_agg(piece, '' ORDER BY turn) AS text FROM p GROUP BY 1""")
def tools(spark, sf):
    return chat.render(tool_turns(spark, sf))


@query("v5_parse_responses", """
SELECT conv_id, turn, role AS thinking, text AS content, 'find:{q:<|"|>' || conv_id || '<|"|>}' AS calls FROM conversations""")
def parse_responses(spark, sf):
    raw = F.concat(F.lit("<|channel>thought\n"), "role", F.lit("<channel|>"), F.lit('<|tool_call>call:find{q:<|"|>'), F.col("conv_id").cast("string"),
                   F.lit('<|"|>}<tool_call|>'), "text", F.lit("<turn|>"))
    parsed = chat.parse_responses(table(spark, sf, "conversations").withColumn("completion", raw))
    calls = F.array_join(F.transform("tool_calls", lambda c: F.concat_ws(":", c["name"], c["arguments"])), " ")
    return parsed.select("conv_id", "turn", "thinking", "content", calls.alias("calls"))


@query("v6_valid_conversations", f"""
WITH t AS (SELECT *, CASE WHEN role IN ('user', 'assistant') THEN role END AS talk FROM conversations),
  b AS (SELECT *, last_value(talk IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM t),
  g AS (SELECT conv_id, count(*) AS n_turns, bool_and(role = 'user' OR before IS NOT NULL OR talk IS NULL) AS first_role_ok,
     bool_and(talk IS NULL OR before IS NULL OR talk <> before) AS alternates, bool_and(regexp_matches(text, '\\S')) AS no_empty FROM b GROUP BY 1)
SELECT *, first_role_ok AND alternates AND no_empty AS valid FROM g""")
def valid_conversations(spark, sf):
    return chat.valid_conversations(table(spark, sf, "conversations"))
