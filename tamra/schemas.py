"""Declared schemas; nothing is inferred on the way in."""

from pyspark.sql import types as T

_S, _L, _I, _D, _B, _TS = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
                           T.TimestampType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DOC = _struct(doc_id=_L, text=_S, source=_S, original_path=_S, sanitized=_B, lang=_S, n_chars=_L)
TABLE_DOC = _struct(doc_id=_L, text=_S, lang=_S, source=_S, n_chars=_L)
TOKENS = _struct(doc_id=_L, n_tokens=_I, input_ids=T.ArrayType(_I))
BLOCK = _struct(block_id=_L, pack_key=_L, input_ids=T.ArrayType(_I), labels=T.ArrayType(_I), split=_S)
PII_HIT = _struct(doc_id=_L, pii_type=_S, start=_I, end=_I, value_hash=_S)
CHUNK = _struct(chunk_id=_S, doc_id=_L, chunk_no=_I, start=_I, end=_I, text=_S, sanitized=_B, field=_S)
VECTOR = _struct(chunk_id=_S, embedding=T.ArrayType(T.FloatType()), content_sha=_S)
POSTING = _struct(term=_S, chunk_id=_S, tf=_I, doc_len=_I)
FACT = _struct(key=_S, value=_S, valid_from=_TS, valid_to=_TS, sys_from=_TS, sys_to=_TS)
GOLDEN = _struct(id=_S, query=_S, query_category=_S, retrieved_truth=T.ArrayType(_S), expected_answer=_S,
                 required_tool_calls=T.ArrayType(_S), difficulty=_S, notes=_S)
RUN = _struct(run_id=_S, config_id=_S, seed=_L, item_id=_S, answer=_S, cited=T.ArrayType(_S),
              retrieved=T.ArrayType(_S), tool_calls=T.ArrayType(_S), input_tokens=_L, output_tokens=_L, cost=_D,
              latency_ms=_D, refused=_B, attack_success=_B)
EVENT = _struct(event_id=_L, ts=T.TimestampNTZType(), user_id=_L, event_type=_S, value=_D, props=_S)
