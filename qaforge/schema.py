"""Schemas of the tables that the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()
_OPTIONS = T.ArrayType(_S)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


#: A normalised sample; metadata is JSON text, of which operators read single keys.
SAMPLE = _struct(*((n, _S) for n in ("id", "source", "split", "task_type", "task_domain", "language", "question", "context")), ("options", _OPTIONS), ("reference_answer", _S), ("metadata", _S))
DISTILL = _struct(("prompt_version", _S), ("teacher_model", _S), ("raw_response_text", _S), ("parse_status", _S), ("parse_error", _S), ("api_success", _B), ("api_latency_ms", _I))
DISTILLED = T.StructType([*SAMPLE.fields, T.StructField("model_reasoning", _S), T.StructField("model_answer", _S), T.StructField("distill", DISTILL)])
#: An older form without split and with a reasoning field; its field order is part of the contract.
SAMPLE_V0 = _struct(("id", _S), ("source", _S), ("task_type", _S), ("task_domain", _S), ("language", _S), ("question", _S), ("context", _S), ("options", _OPTIONS), ("reasoning", _S), ("reference_answer", _S), ("metadata", _S))
JUDGE = _struct(("score", _I), ("judgment", _S), ("mismatch_type", _S), ("reason", _S), ("scoring_mode", _S))
JUDGED = _struct(("id", _S), ("source", _S), ("split", _S), ("judge_success", _B), ("judge_error", _S), ("judge_latency_ms", _I), ("judge", JUDGE))
CALL = _struct(("success", _B), ("text", _S), ("error", _S), ("latency_ms", _I))
MANIFEST = _struct(("manifest_index", T.LongType()), ("source", _S), ("task_domain", _S), ("split", _S), ("sample_id", _S), ("dataset_path", _S), ("line_number", T.LongType()), ("draw_index_within_dataset", T.LongType()))
MESSAGES = T.ArrayType(_struct(("role", _S), ("content", _S)))

# fixed values: the closed vocabularies
TASK_TYPES = ("reasoning", "mcq", "instruction", "sentiment")
TASK_DOMAINS = ("financial_reasoning", "financial_knowledge", "financial_instruction", "market_sentiment")
LANGUAGES = ("en", "zh")
