"""Parsing of model replies into reasoning and answer, mostly as Column functions.

A reply parser is a row of *extractors*, each a Column that is '' where it finds nothing; the first that finds something
counts. Nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T


def _or(*cols: Column) -> Column:
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols), F.lit(""))


def unfenced(c: Column, both_ends: bool = False) -> Column:
    """Text without a code fence around it (A1); with both_ends only if it has one at both ends."""
    t = T.strip(c)
    bare = T.strip(F.regexp_replace(F.regexp_replace(t, r"^```[A-Za-z0-9_-]*\s*", ""), r"\s*```\z", ""))
    has = F.startswith(t, F.lit("```"))
    return F.when(has & F.endswith(t, F.lit("```")) if both_ends else has, bare).otherwise(t)


def outer_object(c: Column) -> Column:
    """From the first '{' to the last '}', or '' (A2)."""
    return F.regexp_extract(T.filled(c), r"(?s)(\{.*\})", 1)


def _field(blob: Column, key: str) -> Column:
    """Text of a key of a JSON object; numbers and booleans as their text, '' if absent."""
    return T.strip(F.get_json_object(blob, f"$.{key}"))


def is_object(blob: Column) -> Column:
    return (blob != "") & F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json(F.nullif(blob, F.lit("")))), F.lit("OBJECT")), F.lit(False))


def broken_field(c: Column, keys: str) -> Column:
    """A field of a JSON object that cannot be parsed as one, by its quoted name."""
    quoted = F.regexp_extract(T.filled(c), rf'(?is)"(?:{keys})"\s*:\s*"((?:[^"\\]|\\.)*)"', 1)
    plain = F.regexp_extract(T.filled(c), rf"(?im)^\s*(?:{keys})\s*[:=]\s*(\S.*)$", 1)
    return T.reply_value(F.regexp_replace(_or(quoted, plain), r'\\(["\\/])', "$1"))


_B, _E = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def marked_answer(c: Column) -> Column:
    """What follows an answer marker, up to the end of the line."""
    marks = r"final answer|answer|final output|output|conclusion|therefore|thus|so"
    a = F.regexp_extract(T.filled(c), rf"(?i)(?:{marks})\s*[:=\-]\s*(\S[^\n]*)", 1)
    b = F.regexp_extract(T.filled(c), r"(?i)(?:the answer is|the final answer is|this means|this gives|this yields)\s+(\S[^\n]*)", 1)
    return _or(T.reply_value(a), T.reply_value(b))


def last_of(c: Column, words: str) -> Column:
    """Last of the words that c holds as a word, in lower case."""
    got = F.regexp_extract_all(F.lower(T.filled(c)), F.lit(rf"(?<![\p{{L}}\p{{N}}_])({words})(?![\p{{L}}\p{{N}}_])"), F.lit(1))
    return F.coalesce(F.try_element_at(got, F.lit(-1)), F.lit(""))


def chosen_option(c: Column, options: Column) -> Column:
    """Letter after an option word; else, in the last 600 characters, the first option whose letter stands alone or whose text
    occurs (its letter or its text)."""
    said = F.upper(F.regexp_extract(T.filled(c), rf"(?i){_B}(?:option|choice|answer)\s*[:=\-]?\s*([A-F]){_E}", 1))
    tail = F.lower(F.substr(T.filled(c), F.greatest(F.length(T.filled(c)) - 599, F.lit(1))))

    def hit(o: Column, i: Column) -> Column:
        letter = F.lower(F.char(i + 65))
        alone = F.regexp_like(tail, F.concat(F.lit(_B), letter, F.lit(_E)))
        return F.when(T.strip(o) == "", "").when(alone, F.upper(letter)).when(F.contains(tail, F.lower(T.strip(o))), T.strip(o)).otherwise("")

    first = F.get(F.filter(F.transform(options, hit), lambda x: x != ""), F.lit(0))
    return _or(said, F.coalesce(first, F.lit("")))


def last_line(c: Column) -> Column:
    """Last line of at least 3 characters that is no step heading and no JSON, else the last such sentence."""
    lines = F.filter(
        F.transform(F.split(T.filled(c), r"\r\n|\r|\n"), T.strip),
        lambda x: (F.length(x) >= 3) & ~x.rlike(r"(?i)^step\s+[0-9]+") & ~F.startswith(x, F.lit("{")) & ~F.contains(F.lower(x), F.lit('"reasoning"')),
    )
    sentences = F.filter(
        F.transform(F.split(T.filled(c), r"(?<=[.!?])\s+"), T.strip),
        lambda x: (F.length(x) >= 3) & ~F.startswith(x, F.lit("{")) & ~F.contains(F.lower(x), F.lit('"reasoning"')),
    )
    return T.reply_value(F.coalesce(F.try_element_at(lines, F.lit(-1)), F.try_element_at(sentences, F.lit(-1)), F.lit("")))


def inferred_answer(c: Column, task_type: Column, options: Column) -> Column:
    """Answer of a plain-text reply (A4): by marker, sentiment label, option, last yes or no, last line."""
    kind = F.lower(T.strip(task_type))
    return _or(
        marked_answer(c),
        F.when(kind == "sentiment", last_of(c, "negative|neutral|positive")).otherwise(""),
        F.when(kind == "mcq", chosen_option(c, options)).otherwise(""),
        last_of(c, "yes|no"),
        last_line(c),
    )


def polished(answer: Column, task_type: Column, question: Column, options: Column) -> Column:
    """Concise form of an answer by task (A5); answer is a ``reply_value``."""
    a, kind = answer, F.lower(T.strip(task_type))
    nums = F.regexp_extract_all(a, F.lit(r"([-+]?\$?[0-9][0-9,]*(?:\.[0-9]+)?%?)"), F.lit(1))
    number = F.replace(F.coalesce(F.try_element_at(nums, F.lit(-1)), F.lit("")), F.lit("$"), F.lit(""))
    short = (number != "") & ((F.length(a) <= 48) | (F.size(nums) == 1))
    return F.when(a == "", "").otherwise(
        _or(
            F.when(kind == "sentiment", last_of(a, "negative|neutral|positive")).otherwise(""),
            F.when(N.is_yes_no_question(question), last_of(a, "yes|no")).otherwise(""),
            F.when(kind == "mcq", chosen_option(a, options)).otherwise(""),
            F.when(N.wants_number(question) & short, number).otherwise(""),
            a,
        )
    )


def is_valid(answer: Column, reasoning: Column, reply: Column, task_type: Column, open_ended: Column) -> Column:
    """Whether an answer can stand (A6): not empty, no JSON, not too long, not the reasoning, no rest of a cut JSON object.
    open_ended marks instruction samples whose answers may be long and structured."""
    a, kind = T.strip(answer), F.lower(T.strip(task_type))
    long = F.when(open_ended, 20000).when(kind == "instruction", 800).otherwise(500)
    low = F.lower(a)
    jsonish = (F.startswith(a, F.lit("{")) & ~open_ended) | F.contains(low, F.lit('"reasoning"')) | F.contains(low, F.lit('"final_answer"'))
    cut = F.startswith(T.strip(reply), F.lit("{")) & ~F.endswith(T.strip(reply), F.lit("}")) & F.contains(a, F.lit(":")) & (F.size(F.split(T.squash(a), " ")) > 12)
    return (a != "") & ~jsonish & (F.length(a) <= long) & (a != T.strip(reasoning)) & ~cut


def parse(df: DataFrame, reply: str = "reply", task_type: str = "task_type", question: str = "question", options: str = "options", open_ended: Column | None = None) -> DataFrame:
    """df with parsed, a STRUCT<reasoning, final_answer, status, error> of a teacher's reply (A3).

    A reply that holds a JSON object is read from it, a missing reasoning being the whole reply and a missing answer inferred;
    any other reply goes by field names and inference. What does not pass ``is_valid`` fails. The steps are columns of their
    own: as one expression each would be computed again wherever the next one refers to it.
    """
    open_ended = F.lit(False) if open_ended is None else open_ended
    kind, q, opts = F.col(task_type), F.col(question), F.col(options)
    x = df.withColumn("_t", unfenced(F.col(reply)))
    x = x.withColumn("_blob", _or(outer_object(F.col("_t")), F.col("_t")))
    x = x.withColumn("_obj", is_object(F.col("_blob")))
    t, blob, obj = F.col("_t"), F.col("_blob"), F.col("_obj")
    x = x.withColumn("_reasoning", _or(F.when(obj, _field(blob, "reasoning")).otherwise(broken_field(t, "reasoning")), t))
    x = x.withColumn("_raw", F.when(obj, _field(blob, "final_answer")).otherwise(broken_field(t, "final_answer|answer|label")))
    x = x.withColumn("_raw", F.when(F.col("_raw") != "", F.col("_raw")).otherwise(inferred_answer(t, kind, opts)))
    x = x.withColumn("_raw", T.reply_value(F.col("_raw")))
    x = x.withColumn("_answer", polished(F.col("_raw"), kind, q, opts))
    x = x.withColumn("_ok", (F.col("_reasoning") != "") & is_valid(F.col("_answer"), F.col("_reasoning"), t, kind, open_ended))
    ok = F.col("_ok")
    parsed = F.struct(
        F.when(ok, F.col("_reasoning")).otherwise("").alias("reasoning"), F.when(ok, F.col("_answer")).otherwise("").alias("final_answer"),
        F.when(ok, "success").otherwise("failed").alias("status"),
        F.when(ok, "").when(obj, "json_missing_required_fields").otherwise("unable_to_parse_response").alias("error"),
    )
    return x.withColumn("parsed", parsed).drop("_t", "_blob", "_obj", "_reasoning", "_raw", "_answer", "_ok")


def extract(reply: Column) -> Column:
    """STRUCT<reasoning, final_answer, method> of a benchmark reply (A7): by tags, JSON, marker or last line."""
    t = unfenced(reply, both_ends=True)
    tag = lambda k: T.strip(F.regexp_extract(t, rf"(?is)<{k}>\s*(.*?)\s*</{k}>", 1))
    blob = outer_object(t)
    from_json = F.when(is_object(blob), _field(blob, "final_answer")).otherwise("")
    mark = T.strip(F.regexp_extract(t, r"(?is)final answer\s*:\s*(.+)\z", 1))
    before = T.strip(F.regexp_extract(t, r"(?is)^(.*?)final answer\s*:", 1))
    lines = F.filter(F.transform(F.split(t, r"\r\n|\r|\n"), T.strip), lambda x: x != "")
    last = F.coalesce(F.try_element_at(lines, F.lit(-1)), F.lit(""))
    rest = F.array_join(F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), "\n")
    method = F.when(tag("final_answer") != "", "xml_tags").when(from_json != "", "json").when(mark != "", "final_answer_marker").otherwise("last_line_fallback")
    return F.struct(
        F.when(method == "xml_tags", tag("reasoning")).when(method == "json", _field(blob, "reasoning")).when(method == "final_answer_marker", before).otherwise(rest).alias("reasoning"),
        F.when(method == "xml_tags", tag("final_answer")).when(method == "json", from_json).when(method == "final_answer_marker", mark).otherwise(last).alias("final_answer"),
        method.alias("method"),
    )


def judge_payload(reply: Column, score_key: str = "score", dims: tuple[str, ...] = ()) -> Column:
    """STRUCT<ok, score, judgment, mismatch_type, reason, ...dims> of a judge's reply (A8). ok is false where the reply holds no
    JSON object; scores and dimensions are 0 or 1, missing texts ''."""
    blob = outer_object(unfenced(reply))
    ok = is_object(blob)
    text = lambda k: F.when(ok, T.filled(F.get_json_object(blob, f"$.{k}"))).otherwise("")
    return F.struct(
        ok.alias("ok"), F.when(ok, N.binary(F.get_json_object(blob, f"$.{score_key}"))).otherwise(0).alias("score"),
        text("judgment").alias("judgment"), text("mismatch_type").alias("mismatch_type"), text("reason").alias("reason"),
        *(F.when(ok, N.binary(F.get_json_object(blob, f"$.{d}"))).otherwise(0).alias(d) for d in dims),
    )


def consistency_payload(reply: Column) -> Column:
    """STRUCT<ok, is_consistent, judgment, mismatch_type, normalized_reference, normalized_candidate, reason> of the lenient
    judge. Any non-empty text counts as consistent, as does any number but 0 (D11)."""
    blob = outer_object(unfenced(reply))
    ok = is_object(blob)
    v = F.get_json_object(blob, "$.is_consistent")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(F.nullif(blob, F.lit(""))), "$.is_consistent", "variant"))
    truth = F.when(kind == "STRING", v != "").when(kind == "BOOLEAN", v == "true").when(kind.isNull() | (kind == "VOID"), False).otherwise(~v.rlike(r"^-?0(?:\.0+)?$|^\[\]$|^\{\}$"))
    names = ("judgment", "mismatch_type", "normalized_reference", "normalized_candidate", "reason")
    return F.struct(ok.alias("ok"), F.coalesce(ok & truth, F.lit(False)).alias("is_consistent"), *(F.when(ok, T.filled(F.get_json_object(blob, f"$.{n}"))).otherwise("").alias(n) for n in names))
