"""Text normalisation as Column functions. All treat NULL as the empty string and strip Unicode white space."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def record(**cols: Column) -> Column:
    """STRUCT of named columns, for ``let``."""
    return F.struct(*(c.alias(k) for k, c in cols.items()))


def filled(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(filled(c), r"(?U)^\s+|\s+\z", "")


def squash(c: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def drop_chars(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def answer_text(c: Column) -> Column:
    """Lower case without dollar signs and commas, single spaces."""
    return squash(drop_chars(F.lower(strip(c)), "$,"))


def label_text(c: Column) -> Column:
    """Lower case, single spaces; dollar signs and commas stay."""
    return squash(F.lower(strip(c)))


def exam_text(c: Column) -> Column:
    """Full-width marks as ASCII, all white space deleted, case kept (T4)."""
    return F.regexp_replace(F.translate(strip(c), "　（）：，。", " ():,."), r"(?U)\s+", "")


_EDGE = "。；;，,：:、!！?？"


def span_text(c: Column) -> Column:
    """White space and quotes deleted, marks stripped at both ends (T5)."""
    return F.btrim(drop_chars(F.regexp_replace(strip(c), r"(?U)\s+", ""), '“”"'), F.lit(_EDGE))


# fixed values: lead-ins that data sets put before short answers, in the order in which they are removed
SHORT_ANSWER_LEADS = (
    "以上文本情感极性属于|所属情感是|情感是|情感倾向是|情感倾向为|文本情感是",
    "该新闻属于|以上新闻类别是|我们把以上新闻归属于|新闻类别是|属于",
    "和.+?相关的主体是|相关主体是|主体是|答案是",
    "关系是|联系是",
)


def short_answer(c: Column) -> Column:
    """span_text without the lead-ins of short answers."""
    out = reduce(lambda x, lead: F.regexp_replace(x, f"^(?:{lead})", ""), SHORT_ANSWER_LEADS, span_text(c))
    return F.btrim(out, F.lit(_EDGE))


def choice_text(c: Column) -> Column:
    """answer_text without a leading option word and label."""
    bare = F.regexp_replace(answer_text(c), r"^(?:option|choice|answer)(?U:\s*)", "")
    return strip(F.regexp_replace(bare, r"^[(\[]?[a-f][)\].:\-](?U:\s*)", ""))


def reply_value(c: Column) -> Column:
    """A field of a model's reply without outer commas, field name and quotes."""
    bare = strip(F.btrim(strip(c), F.lit(",")))
    bare = strip(F.regexp_replace(bare, r"(?i)^(?:reasoning|final_answer|answer|label)\s*[:=]\s*", ""))
    return strip(F.btrim(bare, F.lit("\"'`")))


def clip(c: Column, limit: int) -> Column:
    """Text of at most limit characters: longer ones end in a mark."""
    t = strip(c)
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.substring(t, 1, limit - 15), F.lit("\n[TRUNCATED]")))


def first_filled(*cols: Column) -> Column:
    """The first text that is not empty once stripped, else '' (H4)."""
    return F.coalesce(*(F.nullif(strip(c), F.lit("")) for c in cols), F.lit(""))


def sections(*cols: Column) -> Column:
    """Non-empty texts joined by blank lines (H5)."""
    return F.array_join(F.filter(F.array(*(strip(c) for c in cols)), lambda x: x != ""), "\n\n")


def table_text(rows: Column) -> Column:
    """ARRAY<ARRAY<STRING>> as lines of cells joined by bars; empty cells stay, empty lines go (H6)."""
    lines = F.transform(rows, lambda r: F.array_join(F.transform(r, strip), " | "))
    return F.coalesce(F.array_join(F.filter(lines, lambda x: x != ""), "\n"), F.lit(""))


def joined_texts(items: Column, sep: str = "\n") -> Column:
    """Non-empty stripped items of ARRAY<STRING> joined (H1 with ' | ', H7 with newlines)."""
    return F.coalesce(F.array_join(F.filter(F.transform(items, strip), lambda x: x != ""), sep), F.lit(""))


def text_list(items: Column) -> Column:
    """Non-empty stripped items (H2)."""
    return F.coalesce(F.filter(F.transform(items, strip), lambda x: x != ""), F.array().cast("array<string>"))


def lettered_options(*cells: Column) -> Column:
    """'A. text' for the non-empty cells A, B, C, ... (H8)."""
    made = F.array(*(F.when(strip(c) != "", F.concat(F.lit(f"{chr(65 + i)}. "), strip(c))) for i, c in enumerate(cells)))
    return F.filter(made, lambda x: x.isNotNull())


def conclusion(c: Column) -> Column:
    """What stands after the last line-anchored 'conclusion:', else the last non-empty line."""
    marked = F.regexp_extract_all(filled(c), F.lit(r"(?im)^conclusion[^\S\n]*:\s*(.+)$"), F.lit(1))
    lines = F.filter(F.transform(F.split(filled(c), r"\r\n|\r|\n"), strip), lambda x: x != "")
    return F.coalesce(F.nullif(strip(F.try_element_at(marked, F.lit(-1))), F.lit("")), F.try_element_at(lines, F.lit(-1)), F.lit(""))


def has_percent(c: Column) -> Column:
    return F.lower(filled(c)).rlike("%|percent")


_W = r"(?:^|[^\p{L}\p{N}_])"
_E = r"(?:$|[^\p{L}\p{N}_])"


def word(c: Column, alternatives: str) -> Column:
    """Whether one of the alternatives stands in c as a word; engine-neutral word bounds."""
    return c.rlike(f"{_W}(?:{alternatives}){_E}")


def unit_markers(c: Column) -> Column:
    """Sorted array of the scale words in c: billion, million, thousand."""
    marks = (("billion", "billion|bn"), ("million", "million|mn|mm"), ("thousand", "thousand|k"))
    return let(answer_text(c), lambda t: F.array_compact(F.array(*(F.when(word(t, p), F.lit(k)) for k, p in marks))))


def contains_any(c: Column, patterns: tuple[str, ...] | list[str]) -> Column:
    return reduce(lambda x, y: x | y, (F.contains(c, F.lit(p)) for p in patterns))


# fixed values: phrases by which answers abstain, per kind of data
ABSTAIN_NUMERIC = ("cannot be determined", "can't be determined", "cannot determine", "insufficient information", "not enough information", "not provided", "unknown")
ABSTAIN_SENTIMENT = ("cannot determine", "can't determine", "unable to determine", "not enough information", "insufficient information", "unknown")
ABSTAIN_EXAM_ANALYSIS = ("insufficient information", "cannot determine", "cannot be determined", "not enough information", "unknown", "无法判断", "无法确定", "信息不足", "不能确定", "无法得出")
ABSTAIN_EXAM = ("无法确定", "不能确定", "无法判断", "不能判断", "不确定", "不知道", "无法得出", "无法从题干")
ABSTAIN_INSTRUCTION = ("不能发现具体信息", "无法确定", "无法判断", "未提及", "没有提及", "没有具体信息", "无法从文中", "无法从材料")


def abstains(c: Column, kind: str = "numeric") -> Column:
    """Whether an answer abstains (C22); kind: numeric, sentiment, exam, exam_analysis or instruction."""
    form, phrases = {
        "exam": (strip, ABSTAIN_EXAM), "instruction": (short_answer, ABSTAIN_INSTRUCTION), "exam_analysis": (lambda x: F.lower(strip(x)), ABSTAIN_EXAM_ANALYSIS),
        "numeric": (answer_text, ABSTAIN_NUMERIC), "sentiment": (label_text, ABSTAIN_SENTIMENT),
    }[kind]
    return let(form(c), lambda t: contains_any(t, phrases))
