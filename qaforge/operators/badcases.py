"""Error classes of wrong answers, per kind of data, and reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions import numbers as N
from ..functions import options as O
from ..functions import text as T

# fixed values: mismatch kinds of numeric answers and the categories they are reported under
NUMERIC_CATEGORIES = {
    "abstain_error": "refusal_or_abstain", "rounding_or_format": "rounding_or_format", "sign_error": "sign_error",
    "calculation_error": "wrong_numeric", "text_mismatch": "other_text_mismatch",
}


def _category(kind: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in NUMERIC_CATEGORIES.items() for x in kv)), kind)


def numeric(answer: Column, reference: Column) -> Column:
    """Category of a table-text answer, NULL where it matches (B1)."""
    return _category(C.mismatch(answer, reference))


def dialogue(question: Column, answer: Column, reference: Column) -> Column:
    """Category of a dialogue answer, NULL where it matches strictly (B2)."""
    return _category(C.turn_match(question, answer, reference)["mismatch"])


def table_question(answer: Column, reference: Column, reasoning: Column, parse_status: Column, answer_type: Column, scale: Column) -> Column:
    """Category of a wrong answer on tables and paragraphs (B3), first that applies; to be used on answers that do not match."""
    nums = (F.size(N.bracketed_numbers(answer)) > 0) & (F.size(N.bracketed_numbers(reference)) > 0)
    return (
        F.when((F.coalesce(parse_status, F.lit("")) != "success") | (T.strip(answer) == ""), "parse_error")
        .when(T.abstains(answer), "abstain_error")
        .when(C.inconsistent(answer, reasoning), "reasoning_answer_inconsistent")
        .when(C.unit_error(answer, reference, scale), "percentage_or_unit_error")
        .when(N.flipped(N.bracketed_numbers(answer), N.bracketed_numbers(reference)), "sign_error")
        .when(C.rounding_error(answer, reference), "rounding_or_format_error")
        .when(F.lower(T.strip(answer_type)).isin("span", "multi-span", "count"), "evidence_misread")
        .when(nums, "calculation_error")
        .otherwise("unknown")
    )


def exam(answer: Column, reference: Column, reasoning: Column, options: Column, parse_status: Column) -> Column:
    """Category of an exam answer, NULL where it is the reference's letter."""
    def category(f: Column) -> Column:
        letter, why, exact = f["s"]["letter"], f["why"], f["s"]["kind"] == "exact_letter"
        right = letter == F.upper(T.strip(reference))
        return (
            F.when(F.coalesce(parse_status, F.lit("")) != "success", "parse_error").when(T.abstains(answer, "exam_analysis"), "abstain_error")
            .when((letter == "") & (T.strip(answer) != ""), "answer_text_mismatch").when(letter == "", "unknown").when(right & ~exact, "option_format_error")
            .when((why != "") & (why != letter), "reasoning_answer_inconsistent").when(~right & exact, "wrong_option_selection").when(~right, "answer_text_mismatch")
        )

    return T.let(T.record(s=O.stated_option(answer, options), why=O.reasoned_option(reasoning, options)), category)


def sentiment(answer: Column, reference: Column, reasoning: Column) -> Column:
    """Category of a sentiment answer, 'correct' included."""
    def category(f: Column) -> Column:
        a, r, why = f["a"], f["r"], f["why"]
        poles = a.isin("negative", "positive") & r.isin("negative", "positive")
        return (
            F.when(T.strip(answer) == "", "parse_error").when(T.abstains(answer, "sentiment"), "abstain_error").when(a == "", "label_format_error")
            .when((why != "") & (why != a), "reasoning_answer_inconsistent").when(a == r, "correct").when(poles, "polarity_flip")
            .when((a == "neutral") | (r == "neutral"), "neutral_polarity_confusion").otherwise("wrong_label_selection")
        )

    return T.let(T.record(a=O.sentiment(answer), r=F.lower(T.strip(reference)), why=O.reasoned_sentiment(reasoning)), category)


def confusion(df: DataFrame, gold: Column, pred: Column) -> DataFrame:
    """(gold, negative, neutral, positive, other): counts of predicted labels per gold label."""
    p = F.when(pred.isin(*O.SENTIMENTS), pred).otherwise("other")
    return df.select(gold.alias("gold"), p.alias("_p")).groupBy("gold").pivot("_p", [*O.SENTIMENTS, "other"]).agg(F.count(F.lit(1))).fillna(0)


def counts(df: DataFrame, category: str = "category", by: tuple[str, ...] = ()) -> DataFrame:
    """(...by, category, n, rate): wrong answers per category and their share of all rows of the group; NULL categories are
    right answers and only count below the line."""
    total = F.sum("n").over(Window.partitionBy(*by))
    return df.groupBy(*by, category).agg(F.count("*").alias("n")).withColumn("rate", F.col("n") / total).where(F.col(category).isNotNull())


def examples(df: DataFrame, k: int, category: str = "category", order: list[str] | None = None) -> DataFrame:
    """The first k rows of each category (B9). A row number bounded by k: Spark keeps k rows per task before it shuffles."""
    w = Window.partitionBy(category).orderBy(*(order or ["id"]))
    return df.where(F.col(category).isNotNull()).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """(value, n): the k most common values, ties by value."""
    value = F.coalesce(F.nullif(T.strip(F.col(column)), F.lit("")), F.lit("unknown"))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)
