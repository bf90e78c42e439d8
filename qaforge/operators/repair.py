"""Repair of dialogue answers: reasons, routes and local fixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions import numbers as N
from ..functions import text as T


def reasons(question: Column, answer: Column, reasoning: Column, reference: Column) -> Column:
    """All reasons to repair an answer, in a fixed order."""
    numeric = N.wants_number(question) & ~N.is_yes_no_question(question)

    def found(s: Column) -> Column:
        a, why, pct = s["a"], s["why"], s["pct"]
        differs = (a != "") & (why != "") & (a != why) & ~N.any_close(N.turn_number(a, pct), N.turn_number(why, pct), 0.01, 0.005)
        return F.array_compact(
            F.array(
                F.when(T.strip(answer) == "", "empty_answer"), F.when(s["m"]["mismatch"] == "rounding_or_format", "strict_fail_lenient_pass"), F.when(T.abstains(answer), "abstain_answer"),
                F.when(numeric & (F.size(N.turn_number(a, pct)) == 0), "numeric_not_normalizable"), F.when(differs, "reasoning_answer_inconsistent"),
            )
        )

    facts = T.record(m=C.turn_match(question, answer, reference), a=C.turn_answer(answer), why=C.turn_answer(T.conclusion(reasoning)), pct=N.expects_percent(question))
    return T.let(facts, found)


def route(df: DataFrame, max_repairs: int | None = None, order: list[str] | None = None) -> DataFrame:
    """df (id, question, model_answer, model_reasoning, reference_answer, ...) with reasons, route and repaired_answer.

    skip: nothing to repair; local: the normalised answer is the repair; queued: needs a model. With max_repairs, queued rows
    beyond the first so many, in the given order, are over_limit.
    """
    r = df.withColumn("reasons", reasons(F.col("question"), F.col("model_answer"), F.col("model_reasoning"), F.col("reference_answer")))
    local = F.array_contains("reasons", "strict_fail_lenient_pass") & (C.turn_answer(F.col("model_answer")) != "")
    r = r.withColumn("route", F.when(F.size("reasons") == 0, "skip").when(local, "local").otherwise("queued"))
    r = r.withColumn("repaired_answer", F.when(F.col("route") == "local", C.turn_answer(F.col("model_answer"))))
    if max_repairs is None:
        return r
    key = order or ["id"]
    first = r.where("route = 'queued'").select(*key).orderBy(*key).limit(max_repairs).withColumn("_in", F.lit(True))
    j = r.join(first.distinct(), key, "left")
    return j.withColumn("route", F.when((F.col("route") == "queued") & F.col("_in").isNull(), "over_limit").otherwise(F.col("route"))).drop("_in")


def history(turns: DataFrame, conversation: str, turn: str, question: str, answer: str, q_mark: str = "User: ", a_mark: str = "Assistant: ", most: int | None = None) -> DataFrame:
    """turns with history: questions and answers of earlier turns of the conversation, in order.

    Of all earlier turns, or of the last so many (most): a conversation of n turns has histories of n * n / 2 lines in all, so
    for very long ones give a bound, which also bounds what a task holds.
    """
    line = F.array_join(F.filter(F.array(F.when(T.strip(F.col(question)) != "", F.concat(F.lit(q_mark), T.strip(F.col(question)))), F.when(T.strip(F.col(answer)) != "", F.concat(F.lit(a_mark), T.strip(F.col(answer))))), lambda x: x.isNotNull()), "\n")
    w = Window.partitionBy(conversation).orderBy(turn).rowsBetween(Window.unboundedPreceding if most is None else -most, -1)
    return turns.withColumn("_line", line).withColumn("history", F.array_join(F.filter(F.collect_list("_line").over(w), lambda x: x != ""), "\n")).drop("_line")
