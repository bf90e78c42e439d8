"""Rule judges: deterministic scores of answers. A NULL score means that the rules do not settle it.

Each returns STRUCT<score INT, judgment, mismatch_type, reason, scoring_mode>.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import options as O
from ..functions import text as T


def _verdict(score: Column, mismatch: Column, reason: Column) -> Column:
    return T.let(
        T.record(score=score.cast("int"), kind=mismatch, why=reason),
        lambda v: F.struct(
            v["score"].alias("score"),
            F.when(v["score"] == 1, "rule_match").when(v["score"].isNotNull(), "incorrect").alias("judgment"),
            F.when(v["score"] == 1, "none").when(v["score"].isNotNull(), v["kind"]).alias("mismatch_type"),
            F.when(v["score"].isNotNull(), v["why"]).alias("reason"),
            F.when(v["score"].isNotNull(), "rule").alias("scoring_mode"),
        ),
    )


def _same(a: Column, b: Column) -> Column:
    return (a == b).cast("int")


def generic(question: Column, options: Column, answer: Column, reference: Column) -> Column:
    """STRUCT<score, method> of the first stage (J1): options by index, judgment questions by yes and no, else not applicable."""
    n = F.size(F.coalesce(options, F.array().cast("array<string>")))

    def verdict(s: Column) -> Column:
        score = F.when(n > 0, F.when(s["a"].isNotNull() & s["r"].isNotNull(), _same(s["a"], s["r"]))).when(s["judged"] & (s["x"] != "") & (s["y"] != ""), _same(s["x"], s["y"]))
        method = F.when(n > 0, "rule_mcq").when(s["judged"], "rule_judgment").otherwise("rule_not_applicable")
        return T.let(
            T.record(score=score, method=method),
            lambda v: T.record(score=v["score"], method=F.when(v["score"].isNull() & (v["method"] != "rule_not_applicable"), F.concat(v["method"], F.lit("_unresolved"))).otherwise(v["method"])),
        )

    return T.let(T.record(a=O.choice_index(answer, options), r=O.choice_index(reference, options), x=O.yes_no(answer), y=O.yes_no(reference), judged=O.is_judgment(question, reference)), verdict)


def exam(options: Column, answer: Column, reference: Column) -> Column:
    """Exam answers by option letter, else by true or false."""

    def verdict(s: Column) -> Column:
        a, r, x, y, empty, shy = (s[k] for k in ("a", "r", "x", "y", "empty", "shy"))
        score = F.when(s["none"], F.lit(None)).when(empty | shy, 0).when(r != "", F.when(a != "", _same(a, r))).when(y != "", F.when(x != "", _same(x, y)))
        kind = F.when(empty, "format_error").when(shy, "abstain_error").when(r != "", "option_error").otherwise("judgment_error")
        why = F.when(empty, "empty answer").when(shy, "abstains").when(r != "", F.concat_ws(" against ", a, r)).otherwise(F.concat_ws(" against ", x, y))
        return _verdict(score, kind, why)

    letters = O.option_letters(options)
    facts = lambda m: T.record(
        a=O.exam_letter(answer, m), r=O.exam_letter(reference, m), x=O.exam_true_false(answer), y=O.exam_true_false(reference), empty=T.strip(answer) == "", none=T.strip(reference) == "",
        shy=T.abstains(answer, "exam"),
    )
    return T.let(letters, lambda m: T.let(facts(m), verdict))


def instruction(task: Column, question: Column, answer: Column, reference: Column) -> Column:
    """Short answers to instructions (J3): labels by task, abstention on both sides, else one text within the other."""
    t = F.coalesce(task, F.lit(""))
    written = (t == "FINNA") | T.filled(question).rlike("生成标题|摘要|简述|总结")

    def verdict(s: Column) -> Column:
        a, r, shy_a, shy_r, empty = (s[k] for k in ("a", "r", "shy_a", "shy_r", "empty"))
        within = (a != "") & (r != "") & (F.contains(a, r) | F.contains(r, a))
        by_task = F.when(t == "FINFE", _same(O.sentiment_zh(answer), O.sentiment_zh(reference))).when(t == "FINNL", _same(O.category_zh(answer), O.category_zh(reference)))
        score = F.when(s["eligible"], F.when(empty, 0).when(t.isin("FINFE", "FINNL"), by_task).when(shy_a | shy_r, (shy_a & shy_r).cast("int")).otherwise(within.cast("int")))
        kind = (
            F.when(empty, "incompleteness").when(t == "FINFE", "sentiment_error").when(t == "FINNL", "category_error").when(shy_a | shy_r, "abstain_error")
            .when(t == "FINRE", "relation_error").when(t == "FINCQA", "event_error").when(t.isin("FINQA", "FINESE"), "entity_error").otherwise("label_error")
        )
        return _verdict(score, kind, F.concat_ws(" against ", a, r))

    facts = T.record(
        a=T.short_answer(answer), r=T.short_answer(reference), shy_a=T.abstains(answer, "instruction"), shy_r=T.abstains(reference, "instruction"),
        empty=(T.strip(answer) == "") | (T.strip(reference) == ""), eligible=~written & (F.length(T.strip(reference)) <= 64),
    )
    return T.let(facts, verdict)


def open_question(question: Column, answer: Column, reference: Column) -> Column:
    """Yes or no where both sides say one; made multiple-choice items by equality."""

    def verdict(s: Column) -> Column:
        settled = ((s["y"] != "") | s["q"].rlike("^(?:is|are|do|does|did|can|should|will|was|were|could) ")) & (s["x"] != "") & (s["y"] != "")
        item = F.contains(s["q"], F.lit("multiple choice")) | F.lower(T.filled(reference)).rlike(r"(?m)^a\.")
        score = F.when(settled, _same(s["x"], s["y"])).when(item & (s["a"] != "") & (s["r"] != ""), _same(s["a"], s["r"]))
        return _verdict(score, F.when(settled, "yesno_error").otherwise("mcq_error"), F.when(settled, F.concat_ws(" against ", s["x"], s["y"])).otherwise("item compared as text"))

    return T.let(T.record(q=T.answer_text(question), a=T.answer_text(answer), r=T.answer_text(reference), x=O.first_yes_no(answer), y=O.first_yes_no(reference)), verdict)


def sentiment(answer: Column, reference: Column) -> Column:
    """Sentiment labels."""

    def verdict(s: Column) -> Column:
        score = F.when(s["empty"] | s["shy"], 0).when((s["a"] != "") & (s["r"] != ""), _same(s["a"], s["r"]))
        return _verdict(score, F.when(s["empty"], "format_error").when(s["shy"], "abstain_error").otherwise("label_error"), F.concat_ws(" against ", s["a"], s["r"]))

    return T.let(T.record(a=O.sentiment(answer), r=O.sentiment(reference), empty=T.strip(answer) == "", shy=T.abstains(answer, "sentiment")), verdict)


def by_source(df_task: Column, source: Column, question: Column, options: Column, answer: Column, reference: Column, task: Column | None = None) -> Column:
    """The judge of each source's kind of data, by task type (F2); numeric reasoning has no rule. task names the sub-task of
    instruction samples, whose rules apply if it is given."""
    none = _verdict(F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    kind = F.lower(T.strip(df_task))
    out = (
        F.when(kind == "mcq", exam(options, answer, reference)).when(kind == "sentiment", sentiment(answer, reference))
        .when((kind == "instruction") & source.rlike("alpaca"), open_question(question, answer, reference))
    )
    if task is not None:
        out = out.when(kind == "instruction", instruction(task, question, answer, reference))
    return out.otherwise(none)


