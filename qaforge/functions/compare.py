"""Comparison of predicted with gold answers, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import numbers as N
from . import text as T


def _sides(pred: Column, gold: Column) -> Column:
    """Normalised texts (p, g) and candidate numbers, strict (pw, gw) and of any token (pa, ga), of both answers."""
    return T.record(
        p=T.answer_text(pred), g=T.answer_text(gold), pw=N.whole_number(pred), gw=N.whole_number(gold), pa=N.any_number(pred), ga=N.any_number(gold), known=pred.isNotNull() & gold.isNotNull()
    )


def _matches(s: Column) -> Column:
    return s["known"] & (N.any_close(s["pw"], s["gw"], 1e-4, 1e-4) | ((s["p"] != "") & (s["p"] == s["g"])))


def answers_match(pred: Column, gold: Column) -> Column:
    """Equal as numbers within 1e-4, or as normalised non-empty texts (C1). NULL never matches."""
    sides = T.record(p=T.answer_text(pred), g=T.answer_text(gold), pw=N.whole_number(pred), gw=N.whole_number(gold), known=pred.isNotNull() & gold.isNotNull())
    return T.let(sides, _matches)


def lenient_match(pred: Column, gold: Column) -> Column:
    """answers_match, or some numbers within 1 % or 0.5."""
    return T.let(_sides(pred, gold), lambda s: _matches(s) | N.any_close(s["pa"], s["ga"], 0.01, 0.5))


def sign_error(pred: Column, gold: Column) -> Column:
    return N.flipped(N.any_number(pred), N.any_number(gold))


def mismatch(pred: Column, gold: Column) -> Column:
    """First that applies: match, abstain_error, rounding_or_format, sign_error, calculation_error, text_mismatch (C4).

    Two plain numbers are compared as such; candidate lists are made for other answers only.
    """
    bare = lambda c: T.drop_chars(T.strip(c), "$,")
    plain = lambda c: F.regexp_extract(bare(c), r"^([-+]?[0-9]+(?:\.[0-9]+)?)$", 1)
    as_numbers = lambda s: F.when(
        (s["p"] != "") & (s["g"] != ""),
        T.let(
            T.record(x=s["p"].try_cast("double"), y=s["g"].try_cast("double")),
            lambda v: F.when(N.is_close(v["x"], v["y"], 1e-4, 1e-4), "match").when(N.is_close(v["x"], v["y"], 0.01, 0.5), "rounding_or_format")
            .when((v["x"] * v["y"] < 0) & N.is_close(F.abs(v["x"]), F.abs(v["y"]), 0.01, 0.5), "sign_error").otherwise("calculation_error"),
        ),
    )
    listed = T.let(
        _sides(pred, gold),
        lambda s: F.when(_matches(s), "match").when(T.contains_any(s["p"], T.ABSTAIN_NUMERIC), "abstain_error").when(N.any_close(s["pa"], s["ga"], 0.01, 0.5), "rounding_or_format")
        .when(N.flipped(s["pa"], s["ga"]), "sign_error").when((F.size(s["pa"]) > 0) & (F.size(s["ga"]) > 0), "calculation_error").otherwise("text_mismatch"),
    )
    return F.coalesce(T.let(T.record(p=plain(pred), g=plain(gold)), as_numbers), listed)


def turn_answer(answer: Column) -> Column:
    """Canonical form of a dialogue answer: yes or no, one bare number with an optional %, or the normalised text.

    The last number counts where a text of at most 48 characters holds several; dollar signs and commas go.
    """

    def form(s: Column) -> Column:
        t, nums, yes = s["t"], s["nums"], s["yes"]
        last = (F.size(nums) == 1) | ((F.size(nums) > 1) & (F.length(t) <= 48))
        return F.when(yes != "", yes).when(T.contains_any(t, T.ABSTAIN_NUMERIC), t).when(last, F.try_element_at(nums, F.lit(-1))).otherwise(F.btrim(t, F.lit(" .")))

    return T.let(T.answer_text(answer), lambda t: T.let(T.record(t=t, nums=N.number_tokens(t), yes=F.regexp_extract(t, r"^(yes|no)(?:$|[^\p{L}\p{N}_])", 1)), form))


def turn_match(question: Column, pred: Column, gold: Column) -> Column:
    """STRUCT<strict, lenient, mismatch> of a dialogue turn's answer."""

    def verdict(s: Column) -> Column:
        strict = (s["p"] != "") & (s["p"] == s["g"])
        near = N.any_close(s["a"], s["b"], 0.01, 0.005) | (s["pct"] & N.any_close(s["a"], s["b"], 0.01, 0.5))
        return T.let(T.record(strict=strict, lenient=strict | near), lambda v: T.record(strict=v["strict"], lenient=v["lenient"], mismatch=kind(s, v)))

    def kind(s: Column, v: Column) -> Column:
        return (
            F.when(v["strict"], "match").when(T.contains_any(s["p"], T.ABSTAIN_NUMERIC), "abstain_error").when(v["lenient"], "rounding_or_format").when(N.flipped(s["a"], s["b"]), "sign_error")
            .when((F.size(s["a"]) > 0) & (F.size(s["b"]) > 0), "calculation_error").otherwise("text_mismatch")
        )

    first = T.record(p=turn_answer(pred), g=turn_answer(gold), pct=N.expects_percent(question))
    return T.let(first, lambda s: T.let(T.record(p=s["p"], g=s["g"], pct=s["pct"], a=N.turn_number(s["p"], s["pct"]), b=N.turn_number(s["g"], s["pct"])), verdict))


def benchmark_match(question: Column, pred: Column, gold: Column) -> Column:
    """Match under the benchmark's tolerances (C6): 0.51 or 0.051 and 1 % where a percentage is expected, else 1e-4."""

    def verdict(s: Column) -> Column:
        a, b = N.last_number(s["p"], s["pct"]), N.last_number(s["g"], s["pct"])
        whole = ~F.contains(s["g"], F.lit("."))
        tol = F.when(s["pct"] & whole, 0.51).when(s["pct"], 0.051).otherwise(1e-4)
        rel = F.when(s["pct"], 0.01).otherwise(1e-4)
        near = N.any_pair(a, b, lambda x, y: F.abs(x - y) <= F.greatest(rel * F.greatest(F.abs(x), F.abs(y)), tol))
        return near | answers_match(s["p"], s["g"])

    return T.let(T.record(p=N.numeric_surface(pred), g=N.numeric_surface(gold), pct=N.expects_percent(question)), verdict)


def execution_match(question: Column, context: Column, pred: Column, gold: Column, executed: Column) -> Column:
    """Match with the executed gold value at any scale the context states, else benchmark_match."""
    pct = N.expects_percent(question)
    near = N.any_close(N.scaled(N.last_number(pred, pct), context, pct), N.scaled(N.last_number(executed, pct), context, pct), 0.01, 0.51)
    return F.when(T.filled(executed) != "", near).otherwise(benchmark_match(question, pred, gold))


def benchmark_turn_match(question: Column, context: Column, pred: Column, gold: Column) -> Column:
    """Benchmark verdict on a dialogue turn (C8): strict, lenient by rounding only, or close at a stated scale."""
    pct = N.expects_percent(question)
    m = turn_match(question, pred, gold)
    near = N.any_close(N.scaled(N.last_number(pred, pct), context, pct), N.scaled(N.last_number(gold, pct), context, pct), 0.01, 0.51)
    return m["strict"] | (m["lenient"] & (m["mismatch"] == "rounding_or_format")) | near


def unit_error(pred: Column, gold: Column, scale: Column) -> Column:
    """Percent signs on one side only, or numbers apart by a scale that one side or the data set names."""
    sizes = (1e3, 1e6, 1e9)

    def ratio(x: Column, y: Column) -> Column:
        def near(r: Column) -> Column:
            hit = F.lit(False)
            for s in sizes:
                hit = hit | N.is_close(r, F.lit(s), 0.02, 0.5) | N.is_close(r * s, F.lit(1.0), 0.02, 0.5)
            return F.coalesce(hit, F.lit(False))

        return (y != 0) & T.let(F.abs(F.try_divide(x, y)), near)

    named = F.lower(T.strip(scale))
    by = F.when(named == "thousand", 1e3).when(named == "million", 1e6).when(named == "billion", 1e9)
    hundred = lambda x, y: N.is_close(x, y * 100.0, 0.01, 0.5) | N.is_close(x * 100.0, y, 0.01, 0.5)
    at_scale = lambda x, y: N.is_close(x, y * by, 0.02, 1.0) | N.is_close(x * by, y, 0.02, 1.0)
    return T.let(
        T.record(p=N.bracketed_numbers(pred), g=N.bracketed_numbers(gold)),
        lambda s: F.when(T.has_percent(pred) != T.has_percent(gold), True).when((T.unit_markers(pred) != T.unit_markers(gold)) & N.any_pair(s["p"], s["g"], ratio), True)
        .when((named == "percent") & N.any_pair(s["p"], s["g"], hundred), True).when(by.isNotNull() & N.any_pair(s["p"], s["g"], at_scale), True).otherwise(False),
    )


def rounding_error(pred: Column, gold: Column) -> Column:
    """Some numbers within 2 % or 1, the same numbers in another order, or the same text but for marks."""
    order = lambda a: F.array_sort(F.transform(a, lambda v: F.bround(v, 6)))
    compact = lambda c: F.regexp_replace(F.lower(T.strip(c)), r"[\s|,.$()%\-:;]", "")

    def verdict(s: Column) -> Column:
        near = (F.size(s["p"]) > 0) & (F.size(s["g"]) > 0) & (N.any_close(s["p"], s["g"], 0.02, 1.0) | (order(s["p"]) == order(s["g"])))
        return near | ((s["a"] != "") & (s["a"] == s["b"]))

    sides = T.record(p=N.bracketed_numbers(pred), g=N.bracketed_numbers(gold), a=compact(pred), b=compact(gold))
    return (T.strip(pred) != "") & (T.strip(gold) != "") & T.let(sides, verdict)


def inconsistent(answer: Column, reasoning: Column) -> Column:
    """The conclusion of the reasoning differs from the answer."""
    def differs(c: Column) -> Column:
        same = answers_match(c, T.strip(answer)) | N.any_close(N.bracketed_numbers(c), N.bracketed_numbers(answer), 0.01, 0.5) | F.contains(T.answer_text(c), T.answer_text(answer))
        return (c != "") & ~same

    return (T.strip(answer) != "") & (T.strip(reasoning) != "") & T.let(T.conclusion(reasoning), differs)
