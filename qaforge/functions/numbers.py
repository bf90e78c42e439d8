"""Numbers in texts and tolerant comparison, as Column functions. Candidates are ARRAY<DOUBLE>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

_NONE = "array<double>"


def none() -> Column:
    return F.array().cast(_NONE)


def _double(t: Column) -> Column:
    """Number of a token of digits, sign and point; NULL for anything else."""
    return F.when(t.rlike(r"^[-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)$"), t.cast("double"))


def _with_percent(token: Column) -> Column:
    """[value] of a token, with value / 100 as well if it ends in %."""
    got = text.record(v=_double(F.regexp_replace(token, "%$", "")), pct=F.endswith(token, F.lit("%")))
    return text.let(got, lambda g: F.when(g["v"].isNull(), none()).when(g["pct"], F.array(g["v"], g["v"] / 100.0)).otherwise(F.array(g["v"])))


def whole_number(c: Column) -> Column:
    """Candidates of a text that is one number, perhaps a percentage, and nothing else."""
    number = r"^[-+]?[0-9]+(?:\.[0-9]+)?%?$"
    return text.let(text.drop_chars(text.strip(c), "$,"), lambda t: F.when(t.rlike(number), _with_percent(t)).otherwise(none()))


def number_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"([-+]?[0-9]+(?:\.[0-9]+)?%?)"), F.lit(1))


def any_number(c: Column) -> Column:
    """whole_number, else the candidates of all number tokens."""
    tokens = lambda t: F.flatten(F.transform(number_tokens(t), _with_percent))
    return text.let(text.answer_text(c), lambda t: text.let(whole_number(t), lambda d: F.when(F.size(d) > 0, d).otherwise(tokens(t))))


_UNITS = r"million|millions|billion|billions|thousand|thousands|usd|dollars|dollar"


def numeric_surface(c: Column) -> Column:
    """Lower case without dollar signs, commas and unit words, single spaces, no outer spaces and points."""
    bare = text.drop_chars(F.lower(text.strip(c)), "$,")
    return F.btrim(text.squash(F.regexp_replace(bare, rf"(?<![\p{{L}}\p{{N}}_])(?:{_UNITS})(?![\p{{L}}\p{{N}}_])", "")), F.lit(" ."))


def last_number(c: Column, expects_percent: Column) -> Column:
    """Candidates of the text's number, else of its last number token (X3); a small number is also read as a share if a
    percentage is expected."""
    t = numeric_surface(c)
    token = F.try_element_at(F.regexp_extract_all(t, F.lit(r"([-+]?[0-9]+(?:\.[0-9]+)?%?)"), F.lit(1)), F.lit(-1))
    return text.let(_with_percent(F.coalesce(token, F.lit(""))), lambda g: _share(g, expects_percent))


def _share(got: Column, expects_percent: Column) -> Column:
    v = F.get(got, F.lit(0))
    return F.when((F.size(got) == 1) & expects_percent & (F.abs(v) <= 1), F.array(v, v * 100.0)).otherwise(got)


def turn_number(c: Column, expects_percent: Column) -> Column:
    """Candidates of a normalised answer of a dialogue turn, which must be one number."""
    return F.array_distinct(text.let(_with_percent(text.strip(c)), lambda g: _share(g, expects_percent)))


def bracketed_numbers(c: Column) -> Column:
    """Candidates of all number tokens; a token in brackets is negative."""
    tokens = F.regexp_extract_all(text.filled(c), F.lit(r"(\(?[-+]?\$?[0-9][0-9,]*(?:\.[0-9]+)?%?\)?)"), F.lit(1))

    def values(t: Column) -> Column:
        negative = F.startswith(t, F.lit("(")) & F.endswith(t, F.lit(")"))
        return F.transform(_with_percent(text.drop_chars(t, "()$,")), lambda v: F.when(negative, -F.abs(v)).otherwise(v))

    return F.flatten(F.transform(tokens, values))


def is_close(a: Column, b: Column, rel: float, tol: float) -> Column:
    """abs(a - b) <= max(rel * max(abs(a), abs(b)), tol); equal infinities are close, NaN never is."""
    nan = F.isnan(a) | F.isnan(b)
    inf = (F.abs(a) == float("inf")) | (F.abs(b) == float("inf"))
    return F.when(nan, False).when(inf, a == b).otherwise(F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(tol)))


def any_pair(a: Column, b: Column, test: Callable[[Column, Column], Column]) -> Column:
    """Whether some candidate of a and some candidate of b pass the test."""
    return F.exists(a, lambda x: F.exists(b, lambda y: test(x, y)))


def any_close(a: Column, b: Column, rel: float, tol: float) -> Column:
    return any_pair(a, b, lambda x, y: is_close(x, y, rel, tol))


def flipped(a: Column, b: Column, rel: float = 0.01, tol: float = 0.5) -> Column:
    """Whether candidates agree but for the sign."""
    return any_pair(a, b, lambda x, y: (x * y < 0) & is_close(F.abs(x), F.abs(y), rel, tol))


def expects_percent(question: Column) -> Column:
    return F.lower(text.filled(question)).rlike("percent|proportion|portion|rate|margin")


def wants_number(question: Column) -> Column:
    q = F.lower(text.filled(question))
    return text.word(q, r"how much|how many|what (?:is|was|were|are)|total|amount|value|expense|revenue|price|rate|percent")


def is_yes_no_question(question: Column) -> Column:
    return text.word(F.lower(text.strip(question)), "is|are|was|were|do|does|did|can|could|should|would|will|has|have|had")


def scaled(candidates: Column, context: Column, percent: Column) -> Column:
    """Candidates with their multiples by the scale that the context states, unless a percentage is expected."""
    low = F.lower(text.filled(context))

    def by(found: Column, words: str, factor: float) -> Column:
        return text.let(found, lambda x: F.when(F.contains(low, F.lit(words)), F.array_union(x, F.transform(x, lambda v: v * factor))).otherwise(x))

    return text.let(candidates, lambda c: F.when(percent, c).otherwise(by(by(c, "in millions", 1e6), "in billions", 1e9)))


def binary(c: Column) -> Column:
    """1 for true and non-zero integers, 0 for anything else (X11); c is text."""
    t = F.lower(text.strip(c))
    return F.when(t == "true", 1).when(t.rlike(r"^[-+]?[0-9]+$"), F.when(t.rlike(r"^[-+]?0+$"), 0).otherwise(1)).otherwise(0)
