"""Arithmetic programs: comma-separated calls whose results later calls can refer to as #0, #1, ...

The text is read once, left to right, with a stack of open calls; a value is computed when its call closes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from . import text as T

_TWO = 2


def _mean(xs: list[float]) -> float:
    return sum(xs) / len(xs)


#: Operator -> (number of arguments or None for any, at least one where the function needs it; function)
OPERATORS: dict[str, tuple[int | None, Callable[[list[float]], float | str]]] = {
    "add": (None, sum),
    "subtract": (_TWO, lambda x: x[0] - x[1]),
    "multiply": (None, lambda x: math.prod(x, start=1.0)),
    "divide": (_TWO, lambda x: x[0] / x[1]),
    "exp": (_TWO, lambda x: x[0] ** x[1]),
    "greater": (_TWO, lambda x: "yes" if x[0] > x[1] else "no"),
    "table_sum": (None, sum),
    "table_average": (None, _mean),
    "table_min": (None, min),
    "table_max": (None, max),
}
_STARTS = "|".join(OPERATORS)
_PIECE = re.compile(r"\s*(?:(?P<open>[A-Za-z_]+)\s*\(|(?P<close>\))|(?P<comma>,)|(?P<value>[^(),]+))")


class ProgramError(ValueError):
    pass


def _value(token: str, results: list) -> float | str:
    t = token.strip()
    if t.startswith("#"):
        k = int(t[1:])
        if not 0 <= k < len(results):
            raise ProgramError(f"no result {t}")
        return results[k]
    if t.startswith("const_"):
        return float(t[6:].replace("_", ""))
    t = t.replace("$", "")
    return float(t[:-1]) / 100.0 if t.endswith("%") else float(t)


def run(program: str) -> float | str:
    """Value of the last call of a program; ProgramError, ValueError, OverflowError or ZeroDivisionError if there is none."""
    results: list[float | str] = []
    calls: list[tuple[str, list]] = []
    at, n = 0, len(program.rstrip())
    if not n:
        raise ProgramError("empty program")
    while at < n:
        m = _PIECE.match(program, at)
        if not m or m.end() == at:
            raise ProgramError(f"unreadable at {at}")
        at = m.end()
        done = None
        if m["open"]:
            if m["open"] not in OPERATORS:
                raise ProgramError(f"unknown operator {m['open']}")
            calls.append((m["open"], []))
        elif m["close"]:
            if not calls:
                raise ProgramError("bracket without a call")
            name, args = calls.pop()
            count, f = OPERATORS[name]
            if count is not None and len(args) != count:
                raise ProgramError(f"{name} takes {count} arguments")
            done = f([float(a) for a in args])
        elif m["value"] and m["value"].strip():
            done = _value(m["value"], results)
        if done is not None:
            if isinstance(done, complex):
                raise ProgramError("no real value")
            (calls[-1][1] if calls else results).append(done)
    if calls:
        raise ProgramError("call not closed")
    if not results:
        raise ProgramError("no call")
    return results[-1]


def evaluate(program: str | None) -> tuple[bool, float | None, str | None, str]:
    try:
        v = run(program or "")
    except (ValueError, ArithmeticError) as e:
        return False, None, None, str(e) or type(e).__name__
    return (True, None, v, "") if isinstance(v, str) else (True, float(v), None, "")


_RESULT = StructType([StructField("executable", BooleanType()), StructField("num", DoubleType()), StructField("txt", StringType()), StructField("error", StringType())])


@F.pandas_udf(_RESULT)
def execute(programs: pd.Series) -> pd.DataFrame:
    """STRUCT<executable, num, txt, error> of each program; NULL and empty ones are not executable."""
    seen: dict = {}
    rows = []
    for p in programs:
        if p not in seen:
            seen[p] = evaluate(p)
        rows.append(seen[p])
    return pd.DataFrame(rows, columns=["executable", "num", "txt", "error"])


def looks_like_program(c: Column) -> Column:
    return T.strip(c).rlike(rf"^(?:{_STARTS})\(")


_NUM = r"(-?[0-9]+(?:\.[0-9]+)?)"


def flat_value(c: Column) -> Column:
    """Value of a program of one two-argument call, or of two of which the second begins with #0, of plain numbers; NULL for
    anything else. Stays in the JVM; ``execute`` handles the rest."""
    ops = "(add|subtract|multiply|divide)"
    shape = rf"^{ops}\({_NUM}, ?{_NUM}\)(?:, ?{ops}\(#0, ?{_NUM}\))?$"

    def apply(op: Column, a: Column, b: Column) -> Column:
        return F.when(op == "add", a + b).when(op == "subtract", a - b).when(op == "multiply", a * b).otherwise(F.try_divide(a, b))

    def value(m: Column) -> Column:
        first = apply(m["op"], m["a"], m["b"])
        return F.when(m["op"] == "", None).when(m["then"] == "", first).otherwise(T.let(first, lambda x: apply(m["then"], x, m["c"])))

    part = lambda t, k: F.regexp_extract(t, shape, k)
    num = lambda t, k: part(t, k).try_cast("double")
    return T.let(T.strip(c), lambda t: T.let(T.record(op=part(t, 1), a=num(t, 2), b=num(t, 3), then=part(t, 4), c=num(t, 5)), value))
