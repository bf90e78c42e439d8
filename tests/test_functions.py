"""Table-driven tests of Column functions; expectations are written by hand from their definitions."""

import pytest
from pyspark.sql import functions as F

from qaforge.functions import compare as C
from qaforge.functions import numbers as N
from qaforge.functions import options as O
from qaforge.functions import program as P
from qaforge.functions import text as T


def run(spark, f, *rows):
    """Values of f over rows of strings."""
    n = len(rows[0])
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(n)))
    got = df.select("i", f(*(F.col(f"c{k}") for k in range(n))).alias("v")).orderBy("i").collect()
    return [g["v"] for g in got]


TEXT = [
    (T.answer_text, "  $1,234\t　Million ", "1234 million"), (T.answer_text, None, ""), (T.label_text, " A  $5,0 ", "a $5,0"), (T.exam_text, "（Ａ）：　你 好。", "(Ａ):你好."),
    (T.span_text, "“ 收购 ”。", "收购"), (T.short_answer, "答案是：收购。", "：收购".strip("：")), (T.short_answer, "该新闻属于政策", "政策"), (T.choice_text, "Option (b) Standard", "standard"),
    (T.reply_value, ' , Answer: "42" ', "42"), (T.conclusion, "a\nConclusion: 5\nCONCLUSION : 6 \nend", "6"), (T.conclusion, "one\n\n two \n", "two"), (T.conclusion, "", ""), (T.has_percent, "5 Percentage", True),
    (T.has_percent, "5", False),
]


@pytest.mark.parametrize("f,x,want", TEXT)
def test_text(spark, f, x, want):
    assert run(spark, f, (x,)) == [want]


def test_clip(spark):
    assert run(spark, lambda c: T.clip(c, 20), ("x" * 20,), ("y" * 21,), (None,)) == ["x" * 20, "y" * 5 + "\n[TRUNCATED]", ""]


def test_sections_and_tables(spark):
    df = spark.range(1).select(
        T.sections(F.lit(" a "), F.lit(None).cast("string"), F.lit(""), F.lit("b")).alias("s"),
        T.table_text(F.array(F.array(F.lit("x"), F.lit(None).cast("string"), F.lit(" 1 ")), F.array(F.lit("")))).alias("t"),
        T.table_text(F.lit(None).cast("array<array<string>>")).alias("none"),
        F.array_join(T.lettered_options(F.lit("one"), F.lit(" "), F.lit("three")), "|").alias("o"),
        F.array_join(T.unit_markers(F.lit("5 mn, 3 thousand and 2bn")), ",").alias("u"),
    ).first()
    assert tuple(df) == ("a\n\nb", "x |  | 1", "", "A. one|C. three", "million,thousand")


@pytest.mark.parametrize(
    "f,x,want",
    [
        (N.whole_number, "$1,234.5", [1234.5]), (N.whole_number, "12%", [12.0, 0.12]), (N.whole_number, "12 apples", []), (N.any_number, "from 3 to 4%", [3.0, 4.0, 0.04]),
        (N.bracketed_numbers, "(1,200) and 5%", [-1200.0, 5.0, 0.05]), (N.bracketed_numbers, None, []), (N.binary, "true", 1), (N.binary, "0", 0), (N.binary, "-3", 1), (N.binary, "x", 0), (N.binary, None, 0),
    ],
)
def test_numbers(spark, f, x, want):
    got = run(spark, f, (x,))[0]
    assert got == (pytest.approx(want) if isinstance(want, list) else want)


def test_last_number_and_percent(spark):
    yes = F.lit(True)
    assert run(spark, lambda c: N.last_number(c, yes), ("0.25",), ("about 3 million dollars",), ("none",)) == [[0.25, 25.0], [3.0], []]
    assert run(spark, lambda c: N.turn_number(c, yes), ("0.5",), ("1d",), ("",)) == [[0.5, 50.0], [], []]


def test_is_close(spark):
    df = spark.createDataFrame([(1.0, 1.00005), (1.0, 1.1), (float("inf"), float("inf")), (float("nan"), 1.0), (0.0, 0.00005)], "a double, b double")
    assert [r[0] for r in df.select(N.is_close(F.col("a"), F.col("b"), 1e-4, 1e-4)).collect()] == [True, False, True, False, True]


@pytest.mark.parametrize(
    "pred,gold,want",
    [
        ("$5.00", "5", "match"), ("50%", "0.5", "match"), ("cannot be determined", "5", "abstain_error"), ("5.3", "5", "rounding_or_format"), ("-50", "50", "sign_error"), ("80", "5", "calculation_error"),
        ("apples", "5", "text_mismatch"), ("", "", "text_mismatch"), (None, "5", "text_mismatch"), ("Yes ", "yes", "match"),
    ],
)
def test_mismatch(spark, pred, gold, want):
    assert run(spark, C.mismatch, (pred, gold)) == [want]


def test_turn_match(spark):
    f = lambda q, p, g: C.turn_match(q, p, g)
    got = run(spark, f, ("what percentage?", "12.4%", "12%"), ("what?", "the answer is 7", "7"), ("what?", "yes, it did", "yes"), ("what?", "3", "4"))
    assert [tuple(g) for g in got] == [(False, True, "rounding_or_format"), (True, True, "match"), (True, True, "match"), (False, False, "calculation_error")]


def test_benchmark_and_execution(spark):
    f = lambda q, p, g: C.benchmark_match(q, p, g)
    assert run(spark, f, ("which rate?", "14.4", "14"), ("how many?", "14.4", "14"), ("which rate?", "0.14", "14%")) == [True, False, True]
    g = lambda q, c, p, e: C.execution_match(q, c, p, e, e)
    assert run(spark, g, ("how much?", "($ in millions)", "3000000", "3"), ("how much?", "", "3000000", "3")) == [True, False]


def test_unit_and_rounding(spark):
    f = lambda p, g: C.unit_error(p, g, F.lit(""))
    assert run(spark, f, ("5%", "5"), ("5 million", "5000"), ("5", "5"), ("5 thousand", "5")) == [True, True, False, False]
    assert run(spark, lambda p, g: C.unit_error(p, g, F.lit("thousand")), ("5000", "5")) == [True]
    assert run(spark, C.rounding_error, ("1,010", "1000"), ("a-b", "a b"), ("5", ""), ("2 1", "1 2")) == [True, True, False, True]


def test_inconsistent(spark):
    assert run(spark, C.inconsistent, ("5", "Conclusion: 5"), ("5", "Conclusion: 900"), ("", "x"), ("yes", "so the answer is yes")) == [False, True, False, False]


@pytest.mark.parametrize(
    "text,want",
    [
        ("add(1, 2)", (True, 3.0, None)), ("multiply(2, 3), subtract(#0, 1)", (True, 5.0, None)), ("divide(add(1, 1), const_4)", (True, 0.5, None)), ("greater(2, 1)", (True, None, "yes")),
        ("table_average(1, 2, 3)", (True, 2.0, None)), ("exp(2, 3)", (True, 8.0, None)), ("add($5, 10%)", (True, 5.1, None)), ("5", (True, 5.0, None)),
    ],
)
def test_program(text, want):
    got = P.evaluate(text)
    assert (got[0], pytest.approx(got[1]) if got[1] is not None else None, got[2]) == want


@pytest.mark.parametrize("text", ["", None, "divide(1, 0)", "subtract(1)", "foo(1)", "add(1, 2", "add(#3, 1)", "add(x, 1)", ")", "add(greater(1, 2), 1)", "table_min()"])
def test_program_fails(text):
    assert P.evaluate(text)[0] is False and P.evaluate(text)[3]


def test_program_columns(spark):
    df = spark.createDataFrame([("multiply(2, 3), subtract(#0, 1)",), ("add(1, 2)",), ("greater(1, 2)",), (None,)], "p string")
    assert [r[0] for r in df.select(P.flat_value(F.col("p"))).collect()] == [5.0, 3.0, None, None]
    assert [r[0] for r in df.select(P.execute("p")["executable"]).collect()] == [True, True, True, False]
    assert [r[0] for r in df.select(P.looks_like_program(F.col("p"))).collect()] == [True, True, True, False]


def test_options(spark):
    opts = F.array(F.lit("A. economy"), F.lit("B. standard"), F.lit("C. large"))
    f = lambda c: O.choice_index(c, opts)
    # the article "a" selects option A: a stand-alone letter counts anywhere
    assert run(spark, f, ("Option C",), ("(b) standard",), ("2",), ("the standard one",), ("a fine day",), ("nothing",), ("",), (None,), ("F",)) == [2, 1, 1, 1, 0, None, None, None, None]
    g = lambda c: O.exam_letter(c, O.option_letters(opts))
    assert run(spark, g, ("答案：B",), ("选C",), ("economy",), ("我认为 large 最好",), ("",), ("b",)) == ["B", "C", "A", "C", "", "B"]
    h = lambda c: O.stated_option(c, opts)["kind"]
    assert run(spark, h, ("B",), ("B. standard",), ("large",), ("huh?",)) == ["exact_letter", "letter_with_extra_text", "option_text_exact", "unmapped"]
    k = lambda c: O.reasoned_option(c, opts)
    assert run(spark, k, ("选择 A,后改,因此选择 B",), ("it is large",), ("neither",)) == ["B", "C", ""]
    assert spark.range(1).select(O.relabelled(F.array(F.lit("A. x"), F.lit("y"), F.lit("C) z")))).first()[0] == "A. x\nB. y\nC. z"


def test_labels(spark):
    assert run(spark, O.sentiment, ("Positive.",), ("neutral or negative",), ("none",)) == ["positive", "negative", ""]
    assert run(spark, O.reasoned_sentiment, ("The sentiment is negative here",), ("classified as neutral",), ("x",)) == ["negative", "neutral", ""]
    assert run(spark, O.sentiment_zh, ("情感是利好。",), ("其他",)) == ["积极", "其他"]
    assert run(spark, O.category_zh, ("该新闻属于外汇类",)) == ["外汇"]
    assert run(spark, O.first_yes_no, ("Well, No, yes",), ("nothing",)) == ["no", ""]
    assert run(spark, O.yes_no, ("正确",), ("0",), ("maybe",)) == ["yes", "no", ""]
    assert run(spark, O.exam_true_false, ("判断为正确",), ("×",), ("?",)) == ["true", "false", ""]
    assert run(spark, lambda c: T.abstains(c, "instruction"), ("文中未提及。",), ("收购",)) == [True, False]
