"""Multiple-choice options, labels and yes/no answers, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

# fixed values: words for yes and no, labels and categories with what they are written as
YES = ("yes", "true", "y", "1", "correct", "是", "对", "正确")
NO = ("no", "false", "n", "0", "incorrect", "否", "错", "错误")
EXAM_TRUE = ("正确", "对", "是", "true", "yes", "y", "t", "√")
EXAM_FALSE = ("错误", "错", "否", "false", "no", "n", "f", "×")
SENTIMENTS = ("negative", "neutral", "positive")
SENTIMENT_ZH = (("积极", "积极"), ("正面", "积极"), ("正向", "积极"), ("利好", "积极"), ("消极", "消极"), ("负面", "消极"), ("负向", "消极"), ("利空", "消极"), ("中性", "中性"))
CATEGORIES_ZH = ("公司", "行业", "大盘", "中国", "国际", "经济", "政策", "期货", "债券", "房地产", "外汇", "虚拟货币", "新冠", "能源", "政治")


# fixed values: words before the letter that a reasoning settles on, in order of precedence
REASONED_LEADS = ("最终答案|final_answer|答案|故选|应选|选择|选|因此选|所以选|综上选", "正确的是|错误的是|不正确的是|不属于的是|最合理的是")


# fixed values: forms in which an exam answer names its letter, or that a statement is right or wrong
EXAM_LEAD = r"^(?:答案|选项|故选|应选|选择|最终答案)[是为: ]*([A-D])"
EXAM_PLAIN = r"^(?:选|选项)?([A-D])(?:选项)?$"
EXAM_IS_TRUE, EXAM_IS_FALSE = "^(?:判断|答案)为正确", "^(?:判断|答案)为错误"


def _letter_index(letter: Column) -> Column:
    return F.ascii(F.upper(letter)) - 65


def choice_index(answer: Column, options: Column) -> Column:
    """Index from 0 of the option an answer selects, or NULL (C14): a letter a to f that stands alone or right after an option word, a 1-based number,
    an option's text, or a text that holds that of an option of at least 4 characters."""
    n = F.size(F.coalesce(options, F.array().cast("array<string>")))

    def index(s: Column) -> Column:
        at = _letter_index(s["letter"])
        norm = s["norm"]
        hit = F.transform(options, lambda o: T.let(T.choice_text(o), lambda x: ((norm != "") & (x == norm)) | ((F.length(x) >= 4) & F.contains(norm, x))))
        by_text = F.array_position(hit, F.lit(True)) - 1
        return (
            F.when((s["letter"] != "") & (at < n), at).when((s["number"] >= 0) & (s["number"] < n), s["number"])
            .otherwise(T.let(by_text, lambda b: F.when(b >= 0, b))).cast("int")
        )

    def parts(t: Column) -> Column:
        letter = F.regexp_extract(t, r"(?i)(?:^|[^\p{L}\p{N}_])(?:(?:option|choice|answer)\s*[:=-]?\s*)?([a-f])(?:$|[^\p{L}\p{N}_])", 1)
        return T.record(letter=letter, number=F.when(t.rlike("^[0-9]{1,6}$"), t.cast("int") - 1), norm=T.choice_text(t))

    return T.let(T.strip(answer), lambda t: F.when(t != "", T.let(parts(t), index)))


def yes_no(c: Column) -> Column:
    """yes, no or '' for a text that is one word for either."""
    return T.let(T.answer_text(c), lambda t: F.when(t.isin(*YES), "yes").when(t.isin(*NO), "no").otherwise(""))


def first_yes_no(c: Column) -> Column:
    """First word yes or no in the text, or '' (C20)."""
    return F.regexp_extract(T.answer_text(c), r"(?:^|[^\p{L}\p{N}_])(yes|no)(?:$|[^\p{L}\p{N}_])", 1)


def is_judgment(question: Column, reference: Column) -> Column:
    return F.lower(T.filled(question)).rlike("true or false|yes or no|是否|判断") | (yes_no(reference) != "")


def option_letters(options: Column) -> Column:
    """MAP letter -> text of options written 'A. text' for A to D."""
    kept = F.filter(options, lambda o: T.strip(o).rlike(r"(?i)^[A-D][.):：、\s]"))
    pairs = F.transform(kept, lambda o: F.struct(F.upper(F.substring(T.strip(o), 1, 1)).alias("key"), F.regexp_replace(T.strip(o), r"(?U)^[A-Da-d][.):：、\s]+", "").alias("value")))
    # the last one of a letter counts
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(F.coalesce(last, F.array().cast("array<struct<key:string,value:string>>")))


def bare_option(c: Column) -> Column:
    return F.regexp_replace(T.exam_text(c), r"^[A-Da-d][.):：、\s]*", "")


def exam_letter(answer: Column, letters: Column) -> Column:
    """Letter A to D that an exam answer selects, or '' (C16): by form, else by the one option with its text, else by the one
    option whose text it holds."""
    def letter(s: Column) -> Column:
        bare = F.transform(F.map_entries(letters), lambda e: T.record(key=e["key"], value=bare_option(e["value"])))
        same = lambda es: F.filter(es, lambda e: e["value"] == s["norm"])
        held = lambda es: F.filter(es, lambda e: (e["value"] != "") & F.contains(s["norm"], e["value"]))
        only = lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0))["key"])
        by_text = T.let(bare, lambda es: F.coalesce(T.let(same(es), only), T.let(held(es), only), F.lit("")))
        return F.when(s["t"] == "", "").when(s["lead"] != "", s["lead"]).when(s["plain"] != "", s["plain"]).otherwise(by_text)

    def parts(t: Column) -> Column:
        lead = F.regexp_extract(t, EXAM_LEAD, 1)
        return T.record(t=t, lead=lead, plain=F.regexp_extract(t, EXAM_PLAIN, 1), norm=bare_option(answer))

    return T.let(F.upper(T.exam_text(answer)), lambda t: T.let(parts(t), letter))


def exam_true_false(c: Column) -> Column:
    said = lambda t: F.when(t.isin(*EXAM_TRUE) | t.rlike(EXAM_IS_TRUE), "true").when(t.isin(*EXAM_FALSE) | t.rlike(EXAM_IS_FALSE), "false").otherwise("")
    return T.let(T.exam_text(c), said)


def stated_option(answer: Column, options: Column) -> Column:
    """STRUCT<letter, kind> of the option that an exam answer states (C17)."""
    t = T.strip(answer)
    exact = F.upper(t).isin("A", "B", "C", "D")
    lead = F.regexp_extract(t, r"(?s)^([A-Da-d])\s*[.)．、:：-]?\s*.+$", 1)
    bare = F.transform(options, lambda o: T.strip(F.regexp_replace(T.strip(o), r"(?i)^[A-G]\s*[.)．、:：-]?\s*", "")))
    at = F.greatest(F.array_position(F.transform(options, T.strip), t), F.array_position(bare, t))
    found = F.when(exact, F.upper(t)).when(lead != "", F.upper(lead)).when(at > 0, F.char(at + 64)).otherwise("")
    kind = F.when(exact, "exact_letter").when(lead != "", "letter_with_extra_text").when(at > 0, "option_text_exact").otherwise("unmapped")
    return F.struct(found.alias("letter"), kind.alias("kind"))


def reasoned_option(reasoning: Column, options: Column) -> Column:
    """Letter on which a reasoning settles, or '' (C17): the last one that it says to choose, else the one option whose text
    it mentions."""
    said = F.lit(None).cast("string")
    for words in REASONED_LEADS:
        got = F.regexp_extract_all(T.filled(reasoning), F.lit(rf"(?i)(?:{words})\s*[:：]?\s*([A-D])(?![\p{{L}}\p{{N}}_])"), F.lit(1))
        said = F.coalesce(said, F.try_element_at(got, F.lit(-1)))
    bare = F.transform(options, lambda o: T.strip(F.regexp_replace(T.strip(o), r"(?i)^[A-G]\s*[.)．、:：-]?\s*", "")))
    held = F.filter(F.transform(bare, lambda o, i: F.when((F.length(o) >= 2) & F.contains(T.filled(reasoning), o), F.char(i + 65))), lambda x: x.isNotNull())
    return F.when(said.isNotNull(), F.upper(said)).when(F.size(held) == 1, F.get(held, F.lit(0))).otherwise("")


def sentiment(c: Column) -> Column:
    """negative, neutral or positive: the text itself, else the first of them (in this order) that it holds as a word."""
    def label(t: Column) -> Column:
        out = F.when(t.isin(*SENTIMENTS), t)
        for s in SENTIMENTS:
            out = out.when(T.word(t, s), s)
        return out.otherwise("")

    return T.let(T.label_text(c), label)


def reasoned_sentiment(c: Column) -> Column:
    """Label that a reasoning names by one of four phrases, or '' (C19)."""
    labels = "(negative|neutral|positive)"
    phrases = (f"sentiment (?:is|should be|would be|therefore is|thus is) {labels}", f"classif(?:y|ied) as {labels}", f"label(?: is| should be)? {labels}", f"overall(?: sentiment)?[: ]+{labels}")
    return T.let(T.label_text(c), lambda t: F.coalesce(*(F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in phrases), F.lit("")))


def _first_held(table: tuple[tuple[str, str], ...]):
    def value(t: Column) -> Column:
        out = F.when(F.contains(t, F.lit(table[0][0])), table[0][1])
        for k, v in table[1:]:
            out = out.when(F.contains(t, F.lit(k)), v)
        return out.otherwise(t)

    return value


def sentiment_zh(c: Column) -> Column:
    """Label that a short answer holds, by the first entry of the table, else the answer itself."""
    return T.let(T.short_answer(c), _first_held(SENTIMENT_ZH))


def category_zh(c: Column) -> Column:
    return T.let(T.short_answer(c), _first_held(tuple((k, k) for k in CATEGORIES_ZH)))


def relabelled(options: Column) -> Column:
    """Options as lines with letters by position; labels that they bring are removed."""
    def one(o: Column, i: Column) -> Column:
        letter = F.char(i + 65)
        out = T.strip(o)
        for mark in (".", "．", "、", ")"):
            lead = F.concat(letter, F.lit(mark))
            out = F.when(F.startswith(out, lead), T.strip(F.substr(out, F.lit(3)))).otherwise(out)
        return F.concat(letter, F.lit(". "), out)

    return F.coalesce(F.array_join(F.transform(options, one), "\n"), F.lit(""))
