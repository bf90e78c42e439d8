"""Answer comparison, programs, options, rule judges and error classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions import numbers as N
from ..functions import options as O
from ..functions import program as P
from ..functions import text as T
from ..operators import badcases, execution, judges, repair
from ..session import table
from .sqlbits import GOLD, GOLD_NUM, MCQ, NUMERIC_PAIRS, PRED_NUM, PROGRAMS, WS, answer_text, close, label_text, strip


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_samples")


def _view(spark: SparkSession, d: str, name: str, sql: str) -> DataFrame:
    table(spark, d, name).createOrReplaceTempView(f"_view_{name}")
    return spark.sql(sql.replace(f"from {name}", f"from _view_{name}"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return _view(spark, d, "lineitem", NUMERIC_PAIRS)


def _key(df: DataFrame, **cols) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber", *(c.alias(k) for k, c in cols.items()))


_P, _G = "prediction", "gold"


def isclose(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return _key(li, close=N.is_close(F.col("l_extendedprice"), F.round("l_extendedprice", -1), 1e-4, 1e-4), near=N.is_close(F.col("l_quantity"), F.col("l_quantity") + F.col("l_discount"), 0.01, 0.05))


def strict_match(spark: SparkSession, d: str) -> DataFrame:
    return _key(_pairs(spark, d), matched=C.answers_match(F.col(_P), F.col(_G)))


def lenient_match(spark: SparkSession, d: str) -> DataFrame:
    return _key(_pairs(spark, d), matched=C.lenient_match(F.col(_P), F.col(_G)))


def sign_error(spark: SparkSession, d: str) -> DataFrame:
    return _key(_pairs(spark, d), flipped=C.sign_error(F.col(_P), F.col(_G)))


def mismatch_ladder(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).groupBy("kind", C.mismatch(F.col(_P), F.col(_G)).alias("category")).agg(F.count("*").alias("n"))


def badcase_counts(spark: SparkSession, d: str) -> DataFrame:
    return badcases.counts(_pairs(spark, d).withColumn("category", badcases.numeric(F.col(_P), F.col(_G))))


def _question():
    return F.when(F.col("kind") == 4, "What percentage is it?").otherwise("What value is it?")


def multi_turn_match(spark: SparkSession, d: str) -> DataFrame:
    m = C.turn_match(_question(), F.col(_P), F.col(_G))
    return _pairs(spark, d).select("kind", m["strict"].alias("strict"), m["lenient"].alias("lenient"), m["mismatch"].alias("mismatch")).groupBy("kind", "strict", "lenient", "mismatch").agg(F.count("*").alias("n"))


def benchmark_match(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).groupBy("kind", C.benchmark_match(_question(), F.col(_P), F.col(_G)).alias("correct")).agg(F.count("*").alias("n"))


def unit_scaled(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).withColumn("context", F.when(F.col("kind") == 7, "Amounts in millions of dollars").otherwise("Amounts in dollars"))
    return p.groupBy("kind", C.execution_match(F.lit("What value is it?"), F.col("context"), F.when(F.col("kind") == 7, F.concat(F.regexp_replace(F.col(_G), r"\..*$", ""), F.lit("000000"))).otherwise(F.col(_P)), F.col(_G), F.col(_G)).alias("correct")).agg(F.count("*").alias("n"))


def percent_unit_error(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).groupBy("kind", C.unit_error(F.col(_P), F.col(_G), F.lit("")).alias("unit_error")).agg(F.count("*").alias("n"))


def rounding_error(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).groupBy("kind", C.rounding_error(F.col(_P), F.col(_G)).alias("rounding")).agg(F.count("*").alias("n"))


def examples_per_category(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).withColumn("category", badcases.numeric(F.col(_P), F.col(_G)))
    return badcases.examples(p, 8, order=["l_orderkey", "l_linenumber", "gold"]).select("category", "rank", "l_orderkey", "l_linenumber", "gold")


def program_eval(spark: SparkSession, d: str) -> DataFrame:
    x = execution.executed(_view(spark, d, "lineitem", PROGRAMS), "program", "r")
    return _key(x, num=F.col("r.num"), txt=F.col("r.txt"), executable=F.col("r.executable"))


def program_flat(spark: SparkSession, d: str) -> DataFrame:
    return _key(_view(spark, d, "lineitem", PROGRAMS), num=P.flat_value(F.col("program")), is_program=P.looks_like_program(F.col("program")))


def _options():
    return F.array(F.lit("A. economy"), F.lit("B. standard"), F.lit("C. large"), F.lit("D. promo"))


def choice_index(spark: SparkSession, d: str) -> DataFrame:
    return _view(spark, d, "part", MCQ).select("p_partkey", O.choice_index(F.col("model_answer"), _options()).alias("chosen"), O.choice_index(F.col("reference_answer"), _options()).alias("right"))


def rule_mcq(spark: SparkSession, d: str) -> DataFrame:
    g = judges.generic(F.lit("Which one?"), _options(), F.col("model_answer"), F.col("reference_answer"))
    return _view(spark, d, "part", MCQ).select("p_partkey", g["score"].alias("score"), g["method"].alias("method"))


def exam_judge(spark: SparkSession, d: str) -> DataFrame:
    j = judges.exam(F.col("options"), F.col("model_answer"), F.col("reference_answer"))
    q = _qa(spark, d).where("source = 'financeiq' and model_answer is not null")
    return q.select(j["score"].alias("score"), j["mismatch_type"].alias("mismatch_type")).groupBy("score", "mismatch_type").agg(F.count("*").alias("n"))


def exam_letters(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'financeiq'")
    return q.select("row_id", O.exam_letter(F.col("model_answer"), O.option_letters(F.col("options"))).alias("letter"))


def exam_badcases(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'financeiq'").withColumn("parse_status", F.when(F.col("model_answer").isNull(), "failed").otherwise("success"))
    c = badcases.exam(F.col("model_answer"), F.col("reference_answer"), F.col("model_reasoning"), F.col("options"), F.col("parse_status"))
    return badcases.counts(q.withColumn("category", c))


def table_badcases(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'tatqa' and model_answer is not null").where(~C.answers_match(F.col("model_answer"), F.col("reference_answer")))
    c = badcases.table_question(F.col("model_answer"), F.col("reference_answer"), F.col("model_reasoning"), F.lit("success"), F.lit("arithmetic"), F.lit(""))
    return badcases.counts(q.withColumn("category", c))


def instruction_judge(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'fincuge_instruction' and model_answer is not null").withColumn("task", F.get_json_object("metadata", "$.file_name"))
    j = judges.instruction(F.col("task"), F.col("question"), F.col("model_answer"), F.col("reference_answer"))
    return q.select("task", j["score"].alias("score"), j["mismatch_type"].alias("mismatch_type")).groupBy("task", "score", "mismatch_type").agg(F.count("*").alias("n"))


def yesno_judge(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source in ('convfinqa', 'finance_alpaca') and model_answer is not null")
    j = judges.open_question(F.col("question"), F.col("model_answer"), F.col("reference_answer"))
    return q.select("row_id", j["score"].alias("score"), O.first_yes_no(F.col("model_answer")).alias("said"))


def sentiment_judge(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'financial_phrasebank' and model_answer is not null")
    j = judges.sentiment(F.col("model_answer"), F.col("reference_answer"))
    return q.select("row_id", j["score"].alias("score"), j["mismatch_type"].alias("mismatch_type"))


def sentiment_confusion(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'financial_phrasebank' and model_answer is not null")
    return badcases.confusion(q, O.sentiment(F.col("reference_answer")), O.sentiment(F.col("model_answer")))


def sentiment_badcases(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'financial_phrasebank' and model_answer is not null")
    return badcases.counts(q.withColumn("category", badcases.sentiment(F.col("model_answer"), F.col("reference_answer"), F.col("model_reasoning"))))


def judgment_rule(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source <> 'financeiq' and model_answer is not null").withColumn("options", F.lit(None).cast("array<string>"))  # exam answers are those of rule_mcq and exam_judge
    g = judges.generic(F.col("question"), F.col("options"), F.col("model_answer"), F.col("reference_answer"))
    return q.select(g["score"].alias("score"), g["method"].alias("method")).groupBy("score", "method").agg(F.count("*").alias("n"))


def topk_subjects(spark: SparkSession, d: str) -> DataFrame:
    return badcases.top_values(_qa(spark, d).withColumn("file_name", F.get_json_object("metadata", "$.file_name")), "file_name", 10)


def repair_route(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'convfinqa' and model_answer is not null").drop("id").withColumnRenamed("row_id", "id")
    return repair.route(q, max_repairs=50).groupBy("route").agg(F.count("*").alias("n"))


def _raw_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of one table-text source whose answers are programs; one in eleven has another gold answer, one in three none but that of its raw record."""
    x = _view(spark, d, "lineitem", PROGRAMS)
    gold = F.when(F.col("l_orderkey") % 11 == 0, F.lit("another")).otherwise(F.col("gold"))
    raw = F.to_json(F.struct(F.struct(F.struct(gold.alias("answer"), F.col("program")).alias("qa")).alias("raw_sample")))
    return x.select("l_orderkey", "l_linenumber", "kind", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.lit("finqa").alias("source"),
                    F.when(F.col("l_orderkey") % 3 == 0, F.lit("")).otherwise(gold).alias("reference_answer"), raw.alias("metadata"), F.col("program").alias("model_answer"))


def execution_eval(spark: SparkSession, d: str) -> DataFrame:
    return _key(execution.evaluated(_raw_records(spark, d)), gold=F.col("gold_answer"), program=F.col("gold_program"), correct=F.col("correct"), executable=F.col("executable"))


def execution_report(spark: SparkSession, d: str) -> DataFrame:
    return execution.report(execution.evaluated(_raw_records(spark, d)), ["kind"])


def gold_answers(spark: SparkSession, d: str) -> DataFrame:
    return execution.gold(_view(spark, d, "orders", GOLD)).select("o_orderkey", F.col("gold_answer").alias("gold"), F.col("gold_program").alias("program"))


def turn_benchmark(spark: SparkSession, d: str) -> DataFrame:
    m = C.benchmark_turn_match(_question(), F.lit("Amounts in dollars"), F.col(_P), F.col(_G))
    return _pairs(spark, d).groupBy("kind", m.alias("correct")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        isclose, strict_match, lenient_match, sign_error, mismatch_ladder, badcase_counts, multi_turn_match, benchmark_match, unit_scaled, percent_unit_error, rounding_error, examples_per_category, program_eval,
        program_flat, choice_index, rule_mcq, exam_judge, exam_letters, exam_badcases, table_badcases, instruction_judge, yesno_judge, sentiment_judge, sentiment_confusion, sentiment_badcases, judgment_rule,
        topk_subjects, repair_route, execution_report, execution_eval, gold_answers, turn_benchmark,
    )
}

_NP = f"with p as ({NUMERIC_PAIRS}), v as (select *, {PRED_NUM} as x, {GOLD_NUM} as y, prediction like '%\\%' escape '\\' as pct from p) "
_STRICT = f"(coalesce({close('x', 'y', '1e-4', '1e-4')}, false) or coalesce(pct and {close('x / 100.0e0', 'y', '1e-4', '1e-4')}, false) or (prediction <> '' and replace(prediction, '$', '') = gold))"
_LEN = f"({_STRICT} or coalesce({close('x', 'y', '0.01e0', '0.5e0')}, false) or coalesce(pct and {close('x / 100.0e0', 'y', '0.01e0', '0.5e0')}, false))"
_FLIP = f"coalesce(x * y < 0 and {close('abs(x)', 'abs(y)', '0.01e0', '0.5e0')}, false)"
_KIND = f"case when {_STRICT} then 'match' when prediction = 'cannot be determined' then 'abstain_error' when {_LEN} then 'rounding_or_format' when {_FLIP} then 'sign_error' when x is not null then 'calculation_error' else 'text_mismatch' end"
_CAT = "case k when 'abstain_error' then 'refusal_or_abstain' when 'rounding_or_format' then 'rounding_or_format' when 'sign_error' then 'sign_error' when 'calculation_error' then 'wrong_numeric' when 'text_mismatch' then 'other_text_mismatch' end"
_ABS_S = "regexp_matches(lower(coalesce(model_answer, '')), 'cannot determine|can''t determine|unable to determine|not enough information|insufficient information|unknown')"
_LABEL = lambda x: f"case when {label_text(x)} in ('negative', 'neutral', 'positive') then {label_text(x)} " + " ".join(f"when regexp_matches({label_text(x)}, '(?:^|[^\\p{{L}}\\p{{N}}_]){s}(?:$|[^\\p{{L}}\\p{{N}}_])') then '{s}'" for s in O.SENTIMENTS) + " else '' end"
_SQ = f"with s as (select *, {_LABEL('model_answer')} as a, {_LABEL('reference_answer')} as r, {_ABS_S} as shy, {strip('model_answer')} = '' as none from qa_samples where source = 'financial_phrasebank' and model_answer is not null) "
_PH = "negative|neutral|positive"
_WHY = f"""coalesce(nullif(regexp_extract(w, 'sentiment (?:is|should be|would be|therefore is|thus is) ({_PH})', 1), ''), nullif(regexp_extract(w, 'classif(?:y|ied) as ({_PH})', 1), ''),
  nullif(regexp_extract(w, 'label(?: is| should be)? ({_PH})', 1), ''), nullif(regexp_extract(w, 'overall(?: sentiment)?[: ]+({_PH})', 1), ''), '')"""
_YN = lambda x: f"regexp_extract({answer_text(x)}, '(?:^|[^\\p{{L}}\\p{{N}}_])(yes|no)(?:$|[^\\p{{L}}\\p{{N}}_])', 1)"
_BOOL = lambda x: f"case when {answer_text(x)} in ('yes', 'true', 'y', '1', 'correct', '是', '对', '正确') then 'yes' when {answer_text(x)} in ('no', 'false', 'n', '0', 'incorrect', '否', '错', '错误') then 'no' else '' end"

ORACLES = {
    "isclose": f"select l_orderkey, l_linenumber, {close('l_extendedprice', 'round(l_extendedprice, -1)', '1e-4', '1e-4')} as close, {close('l_quantity', 'l_quantity + l_discount', '0.01e0', '0.05e0')} as near from lineitem",
    "strict_match": _NP + f"select l_orderkey, l_linenumber, {_STRICT} as matched from v",
    "lenient_match": _NP + f"select l_orderkey, l_linenumber, {_LEN} as matched from v",
    "sign_error": _NP + f"select l_orderkey, l_linenumber, {_FLIP} as flipped from v",
    "mismatch_ladder": _NP + f"select kind, {_KIND} as category, count(*) as n from v group by all",
    "badcase_counts": _NP + f", c as (select {_CAT} as category, count(*) as n from (select {_KIND} as k from v) group by all) select category, n, n::double / (select sum(n) from c) as rate from c where category is not null",
    "benchmark_match": _NP
    + f"""select kind, correct, count(*) as n from (select kind, case when kind = 4 then coalesce({close('x', 'y', '0.01e0', '0.051e0')} or {close('x / 100.0e0', 'y', '0.01e0', '0.051e0')}, false)
          else coalesce({close('x', 'y', '1e-4', '1e-4')}, false) end as correct from v) group by all""",
    "percent_unit_error": _NP + "select kind, pct as unit_error, count(*) as n from v group by all",
    "examples_per_category": _NP
    + f"""select category, rank, l_orderkey, l_linenumber, gold from (select {_CAT} as category, l_orderkey, l_linenumber, gold, row_number() over (partition by {_CAT} order by l_orderkey, l_linenumber, gold)::int as rank
          from (select *, {_KIND} as k from v)) where category is not null and rank <= 8""",
    "program_eval": f"select l_orderkey, l_linenumber, expected as num, expected_txt as txt, runs as executable from ({PROGRAMS})",
    "program_flat": f"select l_orderkey, l_linenumber, case when kind = 0 then expected end as num, true as is_program from ({PROGRAMS})",
    "execution_eval": f"""select l_orderkey, l_linenumber, case when l_orderkey % 11 = 0 then 'another' else gold end as gold, program, runs and l_orderkey % 11 <> 0 as correct, runs as executable from ({PROGRAMS})""",
    "execution_report": f"select kind, count(*) as n, avg((runs and l_orderkey % 11 <> 0)::int::double) as accuracy, avg(runs::int::double) as executable_rate from ({PROGRAMS}) group by kind",
    "gold_answers": f"""select o_orderkey, case kind when 0 then reference_answer when 1 then json_extract_string(metadata, '$.raw_sample.qa.exe_ans') when 2 then json_extract_string(metadata, '$.raw_sample.qa_1.answer')
        when 3 then json_extract_string(metadata, '$.raw_sample.qa_10.exe_ans') else '' end as gold,
        case kind when 0 then json_extract_string(metadata, '$.raw_sample.qa.program_re') when 1 then 'add(3, 4)' when 2 then 'exp(2, 3)' else '' end as program from ({GOLD})""",
    "choice_index": f"select p_partkey, selects::int as chosen, (ascii(reference_answer) - 65)::int as right from ({MCQ})",
    "rule_mcq": f"""select p_partkey, (selects = ascii(reference_answer) - 65)::int as score, case when selects is null then 'rule_mcq_unresolved' else 'rule_mcq' end as method from ({MCQ})""",
    "yesno_judge": f"""select row_id, case when asks and x <> '' and y <> '' then (x = y)::int when item and a <> '' and r <> '' then (a = r)::int end::int as score, x as said from (
        select row_id, {_YN('model_answer')} as x, {_YN('reference_answer')} as y, {answer_text('model_answer')} as a, {answer_text('reference_answer')} as r,
          {_YN('reference_answer')} <> '' or regexp_matches({answer_text('question')}, '^(?:is|are|do|does|did|can|should|will|was|were|could) ') as asks,
          contains({answer_text('question')}, 'multiple choice') or regexp_matches(lower(coalesce(reference_answer, '')), '(?m)^a\\.') as item
        from qa_samples where source in ('convfinqa', 'finance_alpaca') and model_answer is not null)""",
    "sentiment_judge": _SQ
    + """select row_id, score, case when score = 1 then 'none' when score is null then null when none then 'format_error' when shy then 'abstain_error' else 'label_error' end as mismatch_type from (
          select *, case when none or shy then 0 when a <> '' and r <> '' then (a = r)::int end::int as score from s)""",
    "sentiment_confusion": _SQ
    + """select r as gold, count(*) filter (a = 'negative') as negative, count(*) filter (a = 'neutral') as neutral, count(*) filter (a = 'positive') as positive,
          count(*) filter (a not in ('negative', 'neutral', 'positive')) as other from s group by r""",
    "sentiment_badcases": _SQ
    + f""", c as (select category, count(*) as n from (select case when none then 'parse_error' when shy then 'abstain_error' when a = '' then 'label_format_error' when why <> '' and why <> a then 'reasoning_answer_inconsistent'
          when a = ref then 'correct' when a in ('negative', 'positive') and ref in ('negative', 'positive') then 'polarity_flip' when a = 'neutral' or ref = 'neutral' then 'neutral_polarity_confusion' else 'wrong_label_selection' end as category
          from (select *, {_WHY} as why, lower({strip('reference_answer')}) as ref from (select *, {label_text('model_reasoning')} as w from s))) group by all) select category, n, n::double / (select sum(n) from c) as rate from c""",
    "judgment_rule": f"""select score, case when not judged then 'rule_not_applicable' when score is null then 'rule_judgment_unresolved' else 'rule_judgment' end as method, count(*) as n from (
        select judged, case when judged and x <> '' and y <> '' then (x = y)::int end::int as score from (select {_BOOL('model_answer')} as x, {_BOOL('reference_answer')} as y,
          regexp_matches(lower(coalesce(question, '')), 'true or false|yes or no|是否|判断') or {_BOOL('reference_answer')} <> '' as judged from qa_samples where source <> 'financeiq' and model_answer is not null)) group by all""",
    "topk_subjects": f"select value, n from (select coalesce(nullif({strip(chr(109) + 'etadata->>' + chr(39) + '$.file_name' + chr(39))}, ''), 'unknown') as value, count(*) as n from qa_samples group by all) order by n desc, value limit 10",
}
_EXAM = lambda x: f"regexp_replace(translate({strip(x)}, '　（）：，。', ' ():,.'), '{WS}+', '', 'g')"
_BARE = lambda x: f"regexp_replace({x}, '^[A-Da-d][.):：、 \t\n\r\f\x0B]*', '')"
_OPTS = f"""list_transform(list_filter(coalesce(options, []), lambda o: regexp_matches({strip('o')}, '(?i)^[A-D][.):：、 \t\n\r\f\x0B]')),
    lambda o: struct_pack(k := upper(substr({strip('o')}, 1, 1)), v := {_BARE(_EXAM(f"regexp_replace({strip('o')}, '^[A-Da-d][.):：、 {chr(92)}t{chr(92)}n{chr(92)}r{chr(92)}f{chr(92)}x0B]+', '')"))}))"""


def _letter(x: str) -> str:
    t = f"upper({_EXAM(x)})"
    lead, plain = f"regexp_extract({t}, '^(?:答案|选项|故选|应选|选择|最终答案)[是为: ]*([A-D])', 1)", f"regexp_extract({t}, '^(?:选|选项)?([A-D])(?:选项)?$', 1)"
    only = lambda test: f"case when len(list_filter(entries, lambda e: {test})) = 1 then list_filter(entries, lambda e: {test})[1].k end"
    norm = _BARE(_EXAM(x))
    held = f"e.v <> '' and contains({norm}, e.v)"
    return f"case when {t} = '' then '' when {lead} <> '' then {lead} when {plain} <> '' then {plain} else coalesce({only(f'e.v = {norm}')}, {only(held)}, '') end"


def _said(x: str) -> str:
    quoted = lambda words: ", ".join(f"'{w}'" for w in words)
    t = _EXAM(x)
    return f"case when {t} in ({quoted(O.EXAM_TRUE)}) or regexp_matches({t}, '^(?:判断|答案)为正确') then 'true' when {t} in ({quoted(O.EXAM_FALSE)}) or regexp_matches({t}, '^(?:判断|答案)为错误') then 'false' else '' end"


_ANY = lambda x, words: "(" + " or ".join(f"contains({x}, '{w}')" for w in words) + ")"
_EXAM_ROWS = f"(select *, {_OPTS} as entries from qa_samples where source = 'financeiq')"
ORACLES["exam_letters"] = f"select row_id, {_letter('model_answer')} as letter from {_EXAM_ROWS}"
ORACLES["exam_judge"] = f"""
  with f as (select {_letter('model_answer')} as a, {_letter('reference_answer')} as r, {_said('model_answer')} as x, {_said('reference_answer')} as y, {strip('model_answer')} = '' as empty, {strip('reference_answer')} = '' as none,
      {_ANY(_EXAM('model_answer'), T.ABSTAIN_EXAM)} or {_ANY(strip('model_answer'), T.ABSTAIN_EXAM)} as shy from {_EXAM_ROWS} where model_answer is not null),
  s as (select *, case when none then null when empty or shy then 0 when r <> '' then case when a <> '' then (a = r)::int end when y <> '' then case when x <> '' then (x = y)::int end end::int as score from f)
  select score, case when score is null then null when score = 1 then 'none' when empty then 'format_error' when shy then 'abstain_error' when r <> '' then 'option_error' else 'judgment_error' end as mismatch_type, count(*) as n from s group by all"""
_OPTION = lambda o: strip(f"regexp_replace({strip(o)}, '(?i)^[A-G][ {chr(92)}t{chr(92)}n{chr(92)}r{chr(92)}f{chr(92)}x0B]*[.)．、:：-]?[ {chr(92)}t{chr(92)}n{chr(92)}r{chr(92)}f{chr(92)}x0B]*', '')")
_ST = strip("model_answer")
_CHOSE = lambda words: f"list_last(regexp_extract_all(coalesce(model_reasoning, ''), '(?i)(?:{words})[ {chr(92)}t{chr(92)}n{chr(92)}r{chr(92)}f{chr(92)}x0B]*[:：]?[ {chr(92)}t{chr(92)}n{chr(92)}r{chr(92)}f{chr(92)}x0B]*([A-D])(?:$|[^{chr(92)}p{{L}}{chr(92)}p{{N}}_])', 1))"
_WHY_OPTS = "list_filter(list_transform(bare, lambda o, i: case when length(o) >= 2 and contains(coalesce(model_reasoning, ''), o) then chr((64 + i)::int) end), lambda x: x is not null)"
ORACLES["exam_badcases"] = f"""
  with o as (select *, list_transform(coalesce(options, []), lambda o: {strip('o')}) as plain, list_transform(coalesce(options, []), lambda o: {_OPTION('o')}) as bare, {_ST} as t from qa_samples where source = 'financeiq'),
  f as (select *, upper(t) in ('A', 'B', 'C', 'D') as exact, upper(regexp_extract(t, '(?s)^([A-Da-d])[ \t\n\r\f\x0B]*[.)．、:：-]?[ \t\n\r\f\x0B]*.+$', 1)) as lead, greatest(coalesce(list_position(plain, t), 0), coalesce(list_position(bare, t), 0)) as place,
      coalesce({', '.join(_CHOSE(w) for w in O.REASONED_LEADS)}) as said, {_WHY_OPTS} as held from o),
  g as (select *, case when exact then upper(t) when lead <> '' then lead when place > 0 then chr((64 + place)::int) else '' end as letter, case when said is not null then upper(said) when len(held) = 1 then held[1] else '' end as why from f),
  c as (select case when model_answer is null then 'parse_error' when {_ANY('lower(t)', T.ABSTAIN_EXAM_ANALYSIS)} then 'abstain_error' when letter = '' and t <> '' then 'answer_text_mismatch' when letter = '' then 'unknown'
      when letter = upper({strip('reference_answer')}) and not exact then 'option_format_error' when why <> '' and why <> letter then 'reasoning_answer_inconsistent'
      when letter <> upper({strip('reference_answer')}) and exact then 'wrong_option_selection' when letter <> upper({strip('reference_answer')}) then 'answer_text_mismatch' end as category from g)
  select category, count(*) as n, count(*)::double / (select count(*) from c) as rate from c where category is not null group by category"""
_TURN_LEN = f"(coalesce({close('x', 'y', '0.01e0', '0.005e0')}, false) or coalesce(kind = 4 and ({close('x', 'y', '0.01e0', '0.5e0')} or {close('x / 100.0e0', 'y', '0.01e0', '0.5e0')}), false))"
ORACLES["multi_turn_match"] = (
    _NP
    + f"""select kind, strict, lenient, case when strict then 'match' when prediction = 'cannot be determined' then 'abstain_error' when lenient then 'rounding_or_format' when {_FLIP} then 'sign_error'
        when x is not null then 'calculation_error' else 'text_mismatch' end as mismatch, count(*) as n
      from (select *, strict or {_TURN_LEN} as lenient from (select *, prediction <> '' and replace(prediction, '$', '') = gold as strict from v)) group by all"""
)
ORACLES["turn_benchmark"] = (
    _NP
    + f"""select kind, strict or (lenient and prediction <> 'cannot be determined') or near as correct, count(*) as n
      from (select *, strict or {_TURN_LEN} as lenient, coalesce({close('x', 'y', '0.01e0', '0.51e0')} or (pct and {close('x / 100.0e0', 'y', '0.01e0', '0.51e0')}), false) as near
        from (select *, prediction <> '' and replace(prediction, '$', '') = gold as strict from v)) group by all"""
)
ORACLES["unit_scaled"] = (
    _NP
    + f"""select kind, case when kind = 7 then {close('floor(y) * 1e6', 'y * 1e6', '0.01e0', '0.51e0')} or {close('floor(y) * 1e6', 'y', '0.01e0', '0.51e0')}
        else coalesce({close('x', 'y', '0.01e0', '0.51e0')} or (pct and {close('x / 100.0e0', 'y', '0.01e0', '0.51e0')}), false) end as correct, count(*) as n from v group by all"""
)
_COMPACT = lambda c: f"regexp_replace(lower({c}), '[ |,.$()%:;-]', '', 'g')"
ORACLES["rounding_error"] = (
    _NP
    + f"""select kind, prediction <> '' and (coalesce({close('x', 'y', '0.02e0', '1.0e0')} or (pct and {close('x / 100.0e0', 'y', '0.02e0', '1.0e0')}), false) or {_COMPACT('prediction')} = {_COMPACT('gold')}) as rounding,
        count(*) as n from v group by all"""
)
_EDGES = "。；;，,：:、!！?？"


def _span(x: str) -> str:
    bare = f"regexp_replace(coalesce({x}, ''), '{WS}+', '', 'g')"
    out = f"""trim(replace(replace(replace({bare}, '“', ''), '”', ''), '"', ''), '{_EDGES}')"""
    for lead in T.SHORT_ANSWER_LEADS:
        out = f"regexp_replace({out}, '^(?:{lead})', '')"
    return f"trim({out}, '{_EDGES}')"


def _held(x: str, table) -> str:
    return "case " + " ".join(f"when contains({x}, '{k}') then '{v}'" for k, v in table) + f" else {x} end"


_SHY = lambda x: "(" + " or ".join(f"contains({x}, '{p}')" for p in T.ABSTAIN_INSTRUCTION) + ")"
ORACLES["instruction_judge"] = f"""
  with s as (select metadata->>'$.file_name' as task, coalesce(question, '') as q, {strip('model_answer')} as ra, {strip('reference_answer')} as rr, {_span('model_answer')} as a, {_span('reference_answer')} as r
      from qa_samples where source = 'fincuge_instruction' and model_answer is not null),
  j as (select *, coalesce(task, '') as t, ra = '' or rr = '' as none, {_SHY('a')} as sa, {_SHY('r')} as sr from s),
  k as (select *, case when t = 'FINNA' or regexp_matches(q, '生成标题|摘要|简述|总结') or length(rr) > 64 then null when none then 0
      when t = 'FINFE' then (({_held('a', O.SENTIMENT_ZH)}) = ({_held('r', O.SENTIMENT_ZH)}))::int
      when t = 'FINNL' then (({_held('a', [(c, c) for c in O.CATEGORIES_ZH])}) = ({_held('r', [(c, c) for c in O.CATEGORIES_ZH])}))::int
      when sa or sr then (sa and sr)::int else (a <> '' and r <> '' and (contains(a, r) or contains(r, a)))::int end as score from j)
  select task, score::int as score, case when score is null then null when score = 1 then 'none' when none then 'incompleteness' when t = 'FINFE' then 'sentiment_error' when t = 'FINNL' then 'category_error'
      when sa or sr then 'abstain_error' when t = 'FINRE' then 'relation_error' when t = 'FINCQA' then 'event_error' when t in ('FINQA', 'FINESE') then 'entity_error' else 'label_error' end as mismatch_type, count(*) as n
  from k group by all"""

#: All rows with an answer and the verdict of the rules of their kind of data (rule_score).
RULED = f"""
  (select * exclude (e, s0, s1, s2, y, i), case lower({strip('task_type')}) when 'mcq' then e when 'sentiment' then s0 when 'instruction' then case when source like '%alpaca%' then y else i end end as rule_score from (
    select *,
      case when er0 = '' then null when ea0 = '' or eshy then 0 when er <> '' then case when ea <> '' then (ea = er)::int end when ey <> '' then case when ex <> '' then (ex = ey)::int end end::int as e,
      case when {strip('model_answer')} = '' or {_ABS_S} then 0 when la <> '' and lr <> '' then (la = lr)::int end::int as s0, null as s1, null as s2,
      case when asks and yx <> '' and yy <> '' then (yx = yy)::int when item and ya <> '' and yr <> '' then (ya = yr)::int end::int as y,
      case when tk = 'FINNA' or regexp_matches(coalesce(question, ''), '生成标题|摘要|简述|总结') or length(er0) > 64 then null when ea0 = '' or er0 = '' then 0
        when tk = 'FINFE' then (({_held('ia', O.SENTIMENT_ZH)}) = ({_held('ir', O.SENTIMENT_ZH)}))::int when tk = 'FINNL' then (({_held('ia', [(c, c) for c in O.CATEGORIES_ZH])}) = ({_held('ir', [(c, c) for c in O.CATEGORIES_ZH])}))::int
        when {_SHY('ia')} or {_SHY('ir')} then ({_SHY('ia')} and {_SHY('ir')})::int else (ia <> '' and ir <> '' and (contains(ia, ir) or contains(ir, ia)))::int end::int as i
    from (select *, {strip('model_answer')} as ea0, {strip('reference_answer')} as er0, {_letter('model_answer')} as ea, {_letter('reference_answer')} as er, {_said('model_answer')} as ex, {_said('reference_answer')} as ey,
        {_ANY(_EXAM('model_answer'), T.ABSTAIN_EXAM)} or {_ANY(strip('model_answer'), T.ABSTAIN_EXAM)} as eshy, {_LABEL('model_answer')} as la, {_LABEL('reference_answer')} as lr,
        {_YN('model_answer')} as yx, {_YN('reference_answer')} as yy, {answer_text('model_answer')} as ya, {answer_text('reference_answer')} as yr,
        {_YN('reference_answer')} <> '' or regexp_matches({answer_text('question')}, '^(?:is|are|do|does|did|can|should|will|was|were|could) ') as asks,
        contains({answer_text('question')}, 'multiple choice') or regexp_matches(lower(coalesce(reference_answer, '')), '(?m)^a\\.') as item,
        {_span('model_answer')} as ia, {_span('reference_answer')} as ir, coalesce(metadata->>'$.file_name', '') as tk
      from (select *, {_OPTS} as entries from qa_samples where model_answer is not null))))"""
