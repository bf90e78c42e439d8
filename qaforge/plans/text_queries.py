"""Text functions, prompts, replies and export over qa_samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import options as O
from ..functions import text as T
from ..operators import jobs, prompts, repair, reply, sft
from ..session import table
from .sqlbits import REPLIES, WS, answer_text, label_text, squash, strip


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_samples")


def normalise_text(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).select("row_id", F.md5(T.answer_text(F.col("context"))).alias("context_md5"), T.label_text(F.col("question")).alias("question"))


def exam_text(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).where("source = 'financeiq'").select("row_id", T.exam_text(F.col("question")).alias("question"))


def short_answers(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'fincuge_instruction'")
    return q.select("row_id", T.short_answer(F.concat(F.lit("答案是“"), F.coalesce("reference_answer", F.lit("")), F.lit("”。"))).alias("answer"), T.abstains(F.col("model_answer"), "instruction").alias("abstains"))


def truncate_text(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).select("row_id", T.clip(F.col("context"), 200).alias("context"))


def join_sections(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).select("row_id", F.md5(T.sections(F.col("question"), F.col("context"), F.col("reference_answer"))).alias("text_md5"))


def table_text(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.array(F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")))).alias("rows"))
    return rows.select("l_orderkey", T.table_text(F.col("rows")).alias("text"))


def mcq_options(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).where("size(options) > 0").select("row_id", O.relabelled(F.col("options")).alias("options"))


def lettered_options(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    cells = T.lettered_options(F.col("p_brand"), F.when(F.col("p_size") % 3 > 0, F.col("p_type")), F.lit(" "), F.col("p_name"))
    return p.select("p_partkey", F.array_join(cells, "\n").alias("options"))


def number_tokens(spark: SparkSession, d: str) -> DataFrame:
    nums = N.bracketed_numbers(F.col("context"))
    return _qa(spark, d).select("row_id", F.size(nums).alias("n"), F.array_max(nums).alias("largest"), F.array_min(nums).alias("smallest"))


def unit_words(spark: SparkSession, d: str) -> DataFrame:
    u = T.unit_markers(F.col("context"))
    return _qa(spark, d).select("row_id", F.array_join(u, ",").alias("units"), T.has_percent(F.col("context")).alias("percent"))


def question_kinds(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("question")
    return _qa(spark, d).groupBy("source", N.expects_percent(q).alias("percent"), N.wants_number(q).alias("number"), N.is_yes_no_question(q).alias("yes_no")).agg(F.count("*").alias("n"))


def conclusions(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).where("model_reasoning is not null").select("row_id", T.conclusion(F.col("model_reasoning")).alias("conclusion"))


def turn_history(spark: SparkSession, d: str) -> DataFrame:
    t = _qa(spark, d).where("source = 'convfinqa' and origin_key is not null").select("row_id", "origin_key", "question", "reference_answer")
    return repair.history(t, "origin_key", "row_id", "question", "reference_answer").select("row_id", "origin_key", "history")


def sft_messages(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("model_answer is not null and model_reasoning is not null").select("*", F.col("row_id").cast("string").alias("_k"))
    m = sft.export(q.drop("id").withColumnRenamed("_k", "id"))
    return m.select(F.col("id").cast("bigint").alias("row_id"), F.array_join(F.transform("messages", lambda x: x["role"]), ",").alias("roles"), F.md5(F.col("messages")[1]["content"]).alias("user_md5"), F.md5(F.col("messages")[2]["content"]).alias("assistant_md5"))


def prompt_render(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d)
    name = prompts.route(prompts.RULES, {"source": F.col("source"), "task_type": F.col("task_type")}, "instruction")
    slots = jobs.slots(q)
    df = prompts.render_routed(q.withColumn("template", name), "template", prompts.TEMPLATES, slots)
    return df.select("row_id", "template", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("characters"))


def _replies(spark: SparkSession, d: str) -> DataFrame:
    _qa(spark, d).createOrReplaceTempView("_reply_samples")
    return spark.sql(REPLIES.replace("qa_samples", "_reply_samples"))


def reply_extract(spark: SparkSession, d: str) -> DataFrame:
    e = reply.extract(F.col("reply"))
    return _replies(spark, d).select("row_id", e["method"].alias("method"), e["final_answer"].alias("answer"), e["reasoning"].alias("reasoning"))


def reply_parse(spark: SparkSession, d: str) -> DataFrame:
    r = _replies(spark, d).select("row_id", "reply", F.lit("reasoning").alias("task_type"), F.lit("How many units?").alias("question"), F.array().cast("array<string>").alias("options"))
    return reply.parse(r).select("row_id", F.col("parsed.status").alias("status"), F.col("parsed.final_answer").alias("answer"))


def metadata_note(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).select("row_id", prompts.metadata_note(F.col("metadata"), ("file_name", "raw_split")).alias("note"))


QUERIES = {
    f.__name__: f
    for f in (
        normalise_text, exam_text, short_answers, truncate_text, join_sections, table_text, mcq_options, lettered_options, number_tokens, unit_words, question_kinds, conclusions, turn_history,
        sft_messages, prompt_render, reply_extract, reply_parse, metadata_note,
    )
}


def _clip(x: str, n: int) -> str:
    return f"case when length({strip(x)}) <= {n} then {strip(x)} else concat(substr({strip(x)}, 1, {n - 15}), chr(10), '[TRUNCATED]') end"


def _word(x: str, words: str) -> str:
    return f"regexp_matches({x}, '(?:^|[^\\p{{L}}\\p{{N}}_])(?:{words})(?:$|[^\\p{{L}}\\p{{N}}_])')"


_EDGE = "。；;，,：:、!！?？"
def _short(x: str) -> str:
    bare = f"regexp_replace({x}, '{WS}+', '', 'g')"
    return f"""trim(replace(replace(replace({bare}, '“', ''), '”', ''), '"', ''), '{_EDGE}')"""


_ABSTAIN = ["不能发现具体信息", "无法确定", "无法判断", "未提及", "没有提及", "没有具体信息", "无法从文中", "无法从材料"]
_OPT = f"""array_to_string(list_transform(options, lambda o, i: concat(chr((64 + i)::int), '. ', regexp_replace({strip('o')}, concat('^(?:', chr((64 + i)::int), '[.．、)]{WS}*)+'), ''))), chr(10))"""
_ASK = "concat(chr(10), chr(10), 'Return exactly this format:', chr(10), '<reasoning>', chr(10), '...', chr(10), '</reasoning>', chr(10), '<final_answer>', chr(10), '{}', chr(10), '</final_answer>')"
_PART = lambda title, body: f"case when {body} <> '' then concat(chr(10), chr(10), '{title}:', chr(10), {body}) else '' end"
_Q, _C = strip("question"), strip("context")
_LEAD = lambda title: f"concat(chr(10), chr(10), '{title}:', chr(10), {_Q})"
_KIND = "lower(coalesce(task_type, ''))"
_USER = f"""case when {_KIND} = 'mcq' then concat('Task: Choose the single best option.', {_LEAD('Question')}, {_PART('Options', 'opts')}, {_PART('Context', _C)}, {_ASK.format('A single option letter')})
  when {_KIND} = 'sentiment' then concat('Task: Classify the sentiment of the financial text.', {_PART('Instruction', _Q)}, {_PART('Text', _C)}, {_PART('Allowed labels', 'opts')}, {_ASK.format('One label only')})
  when {_KIND} = 'reasoning' then concat('Task: Solve the financial reasoning problem.', {_LEAD('Question')}, {_PART('Context', _C)}, {_ASK.format('The final answer only')})
  else concat('Task: Follow the instruction.', {_LEAD('Instruction')}, {_PART('Additional context', _C)}, {_PART('Options', 'opts')}, {_ASK.format('The final answer only')}) end"""
_NUMS = r"""list_transform(regexp_extract_all(coalesce(context, ''), '(\(?[-+]?\$?[0-9][0-9,]*(?:\.[0-9]+)?%?\)?)', 1), lambda t:
  struct_pack(neg := t like '(%)', pct := ends_with(translate(t, '()', ''), '%'), v := cast(translate(t, '()$,%', '') as double)))"""
_VALS = f"flatten(list_transform({_NUMS}, lambda s: case when s.neg and s.pct then [-abs(s.v), -abs(s.v / 100.0e0)] when s.neg then [-abs(s.v)] when s.pct then [s.v, s.v / 100.0e0] else [s.v] end))"
_FILL = {
    "question": f"coalesce(nullif({_clip('question', 4000)}, ''), 'N/A')", "context": f"coalesce(nullif({_clip('context', 24000)}, ''), 'N/A')",
    "options": f"coalesce(nullif({_clip('opts', 4000)}, ''), 'N/A')", "history": "'N/A'",
    **{k: f"coalesce(nullif({_clip(c, 4000)}, ''), 'N/A')" for k, c in (("reference", "reference_answer"), ("answer", "model_answer"), ("reasoning", "model_reasoning"))},
}


def rendered(template: str) -> str:
    """SQL that fills a template from qa_samples with opts, the option text of SOURCE_ROWS."""
    out = []
    for is_slot, s in prompts.pieces(template):
        out.append(_FILL[s] if is_slot else "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'")
    return "(" + " || ".join(out) + ")"


_TEMPLATE = f"case when lower({strip('source')}) = 'convfinqa' then 'dialogue' when lower({strip('task_type')}) = 'mcq' then 'mcq' when lower({strip('task_type')}) = 'sentiment' then 'sentiment' when lower({strip('task_type')}) = 'reasoning' then 'reasoning' else 'instruction' end"
#: qa_samples with the option text and template name of each row.
SOURCE_ROWS = f"(select *, {_OPT} as opts, {_TEMPLATE} as template from qa_samples)"
PROMPT = "case template " + " ".join(f"when '{k}' then {rendered(v)}" for k, v in prompts.TEMPLATES.items()) + " end"

ORACLES = {
    "normalise_text": f"select row_id, md5({answer_text('context')}) as context_md5, {label_text('question')} as question from qa_samples",
    "exam_text": f"select row_id, regexp_replace(translate({strip('question')}, '　（）：，。', ' ():,.'), '{WS}+', '', 'g') as question from qa_samples where source = 'financeiq'",
    "short_answers": f"""select row_id, trim(regexp_replace({_short("concat('答案是“', coalesce(reference_answer, ''), '”。')")}, '^(?:和.+?相关的主体是|相关主体是|主体是|答案是)', ''), '{_EDGE}') as answer,
        {' or '.join(f"contains(regexp_replace(coalesce(model_answer, ''), '{WS}+', '', 'g'), '{a}')" for a in _ABSTAIN)} as abstains from qa_samples where source = 'fincuge_instruction'""",
    "truncate_text": f"select row_id, {_clip('context', 200)} as context from qa_samples",
    "join_sections": f"select row_id, md5(array_to_string(list_filter([{_Q}, {_C}, {strip('reference_answer')}], lambda x: x <> ''), chr(10) || chr(10))) as text_md5 from qa_samples",
    "table_text": """select l_orderkey, string_agg(concat(a, ' | ', b, ' | ', c), chr(10) order by a, b, c) as text from (
        select l_orderkey, lpad(cast(l_linenumber as varchar), 3, '0') as a, lpad(cast(l_partkey as varchar), 9, '0') as b, lpad(cast(l_suppkey as varchar), 9, '0') as c from lineitem) group by l_orderkey""",
    "mcq_options": f"select row_id, {_OPT} as options from qa_samples where len(options) > 0",
    "lettered_options": "select p_partkey, concat('A. ', trim(p_brand), case when p_size % 3 > 0 then concat(chr(10), 'B. ', trim(p_type)) else '' end, chr(10), 'D. ', trim(p_name)) as options from part",
    "number_tokens": f"select row_id, len(v)::int as n, list_max(v) as largest, list_min(v) as smallest from (select row_id, {_VALS} as v from qa_samples)",
    "unit_words": f"""select row_id, array_to_string(list_filter([case when {_word('t', 'billion|bn')} then 'billion' end, case when {_word('t', 'million|mn|mm')} then 'million' end,
        case when {_word('t', 'thousand|k')} then 'thousand' end], lambda x: x is not null), ',') as units, contains(l, '%') or contains(l, 'percent') as percent
        from (select row_id, {answer_text('context')} as t, lower(coalesce(context, '')) as l from qa_samples)""",
    "question_kinds": f"""select source, regexp_matches(q, 'percent|proportion|portion|rate|margin') as percent,
        {_word('q', 'how much|how many|what (?:is|was|were|are)|total|amount|value|expense|revenue|price|rate|percent')} as number,
        {_word('q', 'is|are|was|were|do|does|did|can|could|should|would|will|has|have|had')} as yes_no, count(*) as n from (select source, lower(coalesce(question, '')) as q from qa_samples) group by all""",
    "conclusions": f"""select row_id, coalesce({strip("list_last(m)").replace("coalesce(list_last(m), '')", 'list_last(m)')}, list_last(l), '') as conclusion from (
        select row_id, regexp_extract_all(model_reasoning, '(?im)^conclusion[\\t \\x0B\\f]*:{WS}*(.+)$', 1) as m,
          list_filter(list_transform(regexp_split_to_array(model_reasoning, '\\r\\n|\\r|\\n'), lambda x: {strip('x')}), lambda x: x <> '') as l from qa_samples where model_reasoning is not null)""",
    "turn_history": f"""select row_id, origin_key, coalesce(string_agg(nullif(line, ''), chr(10)) over (partition by origin_key order by row_id rows between unbounded preceding and 1 preceding), '') as history from (
        select row_id, origin_key, array_to_string(list_filter([case when {_Q} <> '' then concat('User: ', {_Q}) end, case when {strip('reference_answer')} <> '' then concat('Assistant: ', {strip('reference_answer')}) end],
          lambda x: x is not null), chr(10)) as line from qa_samples where source = 'convfinqa' and origin_key is not null)""",
    "sft_messages": f"""select row_id, 'system,user,assistant' as roles, md5({_USER}) as user_md5, md5(concat('<reasoning>', chr(10), {strip('model_reasoning')}, chr(10), '</reasoning>', chr(10), '<final_answer>', chr(10),
        {strip('model_answer')}, chr(10), '</final_answer>')) as assistant_md5 from (select *, {_OPT} as opts from qa_samples where model_answer is not null and model_reasoning is not null)""",
    "prompt_render": f"select row_id, template, md5(p) as prompt_md5, length(p)::int as characters from (select row_id, template, {PROMPT} as p from {SOURCE_ROWS})",
    "reply_extract": f"""with r as ({REPLIES}) select row_id, case row_id % 5 when 0 then 'xml_tags' when 2 then 'final_answer_marker' when 3 then 'last_line_fallback' else 'json' end as method,
        cast(row_id * 2 as varchar) as answer, concat('step ', cast(row_id as varchar)) as reasoning from r""",
    "reply_parse": f"""with r as ({REPLIES}) select row_id, 'success' as status, cast(row_id * 2 as varchar) as answer from r""",
    "metadata_note": f"""select row_id, array_to_string(list_filter([case when {strip("metadata->>'$.file_name'")} <> '' then concat('file_name: ', {strip("metadata->>'$.file_name'")}) end,
        case when {strip("metadata->>'$.raw_split'")} <> '' then concat('raw_split: ', {strip("metadata->>'$.raw_split'")}) end], lambda x: x is not null), chr(10)) as note from qa_samples""",
}
