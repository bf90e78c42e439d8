"""Verdict joins, summaries, sampling, manifests, provider calls and resume plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import filtering, jobs, judges, manifest, merge, provider, reply, splits
from ..session import table
from . import text_queries
from .answer_queries import RULED
from .sqlbits import canonical

#: Weights of domains and of sources within them, as a user would configure them.
DOMAIN_WEIGHTS = {"financial_reasoning": 0.40, "financial_instruction": 0.30, "financial_knowledge": 0.25, "market_sentiment": 0.05}
SOURCE_WEIGHTS = {
    "financial_reasoning": {"finqa": 0.30, "convfinqa": 0.30, "tatqa": 0.40}, "financial_instruction": {"fincuge_instruction": 0.55, "finance_alpaca": 0.45},
    "financial_knowledge": {"financeiq": 1.0}, "market_sentiment": {"financial_phrasebank": 1.0},
}


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_samples")


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "judged_rows")


def keep_drop_join(spark: SparkSession, d: str) -> DataFrame:
    last = _judged(spark, d).withColumn("score", F.coalesce("judge.score", F.lit(-1)))
    return filtering.with_verdict(_qa(spark, d).select("row_id", "id"), last, order=["judged_at", "judge_latency_ms", "score"]).select("row_id", "id", "bucket")


def score_summary(spark: SparkSession, d: str) -> DataFrame:
    return filtering.summary(_judged(spark, d), ["source"])


def mismatch_counts(spark: SparkSession, d: str) -> DataFrame:
    return filtering.mismatch_counts(_judged(spark, d), ["source"])


def soft_keep(spark: SparkSession, d: str) -> DataFrame:
    j = _judged(spark, d)
    return j.groupBy("source", filtering.keep_soft(F.col("judge.judgment") == "correct", F.col("judge.mismatch_type")).alias("bucket")).agg(F.count("*").alias("n"))


def two_stage_filter(spark: SparkSession, d: str) -> DataFrame:
    """Both stages over the sources that no rule settles: the second judge is asked about rows that the first kept."""
    q = _qa(spark, d).where("source in ('finqa', 'tatqa') and model_answer is not null").withColumn("task_type", F.lit("reasoning"))
    b = jobs.two_stages(q, provider.MockProvider(), provider.MockProvider(fail_every=9, broken_every=8), "row_id")
    per = b.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    return per.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy("source")))  # a row per source and bucket


def _judged_samples(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).where("model_answer is not null")


def reasoning_scores(spark: SparkSession, d: str) -> DataFrame:
    s = jobs.scored_reasoning(_judged_samples(spark, d), provider.MockProvider(), "row_id")
    return s.select("row_id", "score_success", F.col("score.score").alias("score"), F.col("score.domain_relevance").alias("relevance"), (F.col("score_error") == "").alias("clean"), "score_latency_ms", "bucket")


def lenient_verdicts(spark: SparkSession, d: str) -> DataFrame:
    s = jobs.leniently_judged(_judged_samples(spark, d), provider.MockProvider(), "row_id")
    return s.select("row_id", "judge_success", F.col("lenient.is_consistent").alias("consistent"), "bucket")


def model_verdicts(spark: SparkSession, d: str) -> DataFrame:
    s = jobs.judged_by_model(_judged_samples(spark, d), provider.MockProvider(), "answer", "row_id")
    return s.select("row_id", "judge_success", F.col("judge.score").alias("score"), F.col("judge.mismatch_type").alias("mismatch_type"), "judge_latency_ms")


def answer_scores(spark: SparkSession, d: str) -> DataFrame:
    """Rules first, then the model, for every source: who scored and what came of it."""
    s = jobs.scored_answers(_judged_samples(spark, d), provider.MockProvider(), "row_id")
    return s.groupBy("source", F.coalesce("judge.scoring_mode", F.lit("failed")).alias("mode"), "bucket").agg(F.count("*").alias("n"))


def distilled(spark: SparkSession, d: str) -> DataFrame:
    """A distil job that resumes: finished rows are reused, filled ones and other splits pass, the rest are asked."""
    q = _qa(spark, d).withColumn("split", splits.canonical(F.col("split"))).withColumn("model_reasoning", F.when(F.col("row_id") % 3 > 0, F.col("model_reasoning")))
    done = _qa(spark, d).where("row_id % 4 = 0").select("row_id", F.lit("a").alias("model_answer"), F.lit("r").alias("model_reasoning"))
    s = jobs.distil(q, provider.MockProvider(broken_every=0), "mock", "v2", done, "row_id")
    return s.select("row_id", "action", "distill.parse_status", "distill.api_success", "distill.api_latency_ms", F.md5("model_reasoning").alias("reasoning_md5"), (F.length("model_answer") > 0).alias("answered"))


def benchmark_run(spark: SparkSession, d: str) -> DataFrame:
    """A benchmark run that resumes: rows done before keep their prediction."""
    q = _qa(spark, d).where("source in ('finqa', 'convfinqa', 'tatqa')")
    before = jobs.benchmark(q.where("row_id % 5 = 0"), provider.MockProvider(fail_every=2, broken_every=0), key="row_id")
    b = jobs.benchmark(q, provider.MockProvider(broken_every=0), before, "row_id")
    return b.select("row_id", "api_success", "extracted_answer", "extraction_method", (F.col("mismatch_type") == "api_error").alias("failed"), (F.col("correct") & ~F.col("api_success")).alias("wrongly_right"))


def model_repairs(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'convfinqa' and model_answer is not null")
    return jobs.repaired(q, provider.MockProvider(), key="row_id").groupBy("route", F.col("repaired_answer").isNotNull().alias("repaired")).agg(F.count("*").alias("n"))


def task_hints(spark: SparkSession, d: str) -> DataFrame:
    h = jobs.hints(F.col("metadata"))
    return _qa(spark, d).select("row_id", *(c.alias(k) for k, c in h.items()))


def rule_first_counts(spark: SparkSession, d: str) -> DataFrame:
    rule = judges.by_source(F.col("task_type"), F.col("source"), F.col("question"), F.col("options"), F.col("model_answer"), F.col("reference_answer"), F.get_json_object("metadata", "$.file_name"))
    q = filtering.rule_first(_qa(spark, d).where("model_answer is not null"), rule)
    return q.groupBy("source", F.coalesce("judge.scoring_mode", F.lit("open")).alias("mode"), F.col("judge.score").alias("score")).agg(F.count("*").alias("n"))


def call_report(spark: SparkSession, d: str) -> DataFrame:
    return provider.call_report(table(spark, d, "distill_calls"), ["prompt_version", "teacher_model"])


def last_calls(spark: SparkSession, d: str) -> DataFrame:
    return merge.latest(table(spark, d, "distill_calls").select("id", "call_id", "parse_status", "called_at"), "id", ["called_at", "call_id"]).select("id", "call_id", "parse_status")


def resume_skip(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).withColumn("split", splits.canonical(F.col("split")))
    done = table(spark, d, "distill_calls").where("parse_status = 'success'").select("id", F.lit("a").alias("model_answer"), F.lit("r").alias("model_reasoning"))
    return provider.resume_plan(q, done).groupBy("source", "action").agg(F.count("*").alias("n"))


def fixed_sample(spark: SparkSession, d: str) -> DataFrame:
    return manifest.fixed_sample(_qa(spark, d).select("row_id", "source"), 200, "row_id").select("row_id", "position")


def hash_uniform(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).select("row_id", manifest.uniform_md5(F.lit("42"), F.col("row_id").cast("string")).alias("u"))


def weighted_pick(spark: SparkSession, d: str) -> DataFrame:
    u = manifest.uniform_md5(F.lit("42"), F.col("row_id").cast("string"))
    return _qa(spark, d).select("row_id", manifest.weighted_choice(u, list(DOMAIN_WEIGHTS.items())).alias("domain"))


def pool_stats(spark: SparkSession, d: str) -> DataFrame:
    return manifest.pool_statistics(manifest.pools(table(spark, d, "sample_refs"), SOURCE_WEIGHTS))


def _draw(spark: SparkSession, d: str, mode: str) -> DataFrame:
    refs = table(spark, d, "sample_refs")
    return manifest.draw(refs, SOURCE_WEIGHTS, DOMAIN_WEIGHTS, int(refs.count() * 0.8), mode=mode)


def quota_draws(spark: SparkSession, d: str) -> DataFrame:
    return manifest.oversampling(_draw(spark, d, "hash"), manifest.pools(table(spark, d, "sample_refs"), SOURCE_WEIGHTS))


def manifest_rows(spark: SparkSession, d: str) -> DataFrame:
    return _draw(spark, d, "hash")


def manifest_replay(spark: SparkSession, d: str) -> DataFrame:
    return _draw(spark, d, "replay")


def manifest_join(spark: SparkSession, d: str) -> DataFrame:
    refs, q = table(spark, d, "sample_refs"), _qa(spark, d).select("id").distinct().withColumn("known", F.lit(True))
    j = refs.join(q, refs.sample_id == q.id, "left")
    return j.groupBy("source").agg(F.count("*").alias("refs"), F.count("known").alias("known"), F.countDistinct("sample_id").alias("samples"))


def llm_map_mock(spark: SparkSession, d: str) -> DataFrame:
    p = _qa(spark, d).select("row_id", F.concat(F.lit("prompt "), F.col("row_id").cast("string")).alias("prompt"))
    r = provider.call(p, provider.MockProvider(), key="row_id")
    j = reply.judge_payload(F.col("text"))
    status = F.when(~F.col("success"), "api_failed").when(j["ok"], "parsed").otherwise("unparsed")
    return r.groupBy(status.alias("status"), F.when(j["ok"], j["score"]).alias("score")).agg(F.count("*").alias("n"), F.sum("latency_ms").alias("latency_ms"))


def props_payload(spark: SparkSession, d: str) -> DataFrame:
    j = reply.judge_payload(F.col("props"), "k")
    return table(spark, d, "events").groupBy("event_type", j["ok"].alias("ok"), j["score"].alias("score")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        keep_drop_join, score_summary, mismatch_counts, soft_keep, two_stage_filter, rule_first_counts, call_report, last_calls, resume_skip, fixed_sample, hash_uniform, weighted_pick, pool_stats, quota_draws,
        manifest_rows, manifest_replay, manifest_join, llm_map_mock, props_payload, reasoning_scores, lenient_verdicts, model_verdicts, answer_scores, distilled, benchmark_run, model_repairs, task_hints,
    )
}

_U = "cast('0x' || substr(md5(concat('42:', cast(row_id as varchar))), 1, 8) as bigint) / 4294967296.0::double"
_POOLS = "select d.task_domain, r.source, count(*) as train_size, ceil(count(*) * 3.0e0)::bigint as max_draws from sample_refs r join (values " + ", ".join(f"('{d}', '{s}')" for d, ss in SOURCE_WEIGHTS.items() for s in ss) + ") d(task_domain, source) on r.source = d.source group by all"

ORACLES = {
    "keep_drop_join": """with last as (select id, judge_success, judge from (select *, row_number() over (partition by id order by judged_at desc nulls last, judge_latency_ms desc nulls last, coalesce(judge.score, -1) desc) as o
        from judged_rows where id is not null and id <> '') where o = 1)
      select q.row_id, q.id, case when judge_success is null then 'missing_judge' when judge_success and coalesce(judge.score = 1, false) then 'keep' else 'drop' end as bucket from qa_samples q left join last l on q.id = l.id""",
    "score_summary": """select source, count(*) as total, count(*) filter (judge_success) as success, count(*) filter (not coalesce(judge_success, false)) as failure, count(*) filter (judge.score = 1) as keep,
        case when count(*) filter (judge_success) > 0 then count(*) filter (judge.score = 1)::double / count(*) filter (judge_success) else 0.0e0 end as keep_rate,
        count(*) filter (judge.scoring_mode = 'rule') as rule_scored, count(*) filter (judge.scoring_mode = 'llm') as llm_scored, coalesce(avg(judge_latency_ms) filter (judge_latency_ms > 0), 0.0e0) as mean_latency_ms
      from judged_rows group by source""",
    "mismatch_counts": "select source, judge.mismatch_type as mismatch_type, count(*) as n from judged_rows where coalesce(judge.mismatch_type, '') <> '' group by all",
    "soft_keep": """select source, case when coalesce(judge.judgment = 'correct', false) or coalesce(judge.mismatch_type, '') in ('rounding', 'percent_decimal_equivalent', 'format_only', 'none') then 'keep' else 'drop' end as bucket,
        count(*) as n from judged_rows group by all""",
    "call_report": """select prompt_version, teacher_model, count(*) as n, count(*) filter (parse_status = 'success') as parsed, count(*) filter (parse_status = 'failed') as parse_failed,
        count(*) filter (not coalesce(api_success, false)) as api_failed, coalesce(avg(api_latency_ms) filter (api_latency_ms > 0), 0.0e0) as mean_latency_ms from distill_calls group by all""",
    "last_calls": "select id, call_id, parse_status from (select *, row_number() over (partition by id order by called_at desc nulls last, call_id desc) as o from distill_calls where id is not null and id <> '') where o = 1",
    "resume_skip": f"""select source, action, count(*) as n from (select source, case when {canonical('split')} not in ('train', 'val') then 'skip' when id in (select id from distill_calls where parse_status = 'success' and id is not null) then 'reuse'
        when trim(coalesce(model_answer, ''), ' ') <> '' and trim(coalesce(model_reasoning, ''), ' ') <> '' then 'skip' else 'pending' end as action from qa_samples) group by all""",
    "fixed_sample": "select row_id, row_number() over (order by row_id)::int - 1 as position from (select row_id from qa_samples order by md5(concat('42:', cast(row_id as varchar))), row_id limit 200)",
    "hash_uniform": f"select row_id, {_U} as u from qa_samples",
    "weighted_pick": f"""select row_id, case when u <= 0.4e0 then 'financial_reasoning' when u <= 0.7e0 then 'financial_instruction' when u <= 0.95e0 then 'financial_knowledge' else 'market_sentiment' end as domain
      from (select row_id, {_U} as u from qa_samples)""",
    "pool_stats": f"select task_domain, source, sum(train_size)::bigint as train_size, sum(max_draws)::bigint as max_draws from ({_POOLS}) group by rollup (task_domain, source)",
    "manifest_join": """select r.source, count(*) as refs, count(q.id) as known, count(distinct r.sample_id) as samples from sample_refs r left join (select distinct id from qa_samples) q on r.sample_id = q.id group by r.source""",
    "llm_map_mock": """with h as (select cast('0x' || substr(md5(concat('prompt ', cast(row_id as varchar))), 1, 8) as bigint) as h from qa_samples)
      select status, score, count(*) as n, sum(ms)::bigint as latency_ms from (select case when h % 10 = 0 then 'api_failed' when h % 7 = 0 then 'unparsed' else 'parsed' end as status,
        case when h % 10 = 0 or h % 7 = 0 then null else h % 2 end::int as score, case when h % 10 = 0 then 0 else h % 500 end as ms from h) group by all""",
    "props_payload": "select event_type, true as ok, (coalesce(cast(props->>'$.k' as bigint), 0) <> 0)::int as score, count(*) as n from events group by all",
}

_W = ", ".join(f"('{d}', '{s}', {DOMAIN_WEIGHTS[d]}e0, {w}e0)" for d, ss in SOURCE_WEIGHTS.items() for s, w in ss.items())
#: Shares by weight and largest remainder; a domain whose cap is below its share takes its cap, and the others what that leaves.
ORACLES["quota_draws"] = f"""
  with w(d, s, dw, sw) as (values {_W}), size as (select source as s, count(*) as n from sample_refs group by source),
  dom as (select d, dw, sum(ceil(n * 3.0e0)) as cap, floor((select count(*) from sample_refs) * 0.8e0) as target from w join size on w.s = size.s group by d, dw),
  f as (select *, dw * target >= cap as capped from dom),
  g as (select *, target - (select coalesce(sum(cap), 0) from f where capped) as rest, (select sum(dw) from f where not capped) as open from f),
  h as (select *, rest * dw / open as want from g),
  dq as (select d, case when capped then cap else floor(want) + case when row_number() over (partition by capped order by floor(want) - want, d) <= rest - (select sum(floor(want)) from h where not capped) then 1 else 0 end end as q from h),
  src as (select w.d, w.s, dq.q, dq.q * sw / sum(sw) over (partition by w.d) as want from w join dq on w.d = dq.d),
  sq as (select d, s, floor(want) + case when row_number() over (partition by d order by floor(want) - want, s) <= q - sum(floor(want)) over (partition by d) then 1 else 0 end as draws from src)
  select d as task_domain, sq.s as source, n as train_size, draws::bigint as draws, ceil(n * 3.0e0)::bigint as max_draws, draws::double / n as oversample_factor from sq join size on sq.s = size.s"""


_H = lambda p: f"cast('0x' || substr(md5({p}), 1, 8) as bigint)"
_ASKED = f"(select *, {_H(text_queries.PROMPT)} as h from {text_queries.SOURCE_ROWS})"


def _hashed(template: str, name: str = "h", rows: str = text_queries.SOURCE_ROWS) -> str:
    return f"(select *, {_H(text_queries.rendered(jobs.JUDGE_TEMPLATES[template]))} as {name} from {rows})"


ORACLES["two_stage_filter"] = f"""
  with b as (select source, case when a % 10 = 0 or a % 7 = 0 or a % 2 = 0 then 'answer_drop' when h % 9 = 0 or h % 8 = 0 or h % 2 = 0 then 'reasoning_drop' else 'keep' end as bucket
    from {_hashed('reasoning', 'h', _hashed('answer', 'a'))} where source in ('finqa', 'tatqa') and model_answer is not null)
  select source, bucket, count(*) as n, count(*) / sum(count(*)) over (partition by source) as rate from b group by source, bucket"""
ORACLES["reasoning_scores"] = f"""select row_id, ok as score_success, case when ok then h % 2 end::int as score, case when ok then 0 end::int as relevance, ok as clean, case when h % 10 = 0 then 0 else h % 500 end::int as score_latency_ms,
    case when ok and h % 2 = 1 then 'keep' else 'drop' end as bucket from (select row_id, h, h % 10 <> 0 and h % 7 <> 0 as ok from {_hashed('reasoning')} where model_answer is not null)"""
ORACLES["lenient_verdicts"] = f"""select row_id, ok as judge_success, ok and h % 3 = 0 as consistent, case when ok and (h % 3 = 0 or h % 5 = 0) then 'keep' else 'drop' end as bucket
    from (select row_id, h, h % 10 <> 0 and h % 7 <> 0 as ok from {_hashed('lenient')} where model_answer is not null)"""
ORACLES["model_verdicts"] = f"""select row_id, ok as judge_success, case when ok then h % 2 end::int as score, case when ok then case when h % 5 = 0 then 'rounding' else 'value_error' end end as mismatch_type,
    case when h % 10 = 0 then 0 else h % 500 end::int as judge_latency_ms from (select row_id, h, h % 10 <> 0 and h % 7 <> 0 as ok from {_hashed('answer')} where model_answer is not null)"""
_FULL = "trim(coalesce(model_answer, ''), ' ') <> '' and trim(coalesce(case when row_id % 3 > 0 then model_reasoning end, ''), ' ') <> ''"
ORACLES["distilled"] = f"""
  select row_id, action, case when action = 'pending' then case when h % 10 = 0 then 'api_failed' else 'success' end end as parse_status, case when action = 'pending' then h % 10 <> 0 end as api_success,
    case when action = 'pending' then case when h % 10 = 0 then 0 else h % 500 end end::int as api_latency_ms,
    md5(case action when 'reuse' then 'r' when 'skip' then coalesce(case when row_id % 3 > 0 then model_reasoning end, '') else case when h % 10 = 0 then '' else concat('seed ', h) end end) as reasoning_md5,
    case action when 'reuse' then true when 'skip' then length(coalesce(model_answer, '')) > 0 else h % 10 <> 0 end as answered
  from (select *, case when {canonical('split')} not in ('train', 'val') then 'skip' when row_id % 4 = 0 then 'reuse' when {_FULL} then 'skip' else 'pending' end as action from {_ASKED})"""
ORACLES["benchmark_run"] = f"""
  select row_id, ok as api_success, case when ok then cast(h % 1000 as varchar) else '' end as extracted_answer, case when ok then 'json' else 'none' end as extraction_method, not ok as failed, false as wrongly_right
  from (select row_id, h, case when row_id % 5 = 0 then h % 2 <> 0 else h % 10 <> 0 end as ok from {_ASKED} where source in ('finqa', 'convfinqa', 'tatqa'))"""
_M = lambda k: f"{text_queries.strip(f'metadata->>{chr(39)}$.{k}{chr(39)}')}"
ORACLES["task_hints"] = f"select row_id, coalesce(nullif({_M('subject')}, ''), 'N/A') as subject, coalesce(nullif({_M('file_name')}, ''), 'N/A') as task, coalesce(nullif({_M('desc')}, ''), 'N/A') as task_desc from qa_samples"
ORACLES["rule_first_counts"] = f"select source, case when rule_score is null then 'open' else 'rule' end as mode, rule_score as score, count(*) as n from {RULED} group by all"
ORACLES["answer_scores"] = f"""
  with b as (select r.source, r.rule_score, h, h % 10 <> 0 and h % 7 <> 0 as ok from {RULED} r join {_hashed('answer')} a on r.row_id = a.row_id)
  select source, case when rule_score is not null then 'rule' when ok then 'llm' else 'failed' end as mode,
    case when rule_score = 1 or rule_score is null and ok and h % 2 = 1 then 'keep' else 'drop' end as bucket, count(*) as n from b group by all"""
ORACLES["manifest_rows"] = f"""
  with q as (select *, sum(draws) over (order by task_domain, source) - draws as first from ({ORACLES['quota_draws']})),
  k as (select *, unnest(range(draws)) as k from q),
  p as (select *, floor(cast('0x' || substr(md5(concat('42:', source, ':', k)), 1, 8) as bigint) / 4294967296.0::double * train_size)::bigint as row_index from k),
  r as (select source, sample_id, dataset_path, line_number, row_number() over (partition by source order by md5(concat_ws(':', sample_id, cast(line_number as varchar), dataset_path)), sample_id, line_number, dataset_path) - 1 as row_index from sample_refs)
  select (first + k)::bigint as manifest_index, p.source, task_domain, 'train' as split, sample_id, dataset_path, line_number, k + 1 as draw_index_within_dataset from p join r on p.source = r.source and p.row_index = r.row_index"""
