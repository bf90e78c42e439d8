"""Whole jobs: distilling, scoring, benchmarks and repairs (L3-L8, F1-F4, R3), each a plan around one written table of replies.

A job takes what is done already and asks only for the rest; a failed call is a row with success false, never a failed job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions import options as O
from ..functions import text as T
from ..session import materialise
from ..sources import config, sinks
from . import execution, filtering, judges, manifest, merge, prompts, provider, repair, reply, splits

#: Characters of question, context, options and history that prompts of models take, and of shorter fields in prompts of judges.
LIMITS = {"question": 4_000, "context": 24_000, "options": 4_000, "history": 4_000}
#: Dimensions that the judge of reasoning scores, fixed values.
DIMENSIONS = ("internal_consistency", "term_overlap", "step_count_ok", "logical_consistency", "content_diversity", "domain_relevance", "instruction_alignment")
#: Short judge templates of our own (G5); slots: question, context, options, reference, answer, reasoning.
JUDGE_TEMPLATES = {
    "answer": "Compare the answer with the reference.\n\nQuestion:\n{question}\n\nOptions:\n{options}\n\nReference:\n{reference}\n\nAnswer:\n{answer}\n\nReply as JSON: {{\"score\": 0 or 1, \"judgment\": \"...\", \"mismatch_type\": \"...\", \"reason\": \"...\"}}",
    "lenient": "Do both answers say the same but for form and rounding?\n\nQuestion:\n{question}\n\nReference:\n{reference}\n\nAnswer:\n{answer}\n\nReply as JSON: {{\"is_consistent\": true or false, \"judgment\": \"...\", \"mismatch_type\": \"...\", \"reason\": \"...\"}}",
    "reasoning": "Score the reasoning, each dimension 0 or 1.\n\nQuestion:\n{question}\n\nContext:\n{context}\n\nReasoning:\n{reasoning}\n\nAnswer:\n{answer}\n\nReply as JSON with score, " + ", ".join(DIMENSIONS) + " and reason.",
    "repair": "Correct the answer to the last question.\n\nContext:\n{context}\n\nQuestion:\n{question}\n\nAnswer:\n{answer}\n\nReasoning:\n{reasoning}\n\nReply as JSON: {{\"reasoning\": \"...\", \"final_answer\": \"...\"}}",
}
TASK_FIELDS = ("task", "file_name")


def hints(metadata: Column) -> dict[str, Column]:
    """Subject, task and its description from the metadata text, at the top or in the raw sample (G3); N/A where it names none."""
    at = lambda *keys: T.first_filled(*(F.get_json_object(metadata, f"$.{p}{k}") for k in keys for p in ("", "raw_sample.")))
    named = {"subject": at("subject", "subject_name"), "task": at(*TASK_FIELDS), "task_desc": at("desc", "task_desc")}
    return {k: F.coalesce(F.nullif(v, F.lit("")), F.lit("N/A")) for k, v in named.items()}


def slots(df: DataFrame, limits: dict[str, int] = LIMITS) -> dict[str, Column]:
    """Slots of the templates over normalised samples; history is that of a column of the name, if there is one."""
    has = lambda c: F.col(c) if c in df.columns else F.lit("")
    cut = {"question": F.col("question"), "context": F.col("context"), "options": O.relabelled(F.col("options")), "history": has("history")}
    cut |= {"reference": has("reference_answer"), "answer": has("model_answer"), "reasoning": has("model_reasoning")}
    return prompts.limited({k: (c, limits.get(k, LIMITS["question"])) for k, c in cut.items()})


def prompted(df: DataFrame, templates: dict[str, str] = prompts.TEMPLATES, rules=prompts.RULES, default: str = "instruction") -> DataFrame:
    """df with template and prompt."""
    name = prompts.route(rules, {"source": F.col("source"), "task_type": F.col("task_type")}, default)
    return prompts.render_routed(df.withColumn("template", name), "template", templates, slots(df))


def _called(df: DataFrame, model: provider.Provider, key: str, template: str | None = None) -> DataFrame:
    """df with prompt and call, a STRUCT of the reply; the replies are written once."""
    p = prompted(df) if template is None else df.withColumn("prompt", prompts.render(template, slots(df)))
    got = provider.call(p.select(key, "prompt"), model, key)
    return p.join(got.select(key, F.struct("success", "text", "error", "latency_ms").alias("call")), key)


def distil(samples: DataFrame, model: provider.Provider, name: str, version: str = "v1", done: DataFrame | None = None, key: str = "id", keep_raw: bool = True, overwrite: bool = False, split: str = "split") -> DataFrame:
    """samples with model_reasoning, model_answer and distill, a STRUCT of how they came about (L3, L4).

    samples: normalised, with a unique key. Rows that done (key, model_answer, model_reasoning) has an output for are reused, rows
    that are filled or of no split to process pass through; both have a NULL distill. A reply that cannot be read, or a failed
    call, leaves both outputs ''.
    """
    done = samples.select(key, "model_answer", "model_reasoning").limit(0) if done is None else done
    base = samples.withColumn("_split", F.col(split)).withColumn("id" if key != "id" else "_same", F.col(key))
    plan = provider.resume_plan(base.withColumn("split", F.col("_split")), done.withColumnRenamed(key, "id"), overwrite=overwrite).drop("_split", "_same")
    last = done.where(provider.filled()).groupBy(key).agg(F.max_by(F.struct("model_answer", "model_reasoning"), F.struct("model_answer", "model_reasoning")).alias("_have"))
    kind = "struct<prompt_version:string,teacher_model:string,raw_response_text:string,parse_status:string,parse_error:string,api_success:boolean,api_latency_ms:int>"
    rest = plan.where("action <> 'pending'").join(last, key, "left")
    reuse = lambda c: F.when(F.col("action") == "reuse", F.col(f"_have.{c}")).otherwise(F.coalesce(F.col(c), F.lit("")))
    rest = rest.withColumns({c: reuse(c) for c in ("model_answer", "model_reasoning")}).withColumn("distill", F.lit(None).cast(kind)).drop("_have")
    asked = _called(plan.where("action = 'pending'"), model, key).withColumn("reply", F.col("call.text"))
    read = reply.parse(asked)
    ok, good = F.col("call.success"), F.col("call.success") & (F.col("parsed.status") == "success")
    info = F.struct(
        F.lit(version).alias("prompt_version"), F.lit(name).alias("teacher_model"), (F.col("call.text") if keep_raw else F.lit("")).alias("raw_response_text"),
        F.when(ok, F.col("parsed.status")).otherwise("api_failed").alias("parse_status"), F.when(ok, F.col("parsed.error")).otherwise(F.col("call.error")).alias("parse_error"),
        ok.alias("api_success"), F.col("call.latency_ms").cast("int").alias("api_latency_ms"),
    ).cast(kind)
    read = read.withColumns({"model_answer": F.when(good, F.col("parsed.final_answer")).otherwise(""), "model_reasoning": F.when(good, F.col("parsed.reasoning")).otherwise(""), "distill": info})
    return read.drop("call", "parsed", "reply", "prompt", "template").unionByName(rest)


def judged_by_model(df: DataFrame, model: provider.Provider, template: str = "answer", key: str = "id") -> DataFrame:
    """df with judge_success, judge_error, judge_latency_ms and judge, the verdict of a model (L6); a reply without a JSON object
    is a failure."""
    asked = _called(df, model, key, JUDGE_TEMPLATES[template])
    p = reply.judge_payload(F.col("call.text"))
    ok = F.col("call.success") & F.col("_p.ok")
    verdict = F.struct(F.col("_p.score").alias("score"), F.col("_p.judgment").alias("judgment"), F.col("_p.mismatch_type").alias("mismatch_type"), F.col("_p.reason").alias("reason"), F.lit("llm").alias("scoring_mode"))
    error = F.when(~F.col("call.success"), F.col("call.error")).when(~F.col("_p.ok"), "parse_error: no JSON object").otherwise("")
    x = asked.withColumn("_p", p).withColumns({"judge_success": ok, "judge_error": error, "judge_latency_ms": F.col("call.latency_ms"), "judge": F.when(ok, verdict)})
    return x.drop("_p", "call", "prompt")


def scored_answers(df: DataFrame, model: provider.Provider, key: str = "id") -> DataFrame:
    """df with the verdict of the rules of its source where they settle it, else of a model (F2): judge_success, judge and bucket."""
    rule = judges.by_source(F.col("task_type"), F.col("source"), F.col("question"), F.col("options"), F.col("model_answer"), F.col("reference_answer"), F.get_json_object("metadata", "$.file_name"))
    ruled = df.withColumn("_rule", rule)
    kept = ("score", "judgment", "mismatch_type", "reason", "scoring_mode")
    text = lambda c: F.col(f"_rule.{c}") if c in dict(ruled.select("_rule.*").dtypes) else F.lit("rule" if c == "scoring_mode" else "")
    done = ruled.where("_rule.score is not null").withColumns({"judge_success": F.lit(True), "judge_error": F.lit(""), "judge_latency_ms": F.lit(0), "judge": F.struct(*(text(c).alias(c) for c in kept))})
    asked = judged_by_model(ruled.where("_rule.score is null"), model, "answer", key)
    both = done.unionByName(asked.withColumn("judge", F.col("judge").cast(dict(done.dtypes)["judge"]))).drop("_rule")
    return both.withColumn("bucket", F.when(F.col("judge_success") & (F.col("judge.score") == 1), "keep").otherwise("drop"))


def scored_reasoning(df: DataFrame, model: provider.Provider, key: str = "id") -> DataFrame:
    """df with score (0 or 1 in all and for each of DIMENSIONS, and a reason), score_success, score_error, score_latency_ms and
    bucket: keep if the call succeeded and the score is 1 (F3)."""
    asked = _called(df, model, key, JUDGE_TEMPLATES["reasoning"]).withColumn("_p", reply.judge_payload(F.col("call.text"), dims=DIMENSIONS))
    ok = F.col("call.success") & F.col("_p.ok")
    score = F.struct(F.col("_p.score").alias("score"), *(F.col(f"_p.{d}").alias(d) for d in DIMENSIONS), F.col("_p.reason").alias("reason"))
    error = F.when(~F.col("call.success"), F.col("call.error")).when(~F.col("_p.ok"), "parse_error: no JSON object").otherwise("")
    x = asked.withColumns({"score_success": ok, "score_error": error, "score_latency_ms": F.col("call.latency_ms"), "score": F.when(ok, score)}).drop("_p", "call", "prompt")
    return x.withColumn("bucket", F.when(F.col("score_success") & (F.col("score.score") == 1), "keep").otherwise("drop"))


def leniently_judged(df: DataFrame, model: provider.Provider, key: str = "id") -> DataFrame:
    """df with the verdict of the lenient judge and bucket (F4): kept if consistent, or inconsistent for a soft reason only."""
    asked = _called(df, model, key, JUDGE_TEMPLATES["lenient"]).withColumn("lenient", reply.consistency_payload(F.col("call.text")))
    ok = F.col("call.success") & F.col("lenient.ok")
    keep = filtering.keep_soft(F.col("lenient.is_consistent"), F.col("lenient.mismatch_type"))
    return asked.withColumn("judge_success", ok).withColumn("bucket", F.when(ok, keep).otherwise("drop")).drop("call", "prompt")


def two_stages(df: DataFrame, answer_judge: provider.Provider, reasoning_judge: provider.Provider, key: str = "id") -> DataFrame:
    """df with bucket answer_drop, reasoning_drop or keep (F1): the second judge is asked only about rows that the first kept."""
    first = scored_answers(df, answer_judge, key).withColumnRenamed("bucket", "_first")
    second = scored_reasoning(first.where("_first = 'keep'"), reasoning_judge, key).withColumn("bucket", F.when(F.col("bucket") == "keep", "keep").otherwise("reasoning_drop"))
    return second.unionByName(first.where("_first = 'drop'").withColumn("bucket", F.lit("answer_drop")), allowMissingColumns=True).drop("_first")


def benchmark(samples: DataFrame, model: provider.Provider, done: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Predictions of a model on samples (L7): (key, source, split, reference_answer, prompt, api_success, api_error, api_latency_ms,
    extracted_answer, extraction_method, correct, execution_correct, mismatch_type, executable), one row per key.

    Keys of done (the same columns) are not asked again and keep their row. A failed call has mismatch_type api_error and
    counts as wrong.
    """
    todo = samples if done is None else samples.join(done.select(key), key, "left_anti")
    asked = _called(execution.gold(todo.withColumn("id", F.col(key)) if key != "id" else todo), model, key).withColumn("_e", reply.extract(F.col("call.text")))
    asked = asked.withColumn("extracted_answer", F.when(F.col("call.success"), F.col("_e.final_answer")).otherwise(""))
    run = execution.executed(asked, "gold_program")
    value = F.when(F.col("executed.executable"), F.coalesce(F.col("executed.txt"), F.col("executed.num").cast("string"))).otherwise("")
    q, c, a, g, ok = F.col("question"), F.col("context"), F.col("extracted_answer"), F.col("gold_answer"), F.col("call.success")
    turn = F.lower(F.col("source")) == "convfinqa"
    right = F.when(turn, C.benchmark_turn_match(q, c, a, g)).otherwise(C.benchmark_match(q, a, g))
    kind = F.when(~ok, "api_error").when(turn, C.turn_match(q, a, g)["mismatch"]).otherwise(C.mismatch(a, g))
    out = run.withColumn("_value", value).select(
        key, "source", "split", F.col("gold_answer").alias("reference_answer"), "prompt", ok.alias("api_success"), F.col("call.error").alias("api_error"), F.col("call.latency_ms").alias("api_latency_ms"),
        "extracted_answer", F.when(ok, F.col("_e.method")).otherwise("none").alias("extraction_method"), F.coalesce(ok & right, F.lit(False)).alias("correct"),
        F.coalesce(ok & C.execution_match(q, c, a, g, F.col("_value")), F.lit(False)).alias("execution_correct"), kind.alias("mismatch_type"), F.coalesce(F.col("executed.executable"), F.lit(False)).alias("executable"),
    )
    return out if done is None else out.unionByName(done.join(samples.select(key), key, "left_semi").select(out.columns))


def repaired(df: DataFrame, model: provider.Provider | None, max_repairs: int | None = None, key: str = "id") -> DataFrame:
    """Dialogue samples with route and repaired_answer (R1-R3, L8): locally where normalising is enough, by a model for queued rows
    (none is asked if model is None: a dry run). A failed or unreadable reply leaves repaired_answer NULL and the route
    queued. Rows of another source are an error."""
    r = repair.route(df.withColumn("id", F.col(key)) if key != "id" else df, max_repairs)
    r = r.withColumn("route", F.when(F.lower(F.col("source")) == "convfinqa", F.col("route")).otherwise(F.raise_error(F.lit("not a dialogue sample"))))
    if model is None:
        return r
    asked = _called(r.where("route = 'queued'"), model, key, JUDGE_TEMPLATES["repair"]).withColumn("reply", F.col("call.text"))
    read = reply.parse(asked)
    good = F.col("call.success") & (F.col("parsed.status") == "success")
    read = read.withColumn("repaired_answer", F.when(good, C.turn_answer(F.col("parsed.final_answer")))).withColumn("route", F.when(good, "model").otherwise("queued"))
    return merge.union_all([r.where("route <> 'queued'"), read.drop("call", "parsed", "reply", "prompt")])


def split_job(spark: SparkSession, samples: DataFrame, out: str, seed: int = 42, ratios: dict[str, float] | None = None) -> dict:
    """Split, write JSON lines by source and split, and report rows per source and split."""
    df = splits.split_dataset(samples, seed=seed, ratios=ratios)
    sinks.write_json_lines(df, f"{out}/rows", ["source", "split"])
    report = sinks.figures(df.groupBy("source", "split").agg(F.count("*").alias("rows")), ["source", "split"])
    sinks.write_report(spark, f"{out}/report.json", report)
    return report


def manifest_job(spark: SparkSession, refs: DataFrame, settings: config.Sampling, out: str, mode: str = "hash") -> dict:
    """Draw a manifest by the settings, write it in order and report how often rows of each pool were drawn (M7)."""
    m = materialise(manifest.draw(refs, settings.source_weights, settings.domain_weights, settings.target, settings.max_oversample, settings.seed, mode))
    n = sinks.write_ordered(m, f"{out}/manifest", ["manifest_index"])
    pool = manifest.pools(refs, settings.source_weights, settings.max_oversample)
    report = {"draws": n, "pools": sinks.figures(manifest.oversampling(m, pool), ["task_domain", "source"])}
    sinks.write_report(spark, f"{out}/report.json", report)
    return report
