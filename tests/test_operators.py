import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qaforge import schema
from qaforge.operators import badcases, filtering, judges, manifest, merge, prompts, provider, repair, reply, sft, splits


@given(st.integers(3, 5000))
@settings(max_examples=60, deadline=None)
def test_sizes_sum_up(n):
    s = splits.sizes(n)
    assert sum(s.values()) == n and min(s.values()) >= 1


def test_sizes_small():
    assert splits.sizes(50) == {"train": 38, "val": 6, "test": 6} and splits.sizes(3) == {"train": 1, "val": 1, "test": 1}
    with pytest.raises(ValueError):
        splits.sizes(2)


def test_size_column_agrees(spark):
    df = spark.range(3, 400).select("id", splits.size_column(F.col("id")).alias("s"))
    for r in df.collect():
        want = splits.sizes(r["id"])
        assert (r["s"]["train"], r["s"]["val"]) == (want["train"], want["val"])


def test_resplit_same_under_partitions(spark):
    rows = [(f"k{i}", "s" if i % 3 else "t") for i in range(200)]
    out = []
    for n in (1, 7):
        df = spark.createDataFrame(rows, "id string, source string").repartition(n)
        out.append(sorted(map(tuple, splits.resplit(df).select("id", "split").collect())))
    assert out[0] == out[1] and {s for _, s in out[0]} == {"train", "val", "test"}


def test_resplit_replay(spark):
    df = spark.createDataFrame([(f"k{i:02d}", "s") for i in range(10)], "id string, source string")
    order = sorted(f"k{i:02d}" for i in range(10))
    random.Random(42).shuffle(order)
    cut = splits.sizes(10)
    want = {k: ("train" if i < cut["train"] else "val" if i < cut["train"] + cut["val"] else "test") for i, k in enumerate(order)}
    assert {r["id"]: r["split"] for r in splits.resplit(df, mode="replay").collect()} == want


def test_resplit_too_small(spark):
    df = spark.createDataFrame([("a", "s"), ("b", "s")], "id string, source string")
    with pytest.raises(Exception, match="too few rows"):
        splits.resplit(df).collect()


def test_validation(spark):
    fields = schema.SAMPLE.fieldNames()
    good = {f: "x" for f in fields} | {"options": [], "metadata": {}}
    lines = [json.dumps(good), json.dumps(dict(reversed(good.items()))), json.dumps(good | {"id": 5, "options": "x"}), "nonsense", json.dumps({k: v for k, v in good.items() if k != "id"})]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    got = {r["i"]: r["issues"] for r in merge.validate(df, fields).collect()}
    assert got == {1: ["field_order_mismatch"], 2: ["id_not_string", "options_not_list"], 3: ["not_json"], 4: ["field_set_mismatch", "id_not_string"]}


def test_repeats_latest_and_slices(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4), ("a", 5)], "id string, n int")
    assert sorted((r["id"], r["n"], r["occurrence"]) for r in merge.repeats(df, "id", ["n"]).collect()) == [("a", 3, 2), ("a", 5, 3)]
    assert sorted(map(tuple, merge.latest(df, "id", ["n"]).collect())) == [("a", 5), ("b", 2)]
    assert [r["n"] for r in merge.slice_rows(df, ["n"], 1, 3).orderBy("position").collect()] == [2, 3]


def test_verify_files(spark):
    m = spark.createDataFrame([("a", True, 1, 5), ("b", True, 2, 9), ("c", False, 0, 0)], "name string, success boolean, file_count bigint, total_bytes bigint")
    f = spark.createDataFrame([("a", 5), ("b", 4), ("d", 1)], "name string, length bigint")
    assert {r["name"]: r["issues"] for r in merge.verify_files(m, f).collect()} == {"b": ["file_count_mismatch", "size_mismatch"], "c": ["not_downloaded"], "d": ["not_in_manifest"]}


def test_fixed_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "id")
    a = manifest.fixed_sample(df, 10).collect()
    assert len(a) == 10 and sorted(r["position"] for r in a) == list(range(10))
    b = sorted(r["id"] for r in manifest.fixed_sample(df, 10, mode="replay").collect())
    assert b == sorted(random.Random(42).sample(range(100), 10))
    with pytest.raises(ValueError):
        manifest.fixed_sample(df, 101)


def test_quotas():
    q = manifest.quotas({("d", "a"): (0.5, 10), ("d", "b"): (0.5, 100), ("e", "c"): (1.0, 5)}, {"d": 0.5, "e": 0.5}, 50)
    assert q == {("d", "a"): 10, ("d", "b"): 35, ("e", "c"): 5}
    with pytest.raises(ValueError):
        manifest.quotas({("d", "a"): (1.0, 10)}, {"d": 1.0}, 11)


@pytest.mark.parametrize("mode", ["hash", "replay"])
def test_draws(spark, mode):
    refs = spark.createDataFrame([(s, "x", f"{s}{i}", "p", i) for s, n in (("a", 5), ("b", 20)) for i in range(n)], "source string, task_domain string, sample_id string, dataset_path string, line_number bigint")
    out = manifest.draw(refs, {"d": {"a": 1.0}, "e": {"b": 1.0}}, {"d": 0.5, "e": 0.5}, 40, factor=3.0, mode=mode).collect()
    per = {s: sum(r["source"] == s for r in out) for s in "ab"}
    assert len(out) == 40 and per["a"] <= 15 and per["b"] <= 60 and len({r["manifest_index"] for r in out}) == 40
    with pytest.raises(Exception, match="no rows|factor"):
        manifest.draw(refs, {"d": {"zz": 1.0}}, {"d": 1.0}, 1).collect()


def parse(spark, text, task="reasoning", question="Why?", options=None):
    df = spark.createDataFrame([(text, task, question, options or [])], "reply string, task_type string, question string, options array<string>")
    return tuple(reply.parse(df).first()["parsed"])


def test_parse(spark):
    assert parse(spark, '```json\n{"reasoning": "r", "final_answer": "It is 5."}\n```') == ("r", "It is 5.", "success", "")
    assert parse(spark, '{"reasoning": "r", "final_answer": "about $5.2 in all"}', question="How much is it?")[1] == "5.2"
    assert parse(spark, "so\nAnswer: positive", "sentiment")[1] == "positive"
    assert parse(spark, "We pick option B.", "mcq", options=["x", "y"])[1] == "B"
    assert parse(spark, '{"reasoning": "r", "final_answer": ""}')[2:] == ("failed", "json_missing_required_fields")
    assert parse(spark, "")[2] == "failed" and parse(spark, None)[2] == "failed"
    assert parse(spark, "Was it? No, yes.", question="Was it up?")[1] == "yes"
    assert parse(spark, '{"reasoning": "cut off here, "final_answer": "7"', question="How many?")[1] == "7"


def test_extract(spark):
    df = spark.createDataFrame([("<reasoning>a</reasoning>\n<final_answer> 5 </final_answer>",), ('{"reasoning": "a", "final_answer": 5}',), ("a\nFinal answer: 5",), ("a\n5",), (None,)], "r string")
    got = [tuple(x[0]) for x in df.select(reply.extract(F.col("r"))).collect()]
    assert got == [("a", "5", "xml_tags"), ("a", "5", "json"), ("a", "5", "final_answer_marker"), ("a", "5", "last_line_fallback"), ("", "", "last_line_fallback")]


def test_payloads(spark):
    df = spark.createDataFrame([('x {"score": "1", "judgment": "ok"} y',), ('{"score": true}',), ("none",), ('{"is_consistent": "false"}',), ('{"is_consistent": false}',)], "r string")
    assert [(x[0]["ok"], x[0]["score"]) for x in df.select(reply.judge_payload(F.col("r"))).collect()][:3] == [(True, 1), (True, 1), (False, 0)]
    assert [x[0]["is_consistent"] for x in df.select(reply.consistency_payload(F.col("r"))).collect()] == [False, False, False, True, False]


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_judges(spark):
    L, opts = F.lit, F.array(F.lit("A. x"), F.lit("B. y"))
    assert one(spark, judges.exam(opts, L("选择 B"), L("B")))["score"] == 1 and one(spark, judges.exam(opts, L(""), L("B")))["mismatch_type"] == "format_error"
    assert one(spark, judges.exam(opts, L("无法确定"), L("B")))["mismatch_type"] == "abstain_error" and one(spark, judges.exam(opts, L("?"), L("B")))["score"] is None
    assert one(spark, judges.instruction(L("FINFE"), L("q"), L("利好"), L("积极")))["score"] == 1
    assert one(spark, judges.instruction(L("FINRE"), L("q"), L("供应"), L("收购")))["mismatch_type"] == "relation_error"
    assert one(spark, judges.instruction(L("FINNA"), L("q"), L("a"), L("b")))["score"] is None
    assert one(spark, judges.open_question(L("Is it?"), L("No."), L("yes it is")))["mismatch_type"] == "yesno_error"
    assert one(spark, judges.sentiment(L("Positive"), L("positive")))["score"] == 1
    assert tuple(one(spark, judges.generic(L("true or false?"), F.lit(None).cast("array<string>"), L("yes"), L("no")))) == (0, "rule_judgment")


def test_badcases(spark):
    L = F.lit
    assert one(spark, badcases.numeric(L("5"), L("5"))) is None and one(spark, badcases.numeric(L("-5"), L("5"))) == "sign_error"
    assert one(spark, badcases.table_question(L("5%"), L("5"), L(""), L("success"), L(""), L(""))) == "percentage_or_unit_error"
    assert one(spark, badcases.table_question(L("a"), L("b"), L(""), L("success"), L("span"), L(""))) == "evidence_misread"
    assert one(spark, badcases.sentiment(L("negative"), L("positive"), L(""))) == "polarity_flip"
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "category string, id int")
    assert sorted((r["category"], r["n"], r["rate"]) for r in badcases.counts(df).collect()) == [("a", 2, 0.5), ("b", 1, 0.25)]
    assert len(badcases.examples(df, 1).collect()) == 2


def test_keep_and_drop(spark):
    s = spark.createDataFrame([("a",), ("b",), ("c",), ("",)], "id string")
    j = spark.createDataFrame([("a", True, 0, 1), ("a", True, 1, 2), ("b", False, None, 1), ("", True, 1, 1)], "id string, judge_success boolean, score int, judged_at int").select("id", "judge_success", F.struct("score").alias("judge"), "judged_at")
    assert {r["id"]: r["bucket"] for r in filtering.with_verdict(s, j).collect()} == {"a": "keep", "b": "drop", "c": "missing_judge", "": "missing_judge"}
    assert one(spark, filtering.keep_soft(F.lit(False), F.lit("none"))) == "keep" and one(spark, filtering.keep_soft(F.lit(None).cast("boolean"), F.lit(None).cast("string"))) == "drop"


def test_publish(spark, tmp_path):
    a, b = spark.range(3).toDF("x"), spark.range(2).toDF("x")
    assert {r["artifact"]: r["n"] for r in filtering.publish({"keep": a, "drop": b}, str(tmp_path / "out")).collect()} == {"keep": 3, "drop": 2}


def test_repair_and_history(spark):
    df = spark.createDataFrame([("1", "How much?", "5.2%", "Conclusion: 5.2%", "5.2%"), ("2", "How much?", "", "", "3"), ("3", "What percentage?", "12.4%", "", "12%"), ("4", "How much?", "", "", "3")], "id string, question string, model_answer string, model_reasoning string, reference_answer string")
    got = {r["id"]: r["route"] for r in repair.route(df, max_repairs=1).collect()}
    assert got == {"1": "skip", "2": "queued", "3": "local", "4": "over_limit"}
    t = spark.createDataFrame([("c", 1, "q1", "a1"), ("c", 2, "q2", ""), ("c", 10, "q3", "a3")], "c string, n int, q string, a string")
    assert [r["history"] for r in repair.history(t, "c", "n", "q", "a").orderBy("n").collect()] == ["", "User: q1\nAssistant: a1", "User: q1\nAssistant: a1\nUser: q2"]


def test_prompts(spark):
    assert prompts.pieces('{{"a": {x}}}') == [(False, '{"a": '), (True, "x"), (False, "}")]
    with pytest.raises(ValueError):
        prompts.pieces("a } b")
    assert one(spark, prompts.render("<{x}|{y}>", {"x": F.lit("{y}"), "y": F.lit(None).cast("string")})) == "<{y}|>"
    with pytest.raises(KeyError):
        prompts.render("{z}", {})


def test_provider(spark):
    df = spark.range(40).select("id", F.concat(F.lit("p"), F.col("id")).alias("prompt"))
    a = {r["id"]: r["text"] for r in provider.call(df, provider.MockProvider()).collect()}
    b = {r["id"]: r["text"] for r in provider.call(df.repartition(5), provider.MockProvider(), threads=2).collect()}
    assert a == b and len(a) == 40
    none = provider.call(spark.createDataFrame([(1, None)], "id int, prompt string"), provider.MockProvider()).first()
    assert not none["success"]
    assert provider.stream_text(iter(['data: {"choices": [{"delta": {"content": "a"}}]}', "x", 'data: {"delta": "b"}', "data: {bad", "data: [DONE]", 'data: {"delta": "c"}'])) == "ab"
    assert provider.body_text({"choices": [{"message": {"content": "z"}}]}) == "z" and provider.body_text({"output": [{"content": [{"text": "q"}]}]}) == "q"


def test_sft(spark):
    df = spark.createDataFrame([("1", "s", "MCQ", "d", "en", "Q", None, ["A. x", "y"], "r", "A")], "id string, source string, task_type string, task_domain string, language string, question string, context string, options array<string>, model_reasoning string, model_answer string")
    m = sft.export(df).first()["messages"]
    assert [x["role"] for x in m] == ["system", "user", "assistant"] and "Options:\nA. x\nB. y" in m[1]["content"] and "Context" not in m[1]["content"]
    assert m[2]["content"] == "<reasoning>\nr\n</reasoning>\n<final_answer>\nA\n</final_answer>"
