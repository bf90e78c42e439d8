"""Sinks, settings, values, execution, whole jobs and the command line on small tables."""

import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from qaforge.__main__ import run
from qaforge.functions import values
from qaforge.operators import execution, jobs, provider
from qaforge.sources import adapters, config, readers, sinks
from qaforge.sources.adapters import Kind

SAMPLE = "id string, source string, split string, task_type string, task_domain string, language string, question string, context string, options array<string>, reference_answer string, metadata string, model_answer string, model_reasoning string"


def row(i, source="finqa", split="train", task="reasoning", answer=None, reasoning=None, reference="5", metadata="{}"):
    return (f"r{i}", source, split, task, "d", "en", f"How much is {i}?", "a context", None, reference, metadata, answer, reasoning)


def test_json_lines_keep_nulls_and_scripts(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a\n\"b\""), (2, "年报", None)], "i int, s string, t string")
    assert sinks.write_json_lines(df, f"file://{tmp_path}/x") == 2
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "x").glob("part-*"))
    assert "年报" in text and '"s":null' in text
    assert sinks.write_json_lines(df.limit(0), f"file://{tmp_path}/x") == 0 and readers.json_lines(spark, f"file://{tmp_path}/x", "i int").count() == 0


def test_failed_write_leaves_the_old_output(spark, tmp_path):
    df = spark.range(5).toDF("i")
    sinks.write_json_lines(df, f"file://{tmp_path}/x")
    with pytest.raises(Exception, match="planned"):
        sinks.write_json_lines(df.withColumn("bad", F.raise_error(F.lit("planned"))), f"file://{tmp_path}/x")
    assert readers.json_lines(spark, f"file://{tmp_path}/x", "i int").count() == 5 and [p.name for p in tmp_path.iterdir()] == ["x"]


def test_shards_and_order(spark, tmp_path):
    df = spark.range(25).select((F.col("id") * 7 % 25).alias("k"))
    assert sinks.write_shards(df, f"file://{tmp_path}/s", ["k"], 10) == ["part.0_10.jsonl", "part.10_20.jsonl", "part.20_25.jsonl"]
    assert [json.loads(x)["k"] for x in (tmp_path / "s" / "part.10_20.jsonl").read_text().splitlines()] == list(range(10, 20))
    assert sinks.write_shards(df.limit(0), f"file://{tmp_path}/e", ["k"], 10) == []
    sinks.write_ordered(df, f"file://{tmp_path}/o", ["k"])
    assert [json.loads(x)["k"] for p in sorted((tmp_path / "o").glob("part-*")) for x in p.read_text().splitlines()] == list(range(25))


def test_reports(spark, tmp_path):
    sinks.write_report(spark, f"file://{tmp_path}/r.json", {"数": [1, None]})
    assert json.loads((tmp_path / "r.json").read_text("utf-8")) == {"数": [1, None]} and "数" in (tmp_path / "r.json").read_text("utf-8")
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2)], "s string, t string, n int")
    assert sinks.figures(df, ["s", "t"]) == {"a": {"x": {"n": 1}, "None": {"n": 2}}}
    with pytest.raises(ValueError):
        sinks.figures(df, ["s"], most=1)
    with pytest.raises(ValueError):
        sinks.publish({"../x": df}, f"file://{tmp_path}/p")


def test_settings(tmp_path):
    (tmp_path / "a.yaml").write_text("target: 5\ndomain_weights: {d: 1.0}\nsource_weights: {d: {s: 1.0}}\n", "utf-8")
    s = config.Sampling.of(config.load(str(tmp_path / "a.yaml")))
    assert (s.target, s.seed, s.max_oversample) == (5, 42, 3.0)
    (tmp_path / "b.yaml").write_text("- 1\n", "utf-8")
    with pytest.raises(ValueError):
        config.load(str(tmp_path / "b.yaml"))
    with pytest.raises(ValueError):
        config.Sampling.of({"target": 1, "source_weights": {"x": {}}})
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "one.txt").write_text("﻿Ask {question}", "utf-8")
    assert config.templates(str(tmp_path / "t")) == {"one": "Ask {question}"}


def test_unpack(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("top/in/x.csv", "1")
    assert (tmp_path / "out" / "in" / "x.csv").exists() is False
    config.unpacked(str(tmp_path / "a.zip"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "in" / "x.csv").read_text() == "1" and config.unpacked("missing.zip", str(tmp_path / "out"))
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("../evil", "1")
    with pytest.raises(ValueError):
        config.unpacked(str(tmp_path / "b.zip"), str(tmp_path / "bad"))


def test_values(spark):
    df = spark.sql("select array(array(' a ', ''), array('b'), null) as a, true as b, map(1, timestamp '2020-01-02 03:04:05') as m, named_struct('x', cast(1.50 as decimal(5,2)), 'y', null) as s, cast(null as array<string>) as n, binary('hi') as z")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    got = df.select(*(values.to_text(F.col(c), kinds[c]).alias(c) for c in "abmsn")).first()
    assert tuple(got) == ("a | b", "True", '{"1":"2020-01-02 03:04:05"}', '{"x":"1.50"}', "")
    assert df.select(values.json_safe(F.col("z"), kinds["z"])).first()[0] == "aGk="


def test_execution(spark):
    raw = json.dumps({"raw_sample": {"qa": {"answer": "", "exe_ans": 7, "program": "add(3, 4)"}}})
    rows = [row(1, answer="add(3, 4)", reference="", metadata=raw), row(2, answer="subtract(add(9, 1), 3)", reference="7"), row(3, answer="power(1, 2)", reference="1"), row(4, answer="7.00001", reference="7"), row(5, reference=None), row(6, answer=" ", reference="x", metadata=None)]
    got = {r["id"]: r for r in execution.evaluated(spark.createDataFrame(rows, SAMPLE)).collect()}
    assert [got[f"r{i}"]["correct"] for i in range(1, 7)] == [True, True, False, True, False, False]
    assert [got[f"r{i}"]["executable"] for i in range(1, 7)] == [True, True, False, False, False, False] and got["r1"]["gold_program"] == "add(3, 4)"
    empty = execution.report(execution.evaluated(spark.createDataFrame([], SAMPLE)))
    assert tuple(empty.first()) == (0, 0.0, 0.0)


def test_distil(spark):
    rows = [row(1), row(2, split="test"), row(3, answer="a", reasoning="b"), row(4)]
    done = spark.createDataFrame([("r4", "old", "why"), ("r4", "", ""), ("zz", "x", "y")], "id string, model_answer string, model_reasoning string")
    ask = provider.MockProvider(fail_every=0, broken_every=0)
    got = {r["id"]: r for r in jobs.distil(spark.createDataFrame(rows, SAMPLE), ask, "m", done=done).collect()}
    assert got["r4"]["model_answer"] == "old" and got["r2"]["model_answer"] == "" and got["r3"]["model_answer"] == "a" and got["r3"]["distill"] is None
    assert got["r1"]["distill"]["parse_status"] == "success" and got["r1"]["model_answer"].isdigit() and len(got) == 4
    failed = jobs.distil(spark.createDataFrame([row(1)], SAMPLE), provider.MockProvider(fail_every=1), "m").first()
    assert failed["model_answer"] == "" and failed["distill"]["parse_status"] == "api_failed" and not failed["distill"]["api_success"]
    assert jobs.distil(spark.createDataFrame([], SAMPLE), ask, "m").count() == 0


def test_repairs_refuse_other_sources(spark):
    with pytest.raises(Exception, match="dialogue"):
        jobs.repaired(spark.createDataFrame([row(1, answer="5", reasoning="x")], SAMPLE), None).collect()
    r = jobs.repaired(spark.createDataFrame([row(1, "convfinqa", answer="", reasoning="x")], SAMPLE), provider.MockProvider(fail_every=0, broken_every=0)).first()
    assert r["route"] == "model" and r["repaired_answer"].isdigit()


class Handler(BaseHTTPRequestHandler):
    calls = 0

    def do_POST(self):
        Handler.calls += 1
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        if Handler.calls == 1:
            self.send_response(500)
            self.end_headers()
            self.wfile.write(b"try again")
            return
        self.send_response(200)
        self.end_headers()
        if "messages" in body:
            self.wfile.write(b'data: {"choices": [{"delta": {"content": "4"}}]}\n\ndata: {"choices": [{"delta": {"content": "2"}}]}\n\ndata: [DONE]\n')
        else:
            self.wfile.write(json.dumps({"output": [{"content": [{"type": "output_text", "text": "43"}]}]}).encode())

    def log_message(self, *a):
        pass


def test_http_provider_on_localhost():
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/v1"
    try:
        r = provider.HttpProvider(url, "k", "m", retries=1).generate("hi")
        assert (r.success, r.text, Handler.calls) == (True, "42", 2)
        assert provider.HttpProvider(url, "k", "m", effort="low").generate("hi").text == "43"
    finally:
        server.shutdown()
    assert not provider.HttpProvider(url, "k", "m", retries=0, timeout=1).generate("hi").success


def test_command_line_jobs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "all.json").write_text(json.dumps([{"instruction": f"do {i}", "input": "", "output": str(i)} for i in range(12)]), "utf-8")
    data = {"adapter": "instruction_json", "path": f"file://{tmp_path}/in", "source": "s", "task_type": "instruction", "task_domain": "d", "language": "en"}
    assert run(spark, "normalise", {"datasets": [data], "out": f"file://{tmp_path}/n"}) == [{"source": "s", "rows": 12}]
    with pytest.raises(KeyError):
        adapters.job({**data, "adapter": "none"})
    (tmp_path / "f" / "dev").mkdir(parents=True)
    (tmp_path / "f" / "dev" / "law.csv").write_text("id,question,A,B,answer\n1,\"a, b?\",x,,A\n", "utf-8")
    got = adapters.exam_folder(spark, f"file://{tmp_path}/f", Kind("exam", "mcq", "d", "zh"), ["id", "question", "A", "B", "answer"]).first()
    assert (got["id"], got["raw_split"], got["question"], got["options"]) == ("exam_dev_law_1", "dev", "a, b?", ["A. x"])
    refs = spark.createDataFrame([("s", "d", f"i{i}", "p", i) for i in range(10)], "source string, task_domain string, sample_id string, dataset_path string, line_number bigint")
    refs.write.parquet(f"file://{tmp_path}/refs")
    rep = run(spark, "manifest", {"refs": f"file://{tmp_path}/refs", "out": f"file://{tmp_path}/m", "target": 15, "domain_weights": {"d": 1.0}, "source_weights": {"d": {"s": 1.0}}})
    assert rep["draws"] == 15 and rep["pools"]["d"]["s"]["oversample_factor"] == 1.5
