"""Sources, adapters and streams on small generated files."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from qaforge.operators import splits
from qaforge.sources import adapters, readers
from qaforge.sources.adapters import Kind
from qaforge.streaming import incremental

KIND = Kind("src", "reasoning", "domain", "en")


def dump(path, obj, bom=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(("﻿" if bom else "") + json.dumps(obj, ensure_ascii=False), encoding="utf-8")


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("id").collect()]


def test_table_text(spark, tmp_path):
    dump(tmp_path / "train.json", [
        {"id": "a", "pre_text": ["p1", "p2"], "post_text": [], "table": [["x", ""], ["y", "1"]], "qa": {"question": " Q ", "answer": "", "final_result": " ", "exe_ans": 0, "program": "add(1, 2)"}},
        {"pre_text": [], "post_text": ["é 金"], "table": [], "qa": {"question": "Q2", "answer": ["1", "2"]}},
    ], bom=True)
    dump(tmp_path / "dev.json", [])
    got = rows(adapters.table_text_qa(spark, str(tmp_path), KIND), "id", "raw_split", "question", "context", "reference_answer")
    assert got == [("a", "train", "Q", "p1\np2\n\nx | \ny | 1", "0"), ("src_train_1", "train", "Q2", "é 金", "1 | 2")]
    meta = json.loads(adapters.table_text_qa(spark, str(tmp_path), KIND).where("id = 'a'").first()["metadata"])
    assert meta["program"] == "add(1, 2)" and meta["gold_answer_info"]["execution_answer"] == "0"


def test_dialogue(spark, tmp_path):
    turns = {f"qa_{i}": {"question": f"q{i}", "answer": f"a{i}", "exe_ans": i} for i in range(12)}
    dump(tmp_path / "dev_turn.json", [
        {"id": "c_2", "table": [["t"]], "annotation": {"answer_list_2": ["s1", "s2"]}, **turns}, {"id": "c_11", "table_ori": [["o"]], "table": [["t"]], **turns}, {"id": "c_99", **turns},
        {"id": "d", "qa": {"question": "plain", "answer": "z"}, "qa_0": turns["qa_0"]},
    ])
    df = adapters.dialogue_qa(spark, str(tmp_path), KIND)
    got = {r["id"]: r for r in df.collect()}
    assert got["c_2"]["question"] == "q2" and got["c_2"]["context"] == "t\n\nqa_0 question: q0\nqa_0 answer: a0\nqa_1 question: q1\nqa_1 answer: a1"
    assert got["c_11"]["question"] == "q11" and got["c_11"]["context"].startswith("o\n\n") and got["c_11"]["context"].count("question") == 11
    assert got["c_99"]["question"] == "q11" and got["d"]["question"] == "plain" and got["d"]["context"] == "qa_0 question: q0\nqa_0 answer: a0"
    assert json.loads(got["c_2"]["metadata"])["gold_answer_info"]["intermediate_answers"] == ["s1", "s2"] and got["d"]["raw_split"] == "dev"
    old = {r["id"]: r["context"] for r in adapters.dialogue_qa(spark, str(tmp_path), KIND, compat=True).collect()}
    assert old["c_11"].count("question") == 2 and old["c_2"] == got["c_2"]["context"]  # "qa_2" >= "qa_11" as text


def test_table_paragraph(spark, tmp_path):
    dump(tmp_path / "set_train.json", [{"table": {"uid": "t1", "table": [["a", "b"]]}, "paragraphs": [{"text": "p"}, {"text": ""}], "questions": [{"uid": "u1", "question": "q", "answer": ["1", "2"], "answer_type": "span", "scale": "million"}, {"question": "r", "answer": 5.5}]}, {"table": {"table": []}, "paragraphs": [], "questions": []}])
    got = rows(adapters.table_paragraph_qa(spark, str(tmp_path), KIND, prefix="set_"), "id", "raw_split", "context", "reference_answer")
    assert got == [("src_train_0_1", "train", "p\n\n\na | b".replace("\n\n\n", "\n\n"), "5.5"), ("u1", "train", "p\n\na | b", "1 | 2")]


def test_exam_csv_and_zip(spark, tmp_path):
    body = 'Question,A,B,Answer\n'
    (tmp_path / "csv" / "dev").mkdir(parents=True)
    (tmp_path / "csv" / "dev" / "tax.csv").write_text("﻿," + body + '7,"q, ""x""\nline",one,,A\n,第二,甲,乙,B\n', encoding="utf-8")
    got = rows(adapters.exam_csv(spark, str(tmp_path / "csv"), KIND, ["", "Question", "A", "B", "Answer"]), "id", "question", "options", "reference_answer")
    assert got == [("src_dev_tax_1", "第二", ["A. 甲", "B. 乙"], "B"), ("src_dev_tax_7", 'q, "x"\nline', ["A. one"], "A")]
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("val/law.csv", "id,question,A,B,answer\n3,q,x,y,B\n,r,x,,A\n")
    got = rows(adapters.exam_zip(spark, str(tmp_path / "e.zip"), KIND, ["id", "question", "A", "B", "answer"]), "id", "raw_split", "reference_answer")
    assert got == [("src_val_law_1", "val", "A"), ("src_val_law_3", "val", "B")]


def test_instructions(spark, tmp_path):
    spark.createDataFrame([("i", "x", "o", "FINNA")], "instruction string, input string, output string, task string").coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet"))
    (tmp_path / "data").mkdir()
    part.rename(tmp_path / "data" / "train-0001.parquet")
    got = rows(adapters.instruction_parquet(spark, str(tmp_path / "data"), KIND), "id", "raw_split", "question", "context", "reference_answer")
    assert got == [("src_train_0", "train", "i", "x", "o")]
    dump(tmp_path / "a.json", [{"instruction": "i", "input": "", "output": "o"}])
    assert rows(adapters.instruction_json(spark, str(tmp_path / "a.json"), KIND), "id", "context") == [("src_train_0", "")]


def test_labelled_lines(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("d/Sentences_AllAgree.txt", "a@b c@positive\nno label\nÄ up@neutral\n".encode("iso-8859-1"))
        z.writestr("__MACOSX/Sentences_x.txt", b"x@y")
        z.writestr("d/README.txt", b"x@y")
    df = adapters.labelled_lines(spark, str(tmp_path / "s.zip"), KIND, "Which?", ["negative", "neutral", "positive"])
    assert rows(df, "id", "context", "reference_answer", "raw_split") == [("src_all_0", "a@b c", "positive", ""), ("src_all_2", "Ä up", "neutral", "")]
    assert adapters.normalise(spark, [lambda s: df, lambda s: df]).count() == 4


def test_json_lines_shards_and_cache(spark, tmp_path):
    (tmp_path / "keep.0_2.jsonl").write_text('﻿{"id": "a", "n": 1}\n\n{"id": "b", "n": 2}\n', encoding="utf-8")
    (tmp_path / "keep.2_10.jsonl").write_text('{"id": "a", "n": 3}\n', encoding="utf-8")
    s = readers.shards(spark, str(tmp_path)).orderBy("shard_start", "shard_end", "file_name", "block_start", "row_index")
    assert [json.loads(r["value"])["n"] for r in s.collect()] == [1, 2, 3]
    assert {r["id"]: json.loads(r["value"])["n"] for r in readers.last_by_id(readers.json_lines(spark, str(tmp_path))).collect()} == {"a": 3, "b": 2}
    assert sorted((r["id"], r["n"], r["zz"]) for r in readers.json_lines(spark, str(tmp_path), "id string, n int, zz string").collect()) == [("a", 1, None), ("a", 3, None), ("b", 2, None)]
    (tmp_path / "other.jsonl").write_text("{}\n")
    with pytest.raises(Exception, match="not a shard"):
        readers.shards(spark, str(tmp_path)).collect()


def test_file_listing(spark, tmp_path):
    (tmp_path / "set1" / "x").mkdir(parents=True)
    (tmp_path / "set1" / "x" / "f.txt").write_text("12345")
    got = readers.file_listing(spark, str(tmp_path)).collect()
    assert [(r["name"], r["length"]) for r in got] == [("set1", 5)]


def test_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z"), ("a", "x")], "id string, source string").withColumn("ingested_at", F.lit("2025-01-01").cast("timestamp")).write.parquet(src)
    stream = incremental.first_deliveries(incremental.arriving(spark, src, spark.read.parquet(src).schema))
    q = incremental.run_batches(stream, lambda df: df.withColumn("split", splits.canonical(F.lit("dev"))), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    q = incremental.run_batches(stream, lambda df: df, str(tmp_path / "out2"), str(tmp_path / "cp"))
    q.awaitTermination(60)  # the checkpoint has seen all files
    w = incremental.windowed_counts(incremental.arriving(spark, src, spark.read.parquet(src).schema), ["source"])
    assert w.isStreaming
