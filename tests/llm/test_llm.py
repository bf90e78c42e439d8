"""Operators of the llm subpackage on small fixtures, against brute force and planted cases."""

import glob
import os
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from qaforge.llm import bags, catalog, langid, leakage, mixing, pairs, truncation

QA = "id string, source string, question string, model_reasoning string, model_answer string, extra int"


@pytest.mark.parametrize(
    "text,want",
    [
        (None, truncation.EMPTY), (" \n", truncation.EMPTY), ("All done.", truncation.CLOSED), ("The rate is 5 percent of the", truncation.WHOLE), ("First it fell. Then the rate of the", truncation.OPEN),
        ("It fell. Then it\n[TRUNCATED]", truncation.MARK), ("It fell. Then it…", truncation.MARK), ("It fell. Then it ...[output truncated", truncation.MARK), ("先看第一行。再看第二�", truncation.MARK),
        ("It fell.\n[TRUNCATED]", truncation.CLOSED), ("41,569", truncation.WHOLE), ("positive", truncation.WHOLE), ("5\nConclusion: 5", truncation.WHOLE), ("All is well here so far.\nConclusion: 5", truncation.LINE), ("理由充分。\n结论:收购", truncation.LINE),
        ("理由充分。因此选择 选项C", truncation.LINE), ("Key points:\n- a: $5\n- b: $6", truncation.LINE), ('{"reasoning": "a. b', truncation.OPEN), ('{"a": "b."}', truncation.CLOSED), ("1 | 2 | net income", truncation.WHOLE),
        ("先看第一行,再看第二行,最后看第三", truncation.WHOLE), ("先看。再看第二行,最后看第三", truncation.OPEN), ("(B)", truncation.WHOLE), ("One column was [TRUNCATED] here.", truncation.CLOSED),
    ],
)
def test_ending(text, want):
    assert truncation.ending(text) == want


def test_ending_of_copies():
    q = "Which of the two components, taken together, make up most of the income?"
    assert truncation.ending(q.lower().rstrip("?"), q) == truncation.WHOLE and truncation.ending(q + "\nAnswer:", q) == truncation.WHOLE


def test_censored_fit():
    rng = np.random.default_rng(2)
    x = rng.normal(5.0, 0.5, 20000)
    cut = x > 5.3
    mu, sd = truncation.censored_lognormal(x[~cut], np.ones((~cut).sum()), np.full(cut.sum(), 5.3), np.ones(cut.sum()))
    assert abs(mu - 5.0) < 0.03 and abs(sd - 0.5) < 0.03


def test_limit_raises_prior():
    rows = [("s", "f", n, truncation.CLOSED, 10) for n in range(100, 600, 5)] + [("s", "f", 600, truncation.OPEN, 80), ("s", "f", 333, truncation.OPEN, 1)]
    fit = truncation.fit_lengths(pd.DataFrame(rows, columns=["source", "field_name", "length", "ending", "n"])).set_index("at").prior
    assert fit[600] > fit[300] + 2


def _fit(rows, **kw):
    h = pd.DataFrame(rows, columns=["length", "ending"]).value_counts().rename("n").reset_index()
    fit = truncation.fit_lengths(h.assign(source="s", field_name="f"), **kw)
    return {(a, e): p for a, e, p in zip(fit["at"], fit["ending"], fit["post"])}


def test_the_limit_decides_lines_and_open_ends():
    """Without the limit both verdicts change: the fit decides, not the form of the ending."""
    rng = np.random.default_rng(3)
    closed = [(int(x), truncation.CLOSED) for x in np.exp(rng.normal(5, 0.4, 2000))]
    lines = closed + [(int(x), truncation.LINE) for x in np.exp(rng.normal(5, 0.4, 600))] + [(160, truncation.LINE)] * 80
    assert _fit(lines)[160, truncation.LINE] > 0.5 > _fit(lines, limits=False)[160, truncation.LINE]
    assert all(p < 0.5 for (a, e), p in _fit(lines).items() if e == truncation.LINE and a != 160)
    # a source whose whole values often have no stop
    loose = closed[:400] + [(int(x), truncation.OPEN) for x in np.exp(rng.normal(5, 0.4, 1600))] + [(170, truncation.OPEN)] * 150
    got = _fit(loose)
    assert got[170, truncation.OPEN] > 0.5 > _fit(loose, limits=False)[170, truncation.OPEN]
    assert np.mean([got[x, e] < 0.5 for x, e in loose if e == truncation.OPEN and x != 170 and 140 < x < 240]) > 0.98  # of usual lengths
    # a source whose values end with a stop: open ends are cut wherever they fall, marks too
    usual = closed + [(111, truncation.OPEN), (133, truncation.OPEN), (97, truncation.MARK), (140, truncation.DOUBT)]
    got = _fit(usual)
    assert got[111, truncation.OPEN] > 0.9 and got[97, truncation.MARK] > 0.9 and got[140, truncation.DOUBT] < 0.5 and got[closed[0]] == 0


def test_cut_values(spark):
    whole = "The first part is fine. The second part is fine as well."
    rows = [(f"w{i}", "s", "q?", whole + " And more of it." * (i % 7), "5", 1) for i in range(60)]
    rows += [("c1", "s", "q?", whole[:40], "5", 1), ("c2", "s", "q?", None, whole[:45] + "…", 1), ("c2", "s", "q?", None, whole[:45] + "…", 1), ("t", None, None, None, None, 1), (None, "s", "q", whole[:40], "", 1), ("u", None, "q", whole[:40], "", 1)]
    df = spark.createDataFrame(rows, QA)
    assert {tuple(r) for r in truncation.cut_values(df).collect()} == {("c1", "model_reasoning"), ("c2", "model_answer"), ("u", "model_reasoning")}
    rep = {r["source"]: (r["records"], r["cut_records"]) for r in truncation.report(df).collect()}
    assert rep == {"s": (62, 2), "": (1, 1)} and truncation.cut_values(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", [None, "", " \n", "​", "。", "-", '""', "{}", "<final_answer></final_answer>", "Answer:", "答:", "null", "None", "NaN", "n/a", "...", '{"final_answer": ""}', "Final answer:"])
def test_empty_answers(text):
    assert pairs.is_empty(text)


@pytest.mark.parametrize("text", ["0", "no", "B", "收购", "否", "Answer: 5", "-5", "None of the above"])
def test_filled_answers(text):
    assert not pairs.is_empty(text)


def test_refusals():
    yes = ["I'm sorry, but I can't help with that request.", "抱歉,我无法回答这个问题。", "作为语言模型,我不能对此发表看法。", "Unfortunately I must decline to comment on Foo plc.", "As a language model, I do not answer this.", "根据使用规范,我拒绝完成此任务。", "这类内容我不能处理,请咨询董事会。"]
    no = ["The context does not state it, so the value cannot be determined.", "材料没有给出该值,因此无法确定。", "The firm declined to comment, but filings show a loss.", "As an AI chip supplier, Foo is unable to hedge fully.", "I'm sorry to hear about your loss. You can deduct it.", "I cannot stress enough that a reserve comes first.", "很遗憾,该公司毛利率下降5%。", "公司拒绝置评,但公告显示亏损。"]
    assert all(map(pairs.is_refusal, yes)) and not any(map(pairs.is_refusal, no))


def test_lcs():
    rng = random.Random(4)
    for _ in range(50):
        a, b = [rng.choice("abcd") for _ in range(rng.randrange(30))], [rng.choice("abcd") for _ in range(rng.randrange(30))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert pairs.lcs(a, b) == t[-1][-1]


def test_copies():
    q = "What was the percentage change in order backlog from 2017 to 2011?"
    assert pairs.copies_question("Question: " + q, q) and pairs.copies_question(q.replace("the", "teh"), q) and pairs.copies_question(q + "\nAnswer:", q)
    assert not pairs.copies_question("What was the percentage change - the answer is 5, i.e. $6 after higher freight costs of several regional units are taken into account", q) and not pairs.copies_question("5", q) and not pairs.copies_question("x y", None)


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_languages(model):
    en, zh, de = "What was the change in the order backlog of the group?", "材料中的公司预计何时完成交易?", "Die Anleihe wird mit zwei Prozent verzinst und läuft noch zehn Monate."

    def wrong(q, a, r):
        return pairs.wrong_language(q, a, *pairs.languages([q, a, r], model))

    assert wrong(en, "消极", None) and wrong(en, "5", de) and not wrong(en, "B", "The total of the group is given in the table.") and not wrong(zh, "Foo Holdings", "材料给出了金额。")
    assert not wrong("Please answer in German. " + en, de, "The text is in the passage of the note.") and wrong("Please answer in French. " + en, de, None) and wrong(zh, "收购", "The table of the group shows that it is so.")
    long = en + " The group reported orders of 5 million in its note on the year." * 12
    assert not wrong(long + " Please answer in German.", de, None) and wrong(long, de, None)  # a request holds wherever it stands
    assert pairs.languages([None, "", "5,000 | 7", "(B)", "Marfell Oyj"], model) == [None] * 5


def test_refusals_with_gaps_and_later_clauses():
    yes = ["Thank you for your question. I am sorry, but I cannot help with that request.", "I really cannot help with this request.", "Es tut mir leid, aber ich kann bei dieser Anfrage leider nicht helfen.", "Je suis désolé, mais je ne peux malheureusement pas répondre à cette question.",
           "Lo siento, pero no puedo ayudarle con eso.", "感谢您的提问。很抱歉,我无法回答这个问题。", "Hm. I cannot assist with questions of this type."]
    no = ["I can't see how that would help the firm.", "The loan is secured by the plant. The rate is fixed for ten years and the lender may not raise it. I cannot comment on the tax.", "The bank said it cannot provide a date. The plant opens in May.", "感谢您的提问。该公司毛利率为5%。"]
    assert all(map(pairs.is_refusal, yes)) and not any(map(pairs.is_refusal, no))


def test_defective_pairs(spark, model):
    q = "What was the change in the order backlog of the group?"
    rows = [("a", "s", q, "It is in the table.", "5", 1), ("b", "s", q, "x", None, 1), ("c", "s", q, None, None, 1), ("d", "s", q, "It is.", q, 1), ("e", "s", q, "It is.", "It rose. Then it fell to the", 1), ("e", "s", q, "It is.", "It rose. Then it fell to the", 1), ("f", "s", None, None, "5", 1), (None, "s", q, "x", "", 1)]
    got = {tuple(r) for r in pairs.defective_pairs(spark.createDataFrame(rows, QA), model).collect()}
    assert got == {("b", "empty_answer"), ("d", "copies_question"), ("e", "truncated_answer")}
    assert pairs.defective_pairs(spark.createDataFrame([], QA), model).count() == 0


def words(rng, n, stem="w"):
    return " ".join(f"{stem}{rng.randrange(3000)}" for _ in range(n))


def test_leaks(spark):
    rng = random.Random(6)
    stock = "amounts may not add up to totals because of rounding and prior figures have been restated where necessary"
    items = [(i, (stock + " " if i % 2 else "") + words(rng, 60)) for i in range(20)] + [(90, None), (91, "two words")]
    text = {i: t.split() for i, t in items if t}
    docs = [(i, words(rng, 150) + " " + stock) for i in range(40)]
    docs += [(100, "<p>" + words(rng, 30) + " " + " ".join(text[2][:40]) + "</p>"), (101, " ".join(text[4][5:22]).upper() + " " + words(rng, 50) + " " + " ".join(text[4][30:55])), (102, words(rng, 40) + " " + " ".join(text[6][:6])), (103, None), (104, " ")]
    replaced = list(text[8])
    for i in range(7, len(replaced), 14):
        replaced[i] = "other"
    docs += [(105, " ".join(replaced))]
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in leakage.leaks(d, e).collect()} == {(100, 2), (101, 4), (105, 8)}
    assert leakage.leaks(d.limit(0), e).count() == 0 and leakage.leaks(d, e.limit(0)).count() == 0
    assert {r["item_id"]: r["documents"] for r in leakage.leaked_items(d, e).collect()} == {2: 1, 4: 1, 8: 1}


def test_leaks_of_items_of_any_length(spark):
    """An item of six words is found in a document that is that item, and in running text; so are items of one window or less."""
    rng = random.Random(9)
    items = [(k, words(rng, k)) for k in (1, 2, 3, 4, 5, 6, 7, 9)] + [(50, "".join(chr(0x4E00 + rng.randrange(800)) for _ in range(8)))]
    filler = [(500 + i, words(rng, 80)) for i in range(60)]
    docs = [(i, t) for i, t in items] + [(100 + i, words(rng, 30) + " " + t + " " + words(rng, 30)) for i, t in items] + filler
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leakage.leaks(d, e).collect()}
    want = {(i + a, i) for i, _ in items for a in (0, 100)}
    assert want <= got and all(i == 1 for _, i in got - want)  # a single word stands in other texts as well


@pytest.mark.parametrize("density,least", [(0.05, 1.0), (0.1, 0.98), (0.15, 0.9)])
def test_leaks_with_replaced_words(spark, density, least):
    rng = random.Random(10)
    items = [(i, words(rng, 60)) for i in range(60)]
    docs = [(i, " ".join(f"z{rng.randrange(10**6)}" if rng.random() < density else w for w in t.split())) for i, t in items] + [(500 + i, words(rng, 80)) for i in range(100)]
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leakage.leaks(d, e).collect()}
    assert got <= {(i, i) for i, _ in items} and len(got) >= least * len(items)


def test_leak_in_many_copies(spark):
    """Half of an item in a document that a third of the rows repeat, some of them reformatted, is a leak in each of them."""
    rng = random.Random(16)
    stock = "amounts may not add up to totals because of rounding and prior figures have been restated where necessary"
    items = [(i, stock + " " + words(rng, 60)) for i in range(4)]
    leak = words(rng, 40) + ". " + " ".join(items[1][1].split()[-36:]) + ". " + words(rng, 20)
    docs = [(i, words(rng, 100) + " " + stock) for i in range(200)] + [(200 + i, (leak, f"<p>{leak}</p>", leak.upper().replace(" ", "  "))[i % 3]) for i in range(100)]
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in leakage.leaks(d, e).collect()} == {(200 + i, 1) for i in range(100)}


def test_window_prints_and_multi_index():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    starts = np.arange(290)
    fp = leakage.window_prints(h, starts, 8, size=37)
    for s in (0, 36, 37, 289):
        bits = np.unpackbits(h[s : s + 8].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0)
        assert fp[s] == np.packbits(2 * bits > 8).view(np.uint64)[0]
    index = leakage.MultiIndex(fp, np.arange(len(fp)))
    probes = fp[:50] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64)) ^ np.uint64(1 << 5)
    who, item = index.probe(probes)
    got = set(zip(who.tolist(), item.tolist()))
    assert got == {(i, j) for i in range(50) for j in range(len(fp)) if int(probes[i] ^ fp[j]).bit_count() <= 3}


def test_mix(spark):
    docs = [(i, s, "some words of a text " * (1 + i % 5)) for s, n in (("a", 300), ("b ", 20), ("C", 3)) for i in range(n)]
    docs = [(k, s, t) for k, (i, s, t) in enumerate(docs)] + [(9000, "a", None), (9001, None, "x y z"), (9002, "c", "")]
    d = spark.createDataFrame(docs, "doc_id bigint, source string, text string")
    t = spark.createDataFrame([(1, "a", 0.5, 1, 0.4), (1, "b", 0.4, 4, 0.4), (1, "c", 0.05, 2, 0.4), (1, "none", 0.05, 2, 0.4)], "mix_id int, source string, target_share double, max_repeats int, budget_share double")
    drawn, report = mixing.mix(d, t)
    rep, got = {r["source"]: r for r in report.collect()}, drawn.toPandas()
    assert rep["a"]["reachable"] and not rep["none"]["reachable"] and not rep["c"]["reachable"] and rep["none"]["source_tokens"] == 0
    for s, r in rep.items():
        own = got[got.source == s]
        assert (own.tokens * own.repeats).sum() == r["drawn_tokens"] <= max(r["wanted_tokens"], 0) + 1e-6 and (own.repeats <= r["max_repeats"]).all()
    assert rep["a"]["drawn_tokens"] > rep["a"]["wanted_tokens"] - 30 and abs(sum(r["actual_share"] for r in rep.values()) - 1) < 1e-9
    assert len(got) == len(got.drop_duplicates(["mix_id", "doc_id"])) and mixing.mix(d.limit(0), t)[0].count() == 0


SENTENCES = {
    "en": "The {} of the group rose to {} million after the sale of two plants in the north.", "de": "Der {} der Gruppe stieg nach dem Verkauf von zwei Werken im Norden auf {} Millionen.",
    "fr": "Le {} du groupe a atteint {} millions après la vente de deux usines dans le nord.", "es": "El {} del grupo llegó a {} millones tras la venta de dos plantas en el norte.",
    "pt": "O {} do grupo subiu para {} milhões após a venda de duas fábricas no norte.", "zh": "该集团的{}在出售北部两家工厂后升至{}万元。",
}


def language_docs():
    rng = random.Random(8)
    made = lambda k, n: ("" if k == "zh" else " ").join(SENTENCES[k].format(f"Xan{rng.randrange(99)}", rng.randrange(999)) for _ in range(n))
    rows = [(i, made(k, 6), k if i % 9 else rng.choice(list(SENTENCES))) for i, k in enumerate(list(SENTENCES) * 25)]
    return rows, made


def test_language_model():
    rows, made = language_docs()
    texts, labels = zip(*[(s, langid.LANGUAGES.index(k)) for _, t, k in rows for s in langid.sentences(t)])
    model = langid.train(list(texts), list(labels))
    p, _ = model.probabilities([made(k, 1) for k in langid.LANGUAGES])
    assert p.argmax(axis=1).tolist() == list(range(6)) and (model.weights == 0).mean() > 0.5


def test_unnamed_languages(spark):
    rows, made = language_docs()
    rows += [(900, made("en", 4) + "\n" + made("de", 3), "EN-us"), (901, made("en", 5) + " " + made("fr", 1), "eng"), (902, made("es", 4), None), (903, None, "en"), (904, " | 5 | 6\nx | 7", None), (905, "", "und"), (906, made("zh", 4) + "\n" + made("en", 3), "zho")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {(r["doc_id"], r["lang_found"]) for r in langid.unnamed_languages(df).collect()}
    assert {g for g in got if g[0] >= 900} == {(900, "de"), (902, "es"), (906, "en")}
    truth = {(i, k) for i, k in enumerate(list(SENTENCES) * 25)}
    assert {g for g in got if g[0] < 900} == {(i, k) for i, k in truth if rows[i][2] != k}
    assert langid.unnamed_languages(df.limit(0)).count() == 0
    lab = {r["doc_id"]: r["language"] for r in langid.labels(df).collect()}
    assert lab[902] == "es" and 903 not in lab and 904 not in lab


def test_sentences_beside_tables(spark):
    _, made = language_docs()
    table = " | 2017 | 2018\nnet income | 42,271 | 66\ncost of sales | 80,597 | 181.1"
    en, de, zh = made("en", 3), made("de", 3), made("zh", 3)
    for text, want in ((f"<p>{table}</p><p>{en}</p>", 3), (f"{en} {table}", 3), (f"{en} {table} {de}", 6), (f"{zh} {table}{zh}", 6), (f"{table}<br/>{de}", 3), (f"{en} net income | 5 | 6 {de} | 2017 | 2018 cost | 7", 6)):
        assert len(langid.sentences(text)) == want, text
    for text in (table, table.replace("\n", " "), "Issuer | Foo Holdings Inc.", "| The bank is not liable for it. | Die Bank haftet dafür in keinem Fall. |", "<table><tr><td>The bank is not liable for it.<td>Die Bank haftet nicht.<td></tr></table>"):
        assert langid.sentences(text) == [], text
    rows = language_docs()[0] + [(900, f"{en} {table} {de}", "en"), (901, f"<p>{table}</p><p>{en}</p>", "spa"), (902, f"{zh} {table}", None)]
    got = langid.unnamed_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).where("doc_id >= 900").collect()
    assert {tuple(r) for r in got} == {(900, "de"), (901, "en"), (902, "zh")}


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_against_sql(spark, small, sql, name):
    df = catalog.QUERIES[name](spark, small)
    cols = sorted(df.columns)
    cur = sql.execute(catalog.ORACLES[name])
    at = [[c[0] for c in cur.description].index(c) for c in cols]
    assert len(at) == len(cur.description) == len(cols)
    assert sorted(map(tuple, df.select(cols).collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)


def test_reports_agree_with_what_they_report(spark, small):
    run = lambda name: catalog.QUERIES[name](spark, small)
    cut = run("p2_found").toPandas()
    rep = run("p2_report").toPandas()
    assert rep.cut_records.sum() == cut.id.nunique() and (rep.cut_share == rep.cut_records / rep.records).all() and rep.source.is_unique
    found = run("p4_found").toPandas()
    assert found.id.is_unique and found.defect.value_counts().to_dict() == {r["defect"]: r["records"] for r in run("p4_report").collect()}
    assert set(found[found.defect == "truncated_answer"].id) <= set(cut[cut.field_name == "model_answer"].id)
    leaks = run("p6_found").toPandas()
    assert leaks.groupby("item_id").doc_id.nunique().to_dict() == {r["item_id"]: r["documents"] for r in run("p6_report").collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id").toPandas()
    labels = run("p8_labels").toPandas()
    assert labels.doc_id.is_unique and set(labels.doc_id) <= set(docs.doc_id) and labels.confidence.between(0, 1).all() and set(labels.language) <= set(langid.LANGUAGES)
    pairs_found, drawn = run("p8_found").toPandas(), run("p7_mix").toPandas()
    assert not pairs_found.duplicated().any() and not drawn.duplicated(["mix_id", "source", "doc_id"]).any() and (drawn.repeats > 0).all()
