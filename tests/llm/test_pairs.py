"""Near duplicates, overlap across splits and quota samples against brute force on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaforge.llm import bags, crosssplit, neardup, quota_sample, sketches, strata
from qaforge.llm.bktree import Forest
from qaforge.llm.fmindex import FMIndex

SCHEMA = "row_id bigint, id string, question string, context string, split string, source string, extra string"
WORDS = [f"w{i}" for i in range(400)]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, t, k):
    ws = t.split()
    for _ in range(k):
        i = rng.randrange(len(ws))
        ws[i] = rng.choice(WORDS)
    if k:
        j = rng.randrange(len(ws) - 1)
        ws[j], ws[j + 1] = ws[j + 1], ws[j]
    return " ".join(ws)


def corpus():
    rng = random.Random(3)
    rows, n = [], 0

    def add(q, c, split="train"):
        nonlocal n
        n += 1
        rows.append((n, f"r{n}", q, c, split, "s", "x"))

    for g in range(25):
        q, c = text(rng, 12), text(rng, 60)
        add(q, c, rng.choice(["train", "dev", "Test"]))
        for _ in range(rng.randrange(3)):
            add(edited(rng, q, rng.randrange(2)), edited(rng, c, rng.randrange(4)), rng.choice(["training", "val", "test_gold", None]))
    q = text(rng, 12)
    for _ in range(30):
        add(q, text(rng, 50))  # one question with many contexts: no cases
    add("", None), add(None, ""), add("...", " "), add("只有问题", None), add("只有问题。", ""), add("一 二 三", "四"), add(None, "上下文" * 2000), add(None, "上下文" * 2000)
    rows += [(900, "r1", rows[0][2], rows[0][3], rows[0][4], "s", "x"), (901, None, rows[0][2], rows[0][3], "train", "s", "x")]  # a re-delivery, a row without id
    return rows


def brute(rows, least=0.85):
    seen = {}
    for r in sorted(rows):
        if r[1] is not None:
            seen.setdefault(r[1], (bags.words(r[2]), bags.words(r[3]), r[4]))
    ids = sorted(seen)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if bags.likeness(seen[a][0], seen[b][0]) >= least and bags.likeness(seen[a][1], seen[b][1]) >= least}, seen


def test_words():
    assert bags.words("Ａ１,234.5 年报 x-y Ünï") == ["a12345", "年", "报", "x", "y", "ünï"] and bags.words(None) == [] and bags.words("。,") == []
    assert bags.likeness([], []) == 1 and bags.likeness(["a"], []) == 0 and bags.likeness(list("aab"), list("abb")) == pytest.approx(2 * 2 / 6)


def test_near_duplicates(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in neardup.near_duplicate_pairs(df).collect()}
    assert got == brute(rows)[0] and len(got) > 20


def test_one_large_group_of_edited_copies(spark):
    """A third of the rows are copies of one record, each edited in words that no other row holds."""
    rng = random.Random(12)
    q, c = text(rng, 24), text(rng, 96)
    rows = []
    for i in range(150):
        a, b = (q.split(), c.split()) if i % 3 == 0 else (text(rng, 24).split(), text(rng, 96).split())
        for ws, k in ((a, 1), (b, 7)) if i % 3 == 0 else ():
            for j in rng.sample(range(len(ws)), k):
                ws[j] = f"rare{i}x{j}"
        rows.append((i, f"r{i}", " ".join(a), " ".join(b), "train" if i % 2 else "test", "s", "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    want, seen = brute(rows)
    assert len(want) > 1000
    got = {tuple(r) for r in neardup.near_duplicate_pairs(df).collect()}
    assert got <= want and len(got) >= 0.98 * len(want)
    across = {p for p in want if (seen[p[0]][2] == "train") != (seen[p[1]][2] == "train")}
    got = {tuple(r) for r in crosssplit.overlap_pairs(df, shard_characters=2000).collect()}
    assert got <= across and len(got) >= 0.98 * len(across)


def test_near_duplicates_in_blocks(spark):
    """Shards of more members than a block give the same links as small ones."""
    base = text(random.Random(1), 40)
    rows = [(i, f"r{i:03d}", "one and the same question", edited(random.Random(i), base, 1) if i % 3 else base + f" v{i}", "train", "s", "x") for i in range(60)]
    rows += [(100 + i, f"s{i:03d}", text(random.Random(i), 8), text(random.Random(-i), 40), "train", "s", "x") for i in range(120)]  # a third is one group
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)[0]
    got = {tuple(r) for r in neardup.near_duplicate_pairs(df, block=7).collect()}
    assert got == want and len(got) > 1700
    count = {}
    for a, b in want:
        count[a], count[b] = count.get(a, 0) + 1, count.get(b, 0) + 1
    got = {r["id"]: r["copies"] + r["links"] for r in neardup.groups(df).collect()}
    assert {k: v for k, v in got.items() if v} == count and len(got) == 180


def test_verify_in_many_blocks_and_by_shuffle(spark, monkeypatch):
    """Links spread over several blocks of texts, and class texts joined by shuffle instead of a broadcast, give the same pairs."""
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(neardup, "BLOCK_CHARACTERS", 900)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {tuple(r) for r in neardup.near_duplicate_pairs(df).collect()} == brute(rows)[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert neardup.near_duplicate_pairs(df).count() == 0 and crosssplit.overlap_pairs(df).count() == 0 and crosssplit.overlap_report(df).count() == 0


def test_forest(monkeypatch):
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 2**63, (400, 2), dtype=np.uint64)
    prints[300:] = prints[:100] ^ (np.uint64(1) << rng.integers(0, 63, (100, 1), dtype=np.uint64))
    prints[50:60] = prints[40]  # equal prints share a node
    shard = np.sort(rng.integers(0, 5, 400))
    forest = Forest(prints, shard)
    radius = rng.integers(0, 50, 400)
    got = {(q, i) for qs, items in forest.within(prints, shard, radius) for q, i in zip(qs.tolist(), items.tolist())}
    d = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2, dtype=int)
    assert got == {(q, i) for q in range(400) for i in range(400) if shard[q] == shard[i] and d[q, i] <= radius[q]}
    assert list(Forest(prints[:0], shard[:0]).within(prints, shard, radius)) == []
    same = np.zeros((900, 1), np.uint64)  # all in one node, given back in pieces
    monkeypatch.setattr("qaforge.llm.bktree.FRONT", 1000)
    got = [(q, i) for qs, items in Forest(same, np.zeros(900, int)).within(same, np.zeros(900, int), np.zeros(900, int)) for q, i in zip(qs.tolist(), items.tolist())]
    assert len(got) == len(set(got)) == 900 * 900
    near = Forest(prints, np.zeros(400, np.int64))
    list(near.within(prints, np.zeros(400, np.int64), np.full(400, 3)))
    assert near.visited < 0.35 * 400 * 400  # a small radius leaves out most of a tree


def test_searches_leave_out_most_of_a_large_shard(monkeypatch):
    """Records of one filing: one context, many questions. A search looks at less than half of its shard."""
    rng = random.Random(14)
    c = text(rng, 120)
    q = [text(rng, rng.randrange(8, 16)) for _ in range(300)]
    q += [edited(rng, t, 1) for t in q[:40]] + q[:60]
    qk, ck, fq, nq, fc, nc = neardup._features(q, [c + f" v{i}" for i in range(len(q))])
    own = np.concatenate([np.repeat(np.arange(len(q)), nq), np.repeat(np.arange(len(q)), nc)])
    f = np.concatenate([fq, fc])[np.argsort(own, kind="stable")]
    m = neardup.Members(np.zeros(len(q), np.int64), np.arange(len(q)), np.zeros(len(q), np.int8), nq * (1 << 32) + nc, np.hstack([sketches.odd_sketch(fq, nq, 1), sketches.odd_sketch(f, nq + nc, 3)]))
    every, seen = np.ones(len(q), bool), []
    monkeypatch.setattr(neardup, "PAIRS", 20)
    got = {tuple(p) for ab in neardup.search(m, np.zeros(len(q), np.int64), 0.15, every, every, seen=seen) for p in ab.tolist()}
    bag = [bags.words(t) for t in q]
    assert {(a, b) for a in range(len(q)) for b in range(a + 1, len(q)) if bags.likeness(bag[a], bag[b]) >= 0.85} <= got
    visited, asked, nodes = seen[0]
    assert visited < 0.45 * asked * len(q) and nodes < len(q)


def test_odd_sketches_never_break_the_bound():
    rng = np.random.default_rng(7)
    for size in (3, 40, 900):
        a = bags.mix(rng.integers(0, 2**62, size, dtype=np.uint64))
        for differ in (0, 1, size // 3, size):
            b = np.concatenate([a[differ:], bags.mix(rng.integers(0, 2**62, differ, dtype=np.uint64))])
            s = sketches.odd_sketch(np.concatenate([a, b]), np.array([len(a), 0, len(b)]), 3)
            assert sketches.distance(s[:1], s[2:])[0] <= 2 * differ and not s[1].any()


def test_overlaps(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    pairs, seen = brute(rows)
    side = {i: {"train": "T", "training": "T"}.get((v[2] or "").strip().lower(), "E" if v[2] else None) for i, v in seen.items()}
    want = {p for p in pairs if {side[p[0]], side[p[1]]} == {"T", "E"}}
    assert {tuple(r) for r in crosssplit.overlap_pairs(df).collect()} == want and len(want) > 5
    assert {tuple(r) for r in crosssplit.overlap_pairs(df, shard_characters=500, stream_rows=2).collect()} == want


def test_fm_index():
    rng = np.random.default_rng(1)
    docs = [rng.integers(2, 12, rng.integers(5, 60)) for _ in range(20)]
    docs += [docs[3].copy(), np.zeros(0, np.int64)]
    fm = FMIndex(docs)
    flat = [w for d in docs for w in [*d.tolist(), 1]] + [0]
    for a, w in ((2, 3), (0, 1), (1, 4)):
        tile = docs[0][a : a + w]
        lo, hi = fm.ranges(docs[0], np.array([a]), np.array([w]))
        assert sorted(fm.locate(np.arange(lo[0], hi[0])).tolist()) == [i for i in range(len(flat) - w) if flat[i : i + w] == tile.tolist()]
    lo, hi = fm.ranges(np.array([fm.unknown, 3]), np.array([0]), np.array([2]))
    assert lo[0] == hi[0]
    # walks over the whole text in both directions
    row, back, seen = np.array([0]), [], []
    for _ in range(len(flat)):
        back.append(int(fm.before(row)[0]))
        row = fm.back(row, fm.before(row))
    for _ in range(len(flat)):
        word, row = fm.ahead(row)
        seen.append(int(word[0]))
    assert back[:-1][::-1] + [0] == flat and sorted(seen) == sorted(flat)
    same = FMIndex([docs[0]] * 200)
    assert same.nbytes < 0.25 * 8 * same.n  # repeats cost next to nothing


def test_maximal_matches():
    rng = np.random.default_rng(4)
    docs = [rng.integers(2, 5000, 40) for _ in range(30)]
    fm = FMIndex(docs)
    probe = np.concatenate([docs[3][5:25], [fm.unknown], docs[7][-15:], [fm.unknown], docs[7][:9]])
    own, doc, covered, runs = crosssplit.matches(fm, [probe, docs[9]], np.array([4, 4]))
    got = {(o, d): (c, r) for o, d, c, r in zip(own.tolist(), doc.tolist(), covered.tolist(), runs.tolist())}
    assert got[0, 3] == (20, 1) and got[0, 7] == (24, 2) and got[1, 9] == (40, 1)


def zh(rng, n):
    return [chr(0x4E00 + rng.randrange(900)) for _ in range(n)]


def altered(rng, ws, likeness, how, word):
    """ws with as many edits, spread evenly, as the likeness allows."""
    n, out = len(ws), list(ws)
    k = int(n * (1 - likeness) + 1e-9)
    if how == "replace":
        for j in range(k):
            out[(2 * j + 1) * n // (2 * k)] = word(rng)
    elif how == "insert":
        k = int(2 * n * (1 - likeness) / likeness + 1e-9)
        for j in reversed(range(k)):
            out.insert((2 * j + 1) * n // (2 * k), word(rng))
    else:
        rng.shuffle(out)
        for j in range(k // 2):
            out[j] = word(rng)
    return out


@pytest.mark.parametrize("script", ["words", "zh"])
@pytest.mark.parametrize("how", ["replace", "insert", "shuffle"])
@pytest.mark.parametrize("likeness", [0.85, 0.9])
def test_no_edit_pattern_hides_a_routed_text(script, how, likeness):
    """Recall of the index search is 1 for every length from 2 words on, edits as hostile as the likeness allows."""
    rng = random.Random(8)
    word = (lambda r: "x" + str(r.randrange(10**6))) if script == "words" else (lambda r: chr(0x6E00 + r.randrange(900)))
    make = (lambda n: [rng.choice(WORDS) for _ in range(n)]) if script == "words" else (lambda n: zh(rng, n))
    glue = (" " if script == "words" else "").join
    sizes = [*range(2, 20), 25, 33, 40, 60, 90, 160, 300]
    base = [make(n) for n in sizes]
    shard = crosssplit.Shard([(k, "q", glue(t)) for k, t in enumerate(base)])
    asked = [altered(rng, t, likeness, how, word) for t in base]
    want = {(100 + k, k) for k, (a, b) in enumerate(zip(base, asked)) if bags.likeness(a, b) >= 0.85}
    got = shard.search([(100 + k, "q", glue(t), [k]) for k, t in enumerate(asked)], 0.85)
    assert {(t, e) for t, e, *_ in got if t == 100 + e} == want and len(want) > len(sizes) / 2


def test_hostile_texts_are_found_end_to_end(spark):
    """Short texts with a changed middle word, Chinese texts with a change in every eighth character, shuffled words."""
    rng = random.Random(21)
    w7, w40 = [f"a{i}" for i in range(7)], [f"b{i}" for i in range(40)]
    z15, z160 = zh(rng, 15), zh(rng, 160)
    other = list(w40)
    rng.shuffle(other)
    pairs = [(" ".join(w7), " ".join([*w7[:3], "x", *w7[4:]])), (" ".join(w40), " ".join(other)), ("".join(z15), "".join([*z15[:7], "龘", *z15[8:]])), ("".join(z160), "".join("龘" if i % 8 == 4 else c for i, c in enumerate(z160)))]
    rows = [(2 * i + k, f"{i}{s}", "q", t[k], s, "src", "x") for i, t in enumerate(pairs) for k, s in enumerate(("train", "test"))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in crosssplit.overlap_pairs(df).collect()} == {(f"{i}test", f"{i}train") for i in range(4)}


def test_strata_take(spark):
    rows = [(s, i, float(1 + i % 3)) for s, n in (("a", 500), ("b", 7)) for i in range(n)] + [(None, 1, 1.0)]
    df = spark.createDataFrame(rows, "s string, i int, size double").withColumn("u", strata.uniform("s", "i"))
    b = spark.createDataFrame([("a", 100.0), ("b", 1000.0), ("zz", 5.0)], "s string, budget double")
    got = strata.take(df, b, ["s"], "u", "size", "i").toPandas()
    assert got[got.s == "a"]["size"].sum() <= 100 and got[got.s == "a"]["size"].sum() > 97 and len(got[got.s == "b"]) == 7
    n = strata.take(df, spark.createDataFrame([("a", 33.0)], "s string, budget double"), ["s"], "u", None, "i").count()
    assert n == 33


def test_swap_repair():
    counts = {frozenset({"a"}): 80, frozenset({"b"}): 15, frozenset({"a", "b"}): 5, frozenset(): 50}
    take = quota_sample.swap_repair(counts, {"a": 20.0, "b": 18.0}, {"a": 1, "b": 2}, 40)
    have = {c: sum(k for s, k in take.items() if c in s) for c in "ab"}
    assert sum(take.values()) == 40 and have == {"a": 20, "b": 18} and all(take[s] <= counts[s] for s in counts)
    assert sum(quota_sample.swap_repair(counts, {"c": 5.0}, {"c": 5}, 1000).values()) == 150


def test_quota_plan(spark):
    refs = spark.createDataFrame([(f"r{i}", ["A ", "b", None][i % 3], "x") for i in range(60)] + [("dangling", "a", "x"), ("r0", "a", "x"), (None, "a", "x")], "sample_id string, task_domain string, source string")
    qa = spark.createDataFrame([(f"r{i}", "MCQ" if i % 4 else None, "en") for i in range(70)], "id string, task_type string, language string")
    targets = spark.createDataFrame([(1, "task_domain", "a", 0.5, 3, 0.5), (1, "task_domain", "zz", 0.5, 3, 0.5), (2, "language", "en", 1.0, 1, 0.2)], "request_id int, field_name string, category string, target_share double, min_rows int, sample_share double")
    drawn, report = quota_sample.plan(refs, qa, targets)
    got = {(r["request_id"], r["category"]): r for r in report.collect()}
    assert got[1, "a"]["pool_rows"] == 20 and got[1, "a"]["drawn_rows"] >= 15 and got[1, "a"]["reachable"] and not got[1, "zz"]["reachable"]
    n = {r["request_id"]: r["count"] for r in drawn.groupBy("request_id").count().collect()}
    assert n == {1: 30, 2: 12} and drawn.distinct().count() == 42
    empty, rep = quota_sample.plan(refs.limit(0), qa, targets)
    assert empty.count() == 0 and all(r["pool_rows"] == 0 for r in rep.collect())


def test_release(spark):
    from qaforge import session

    df = session.materialise(spark.range(5).toDF("x"))
    assert df.count() == 5
    session.release(spark)
    with pytest.raises(Exception):
        df.count()
