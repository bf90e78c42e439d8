"""Same or near-same records across splits.

Evaluation records (val and test) are spread over *shards* of bounded size, each with a compressed full-text index (see
``fmindex``) of the shard's texts. Training texts are streamed through backward search: a text is cut into tiles, the suffix
range of each tile is found by stepping backwards from its last word, its occurrences are located through sampled positions
and grown to maximal matches on the index itself. Spans are merged and counted per pair of texts, and a pair is then compared
exactly in both fields. Records of equal word bags in both fields are joined directly.

What is indexed is the text of the longer field that tells records apart: the context, or the question where there is no
context. The other field must be alike as well and is compared exactly.

Not every training text is sent to every shard, which would be quadratic: it is routed to the shards that hold a text which
``neardup.link_classes`` cannot rule out (a common band key, and sketches within the distance that the likeness allows). A
route names the texts it is after. Tiles begin at WIDTHS[0] words; where one of those texts has no match yet, the search goes
on with shorter tiles, down to single words, so that no pattern of edits or moves hides it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import bags, neardup
from .fmindex import SLAB, FMIndex

#: Words of a tile, from the longest, in texts of letters and of CJK characters.
WIDTHS = ((4, 2, 1), (8, 4, 2, 1))
SEEDED, MATCHED = 0.2, 0.4  # texts that no route names are looked at too if they hold so much of the tiles, and matches cover so much of the shorter text
SHARD_CHARACTERS = 800_000
STREAM_ROWS = 20_000  # training texts that one task sends through a shard
STREAM_CHARACTERS = 100_000  # characters of training texts searched at once


def split_side(split: Column) -> Column:
    """train, val, test, or NULL for anything else."""
    s = F.lower(F.trim(split))
    return F.when(s.isin("train", "training"), "train").when(s.isin("val", "dev", "valid", "validation"), "val").when(s.isin("test", "test_gold"), "test")


def _tiles(size: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of tiles side by side, and one more at the end of a text that they do not fill."""
    n = -(-size // np.maximum(width, 1))
    own = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    return own, np.minimum(k * width[own], size[own] - width[own])


def matches(fm: FMIndex, seqs: list[np.ndarray], width: np.ndarray, wanted: set[int] = frozenset(), others: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, text of the index, words covered by maximal matches around tiles of so many words, number of such matches).

    wanted: pairs (sequence * texts + text) that are looked at whatever they share; others: whether pairs that have SEEDED of the
    sequence's tiles in common are looked at as well.
    """
    size = np.array([len(s) for s in seqs], dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    if not size.sum():
        return none, none, none, none
    width = np.minimum(width, size)
    flat, offset = np.concatenate(seqs), np.cumsum(size) - size
    own, at = _tiles(size, width)
    at = at + offset[own]
    lo, hi = fm.ranges(flat, at, width[own])
    live = np.nonzero(hi > lo)[0]
    per = np.cumsum(np.bincount(own[live], weights=hi[live] - lo[live], minlength=len(seqs)))  # occurrences up to the end of a sequence
    slab = (per // SLAB).astype(np.int64)[own[live]]
    got = []
    texts = len(fm.starts)
    only = np.array(sorted(wanted), dtype=np.int64)
    count = np.bincount(own, minlength=len(seqs))
    for part in np.split(live, np.nonzero(slab[1:] != slab[:-1])[0] + 1):
        n = hi[part] - lo[part]
        tile = np.repeat(part, n)
        row = np.repeat(lo[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pos = fm.locate(row)
        doc = fm.sequence(pos)
        pair = own[tile] * texts + doc
        ok = only[np.minimum(np.searchsorted(only, pair), len(only) - 1)] == pair if len(only) else np.zeros(len(pair), bool)
        if others and len(pair):
            _, inv, hits = np.unique(pair, return_inverse=True, return_counts=True)
            ok |= hits[inv] >= SEEDED * count[own[tile]]
        tile, row, pos, doc = tile[ok], row[ok], pos[ok], doc[ok]
        if not len(tile):
            continue
        # the seeds of one match that follow each other without a gap are grown once
        diag = pos - at[tile]
        order = np.lexsort((at[tile], diag, own[tile]))
        tile, row, doc, diag = tile[order], row[order], doc[order], diag[order]
        chain = np.ones(len(tile), dtype=bool)
        chain[1:] = (own[tile[1:]] != own[tile[:-1]]) | (diag[1:] != diag[:-1]) | (doc[1:] != doc[:-1]) | (at[tile[1:]] > at[tile[:-1]] + width[own[tile[:-1]]])
        head = np.nonzero(chain)[0]
        last = np.append(head[1:], len(tile)) - 1
        who = own[tile[head]]
        for w in np.unique(width[who]):  # seeds of one width at a time
            k = np.nonzero(width[who] == w)[0]
            a, b = tile[head[k]], tile[last[k]]
            left, _ = fm.grow(flat, row[head[k]], at[a], at[a] + w, offset[who[k]], at[a] + w)
            _, right = fm.grow(flat, row[last[k]], at[b], at[b] + w, at[b], offset[who[k]] + size[who[k]])
            got.append((who[k], doc[head[k]], left, right))
    if not got:
        return none, none, none, none
    own, doc, lo, hi = (np.concatenate(x) for x in zip(*got))
    return _merge(own, doc, lo, hi)


def _merge(own: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each pair merged over all diagonals: (sequence, text, words covered, number of spans)."""
    order = np.lexsort((lo, doc, own))
    own, doc, lo, hi = own[order], doc[order], lo[order], hi[order]
    pair = np.ones(len(own), dtype=bool)
    pair[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
    g = np.cumsum(pair) - 1
    big = int(hi.max()) + 1
    upto = np.maximum.accumulate(hi + g * big) - g * big  # furthest end so far within the pair
    before = np.where(pair, 0, np.concatenate([[0], upto[:-1]]))
    covered = np.maximum(0, hi - np.maximum(lo, before))
    runs = (pair | (lo > before)).astype(np.int64)
    first = np.nonzero(pair)[0]
    return own[first], doc[first], np.add.reduceat(covered, first), np.add.reduceat(runs, first)


class Shard:
    """Index of the evaluation texts of one shard: rows (cls, q, c)."""

    def __init__(self, rows: list[tuple]) -> None:
        self.cls = [r[0] for r in rows]
        self.hq, self.hc = ([bags.word_hashes(bags.words(r[k])) for r in rows] for k in (1, 2))
        texts: dict[tuple, list[int]] = {}
        for i, (x, y) in enumerate(zip(self.hq, self.hc)):
            texts.setdefault(tuple(y or x), []).append(i)
        self.text_of = {self.cls[i]: d for d, own in enumerate(texts.values()) for i in own}
        self.owners = list(texts.values())
        self.size = [len(k) for k in texts]
        self.words = {w: i + 2 for i, w in enumerate(sorted({w for k in texts for w in k}))}
        self.fm = FMIndex([np.array([self.words[w] for w in k], dtype=np.int64) for k in texts])

    def search(self, rows: list[tuple], threshold: float) -> list[tuple]:
        """(train_cls, eval_cls, matched, matches, like_q, like_c) of rows (cls, q, c, targets) alike in both fields."""
        tc = [bags.word_hashes(bags.words(r[2])) for r in rows]
        tq: dict[int, list[int]] = {}  # the questions of the texts that need them

        def question(i: int) -> list[int]:
            if i not in tq:
                tq[i] = bags.word_hashes(bags.words(rows[i][1]))
            return tq[i]

        key = [c or question(i) for i, c in enumerate(tc)]
        seqs = [np.array([self.words.get(w, self.fm.unknown) for w in k], dtype=np.int64) for k in key]
        kind = [int(len(k) > 0.55 * len(r[2] or r[1] or "")) for k, r in zip(key, rows)]  # nearly a word per character
        texts = len(self.owners)
        left = {i * texts + self.text_of[e] for i, r in enumerate(rows) for e in r[3] or () if e in self.text_of}
        out = []
        for level in range(max(map(len, WIDTHS))):
            who = sorted({p // texts for p in left}) if level else list(range(len(rows)))
            if not who:
                break
            width = np.array([WIDTHS[kind[i]][min(level, len(WIDTHS[kind[i]]) - 1)] for i in who], dtype=np.int64)
            at = {i: k for k, i in enumerate(who)}
            wanted = {at[p // texts] * texts + p % texts for p in left}
            own, doc, covered, runs = matches(self.fm, [seqs[i] for i in who], width, wanted, level == 0)
            for k, d, m, n in zip(own.tolist(), doc.tolist(), covered.tolist(), runs.tolist()):
                i = who[k]
                pair = i * texts + d
                if pair not in left and m < MATCHED * min(len(key[i]), self.size[d]):
                    continue
                left.discard(pair)
                for e in self.owners[d]:
                    x = bags.likeness(tc[i], self.hc[e])
                    if x < threshold:
                        break  # all owners of a text have the same words in this field, or none
                    y = bags.likeness(question(i), self.hq[e])
                    if y >= threshold and rows[i][0] != self.cls[e]:
                        out.append((rows[i][0], self.cls[e], m, n, y, x))
        return out


_OUT = "train_cls bigint, eval_cls bigint, matched int, matches int, like_q double, like_c double"


def _search(threshold: float):
    """Over rows (shard, salt, train, cls, targets, q, c) sorted by (shard, salt, train): the evaluation texts of a shard come
    first and are indexed, then training texts are streamed through."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None

        def stream(rows: list) -> pa.RecordBatch:
            out = index.search(rows, threshold)
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], ["train_cls", "eval_cls", "matched", "matches", "like_q", "like_c"])

        for batch in batches:
            todo, size = [], 0
            for shard, salt, train, cls, targets, q, c in zip(*(c.to_pylist() for c in batch.columns)):
                if (shard, salt) != at:
                    if todo:
                        yield stream(todo)
                        todo, size = [], 0
                    at, held, index = (shard, salt), [], None
                if not train:
                    held.append((cls, q, c))
                    continue
                if index is None:
                    index, held = Shard(held), []
                todo.append((cls, q, c, targets))
                size += len(q or "") + len(c or "")
                if size > STREAM_CHARACTERS:
                    yield stream(todo)
                    todo, size = [], 0
            if todo:
                yield stream(todo)

    return run


def overlaps(
    df: DataFrame, q: str = "question", c: str = "context", split: str = "split", id_col: str = "id", row_col: str = "row_id", threshold: float = neardup.THRESHOLD,
    shard_characters: int = SHARD_CHARACTERS, stream_rows: int = STREAM_ROWS, extra: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(matches, members).

    matches: (train_cls, eval_cls, matched, matches, like_q, like_c) of classes of records (equal word bags in both fields)
    of the training and an evaluation split whose two fields are alike; matched words and number of maximal matches are those
    of the indexed field. members: (id, cls, side, ...extra). Rows with a NULL id or of no split are ignored; rows that
    repeat an id count once. NULL and empty texts are alike. An empty df, or one without a split, gives no rows.
    """
    src = df.withColumn("side", split_side(F.col(split))).where("side is not null")
    fp = neardup.records(src, q, c, id_col, row_col, ["side", *(extra or [])], "side")
    members = fp.groupBy("id").agg(F.min_by(F.struct("cls", "side", *(extra or [])), "row").alias("x")).select("id", "x.*")
    n_chars = src.where("side <> 'train'").agg(F.sum(F.coalesce(F.length(q), F.lit(0)) + F.coalesce(F.length(c), F.lit(0))).alias("n")).first()["n"] or 0
    shards = max(1, -(-int(n_chars) // shard_characters))
    train = F.col("side") == "train"
    shard_of = lambda cls: F.pmod(F.xxhash64(F.lit(7), cls), F.lit(shards)).cast("int")
    links = neardup.link_classes(fp.where(F.size("bands") > 0).withColumn("train", train), threshold, sides="train")  # a in evaluation, b in train
    routes = materialise(links.groupBy(F.col("b").alias("cls"), shard_of("a").alias("shard")).agg(F.collect_list("a").alias("targets")))  # a shard's texts bound the list
    salts = routes.groupBy("shard").agg(F.ceil(F.count("*") / stream_rows).cast("int").alias("salts"))
    first = fp.groupBy("cls", train.alias("train")).agg(F.min("row").alias("row"), F.min("sizes").alias("sizes"))
    to_train = routes.join(salts, "shard").select("cls", "shard", F.pmod(F.xxhash64("cls"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("train"), "targets")
    to_eval = (
        first.where("not train").select("cls", shard_of("cls").alias("shard")).join(salts, "shard")
        .select("cls", "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("train"), F.lit(None).cast("array<bigint>").alias("targets"))
    )
    sent = materialise(to_train.unionByName(to_eval).join(first.drop("sizes"), ["cls", "train"]))
    rows = neardup.texts_of(src, q, c, row_col).join(sent.hint("merge"), "row").select("shard", "salt", "train", "cls", "targets", "q", "c")
    found = rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "train").mapInArrow(_search(threshold), _OUT)
    half = F.lit(1 << 32)
    words = F.when(F.pmod("sizes", half) > 0, F.pmod("sizes", half)).otherwise(F.floor(F.col("sizes") / half)).cast("int")
    same = first.groupBy("cls").agg(F.count("*").alias("n"), F.min("sizes").alias("sizes")).where("n = 2")
    equal = same.select(F.col("cls").alias("train_cls"), F.col("cls").alias("eval_cls"), words.alias("matched"), (words > 0).cast("int").alias("matches"), F.lit(1.0).alias("like_q"), F.lit(1.0).alias("like_c"))
    return found.unionByName(equal), members


def overlap_pairs(df: DataFrame, **kw) -> DataFrame:
    """(id_a, id_b), id_a < id_b: records alike in both fields, one in train and the other in val or test."""
    found, members = overlaps(df, **kw)
    members = materialise(members)
    t = members.where("side = 'train'").select(F.col("cls").alias("train_cls"), F.col("id").alias("it"))
    e = members.where("side <> 'train'").select(F.col("cls").alias("eval_cls"), F.col("id").alias("ie"))
    pairs = found.select("train_cls", "eval_cls").distinct().join(t, "train_cls").join(e, "eval_cls")
    return pairs.select(F.least("it", "ie").alias("id_a"), F.greatest("it", "ie").alias("id_b"))


def overlap_report(df: DataFrame, source: str = "source", **kw) -> DataFrame:
    """(split, source, records, overlapping, share): evaluation records, and those that also stand in train."""
    found, members = overlaps(df, extra=[source], **kw)
    hit = found.select(F.col("eval_cls").alias("cls")).distinct().withColumn("hit", F.lit(True))
    e = members.where("side <> 'train'").join(hit, "cls", "left")
    out = e.groupBy(F.col("side").alias("split"), F.col(source).alias("source")).agg(F.count("*").alias("records"), F.count("hit").alias("overlapping"))
    return out.withColumn("share", F.col("overlapping") / F.col("records"))
