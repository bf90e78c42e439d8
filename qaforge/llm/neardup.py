"""Near-duplicate records with small edits.

Two records belong together when both fields have a likeness (see ``bags.likeness``) of at least ``threshold``.

1. ``fingerprints``: a pass over the texts gives each row the key of its exact class (equal word bags), odd sketches of
   the first field and of both, the number of words of each and ``BANDS`` banded-minima keys of both fields. Rows of one class are collapsed.
2. ``link_classes``: a *shard* is the set of classes that share one band key. Each shard has a BK-tree over the sketches of
   its members' first field (children keyed by the integer Hamming distance to their parent, equal sketches in one node), and
   every member follows only the edges within its radius. The radius is not a guess: texts of the wanted likeness differ in
   at most (1 - threshold) * (a + b) words and their sketches in no more bits. It is small because that field is short; a tree
   over the long field prunes next to nothing. What a search returns must keep the same bound in the sketch of both fields. Shards above ``BLOCK`` members are cut into blocks, one task per pair of blocks.
3. ``verify``: exact likeness of both fields of the linked classes, on the texts, each sent once per pair of blocks of links.
4. ``expand``: links between classes and membership give the pairs of records; ``groups`` gives a row per record instead.

The only loss is that of the bands: texts of likeness exactly 0.85 share no key with probability 9e-4.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import bags, sketches
from .bags import chunks as _chunks
from .bktree import Forest

BLOCK = 8192
PAIRS = 1 << 20  # pairs held by a search before they are passed on
THRESHOLD = 0.85
LANES = (1, 3)  # 64-bit words of the sketch of the first field, and of that of both
_SKETCH = [f"s{k}" for k in range(sum(LANES))]
BLOCK_CHARACTERS, BLOCK_LINKS = 4_000_000, 50_000  # texts held, and links verified, by a pair of blocks, about
_HALF = 1 << 32


def _features(q: list, c: list):
    """Class keys of both fields, elements of the bag of each field and their numbers."""
    hq, nq = bags.hash_texts(q)
    hc, nc = bags.hash_texts(c)
    fq, fc = bags.bag_features(hq, nq, 1), bags.bag_features(hc, nc, 2)
    qk = bags.mix(bags.segment_sum(fq, nq) + nq.astype(np.uint64))
    ck = bags.mix(bags.segment_sum(fc, nc) + nc.astype(np.uint64))
    return qk, ck, fq, nq, fc, nc


def _fingerprint(apart: str | None, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            keep = [n for n in names if n not in ("_q", "_c")]
            q, c = batch.column(names.index("_q")).to_pylist(), batch.column(names.index("_c")).to_pylist()
            for a, z in _chunks([q, c], 600_000):
                qk, ck, fq, nq, fc, nc = _features(q[a:z], c[a:z])
                with np.errstate(over="ignore"):
                    cls = bags.mix(qk * np.uint64(3) + bags.mix(ck))
                # keys only for the first row of each class (and value of apart) in the batch
                of = cls
                if apart:
                    of = bags.mix(cls ^ np.array(bags.word_hashes([str(x) for x in batch.column(names.index(apart)).slice(a, z - a).to_pylist()]), dtype=np.uint64))
                first = np.zeros(z - a, dtype=bool)
                first[np.unique(of, return_index=True)[1]] = True
                fq, fc, mq, mc = fq[np.repeat(first, nq)], fc[np.repeat(first, nc)], nq[first], nc[first]
                none = np.nonzero(mq + mc == 0)[0]
                owner = np.concatenate([np.repeat(np.arange(len(mq)), mq), np.repeat(np.arange(len(mc)), mc), none])
                f = np.concatenate([fq, fc, np.full(len(none), np.uint64(77))])[np.argsort(owner, kind="stable")]
                n = np.maximum(mq + mc, 1)
                prints = np.zeros((z - a, len(_SKETCH)), np.uint64)
                prints[first] = np.hstack([sketches.odd_sketch(fq, mq, LANES[0]), sketches.odd_sketch(f, n, LANES[1])])
                keys = sketches.band_keys(f, n, rows, bands)
                arrays = [batch.column(names.index(k)).slice(a, z - a) for k in keep]
                ends = np.concatenate([[0], np.cumsum(first) * bands]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel()))
                arrays += [pa.array(cls.view(np.int64)), pa.array(nq * _HALF + nc), *(pa.array(prints[:, k].copy().view(np.int64)) for k in range(len(_SKETCH))), lists]
                yield pa.RecordBatch.from_arrays(arrays, [*keep, "cls", "sizes", *_SKETCH, "bands"])

    return run


def fingerprints(df: DataFrame, q: str, c: str, keep: list[str], apart: str | None = None, bands: int = sketches.BANDS, rows: int = sketches.ROWS) -> DataFrame:
    """keep columns + cls (key of the class of equal word bags in both fields), sizes (words of both fields), sketch words,
    bands; one row per row of df.

    bands is empty for all but the first row of a class (and value of the column apart) in a batch, so that copies add next to
    nothing to what is shuffled. NULL texts count as empty.
    """
    src = df.select(*keep, F.col(q).alias("_q"), F.col(c).alias("_c"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name not in ("_q", "_c"))
    words = ", ".join(f"{s} bigint" for s in _SKETCH)
    return src.mapInArrow(_fingerprint(apart, bands, rows), f"{kept}, cls bigint, sizes bigint, {words}, bands array<bigint>")


class Members:
    """Rows (key, rep, role, sizes, sketch words) of shards as arrays. role: 0 for both, 1 only looked up, 2 only looking."""

    def __init__(self, key, rep, role, sizes, prints) -> None:
        self.key, self.rep, self.role, self.sizes, self.prints = key, rep, role, sizes, prints

    @staticmethod
    def of(batch: pa.RecordBatch) -> Members:
        col = lambda k: batch.column(k).to_numpy(zero_copy_only=False)
        prints = np.stack([col(s).view(np.uint64) for s in _SKETCH], 1) if batch.num_rows else np.zeros((0, len(_SKETCH)), np.uint64)
        return Members(col("key"), col("rep"), col("role").astype(np.int8), col("sizes"), prints)

    @staticmethod
    def join(parts: list[Members]) -> Members:
        return parts[0] if len(parts) == 1 else Members(*(np.concatenate([getattr(p, a) for p in parts]) for a in ("key", "rep", "role", "sizes", "prints")))

    def take(self, at) -> Members:
        return Members(self.key[at], self.rep[at], self.role[at], self.sizes[at], self.prints[at])

    def __len__(self) -> int:
        return len(self.key)


def search(m: Members, shard: np.ndarray, differ: float, tree: np.ndarray, ask: np.ndarray, cross: bool = False, seen: list | None = None) -> Iterator[np.ndarray]:
    """Pairs (a, b) of different classes of a shard (numbers, ascending) whose fields may both be alike, in pieces of about PAIRS;
    differ = 1 - threshold. a < b, or with cross a is the class that was looking.

    tree and ask: which rows are held by the trees and which look them up. No pair of the wanted likeness is lost: the sizes
    of its fields and the distances of their sketches are bounded by the words in which the fields may differ.
    """
    t, a = np.nonzero(tree)[0], np.nonzero(ask)[0]
    both, own = slice(LANES[0], None), slice(0, LANES[0])
    forest = Forest(m.prints[t, own], shard[t])
    nq, nc = m.sizes // _HALF, m.sizes % _HALF
    n = nq + nc
    radius = np.floor(2 * differ / (1 - differ) * nq[a] + 1e-9).astype(np.int64)  # differ * (n + the most words of a partner)
    same = not cross and np.array_equal(tree, ask)  # then each pair is found from both sides
    out, held = [], 0
    for i, j in forest.within(m.prints[a, own], shard[a], radius):
        i, j = a[i], t[j]
        ok = m.rep[i] < m.rep[j] if same else m.rep[i] != m.rep[j]
        i, j = i[ok], j[ok]
        for size, lanes in ((n, both), (nq, own), (nc, None)):
            most = differ * (size[i] + size[j]) + 1e-9
            ok = np.abs(size[i] - size[j]) <= most
            if lanes:
                ok &= sketches.distance(m.prints[i, lanes], m.prints[j, lanes]) <= most
            i, j = i[ok], j[ok]
        if len(i):
            ab = np.stack([m.rep[i], m.rep[j]], 1)
            out.append(ab if cross or same else np.sort(ab, axis=1))
            held += len(i)
        if held > PAIRS:
            yield np.unique(np.concatenate(out), axis=0)
            out, held = [], 0
    if out:
        yield np.unique(np.concatenate(out), axis=0)
    if seen is not None:
        seen.append((forest.visited, len(a), len(forest.item)))


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("role", pa.int32()), ("sizes", pa.int64()), *((s, pa.int64()) for s in _SKETCH), ("blk", pa.int32())])
PAIR = "a bigint, b bigint, key bigint, role int, sizes bigint, " + ", ".join(f"{s} bigint" for s in _SKETCH) + ", blk int"


def _table(n: int, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _PAIR], schema=_PAIR)


def _search_shards(differ: float, block: int, cross: bool, gather: int = 1 << 17):
    """Over rows (key, rep, role, sizes, sketch) sorted by (key, rep): links of shards up to block members; rows of larger
    shards as they are, with the number of their block, and one row (a, b, sizes NULL) per such shard with its number of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Members] = []
        big_key, big_n = None, 0  # a large shard that is being passed on

        def overflow(m: Members, at: int) -> pa.RecordBatch:
            blk = (at + np.arange(len(m))) // block
            return _table(len(m), a=m.rep, key=m.key, role=m.role, sizes=m.sizes, blk=blk, **{s: m.prints[:, k].copy().view(np.int64) for k, s in enumerate(_SKETCH)})

        def close(key: int, n: int) -> pa.RecordBatch:
            return _table(1, key=[key], blk=[-(-n // block)])

        def work(m: Members) -> Iterator[pa.RecordBatch]:
            """Whole shards only."""
            new = np.ones(len(m), dtype=bool)  # a class can come from several batches
            new[1:] = (m.key[1:] != m.key[:-1]) | (m.rep[1:] != m.rep[:-1]) | (m.role[1:] != m.role[:-1])
            m = m.take(new)
            edge = np.nonzero(m.key[1:] != m.key[:-1])[0] + 1
            size = np.diff(np.concatenate([[0], edge, [len(m)]]))
            shard = np.repeat(np.arange(len(size)), size)
            small = ((size > 1) & (size <= block))[shard]
            s = m.take(small)
            if len(s):
                for ab in search(s, shard[small], differ, s.role < 2, s.role != 1, cross):
                    yield _table(len(ab), a=ab[:, 0].copy(), b=ab[:, 1].copy())
            for i in np.nonzero(size > block)[0]:
                big = m.take(shard == i)
                yield overflow(big, 0)
                yield close(int(big.key[0]), len(big))

        for batch in batches:
            if not batch.num_rows:
                continue
            m = Members.of(batch)
            if big_key is not None:
                k = int((m.key == big_key).sum())  # a run at the start
                yield overflow(m.take(slice(0, k)), big_n)
                big_n += k
                m = m.take(slice(k, None))
                if not len(m):
                    continue
                yield close(big_key, big_n)
                big_key = None
            held.append(m)
            if sum(map(len, held)) < gather:
                continue
            m = Members.join(held)
            last = len(m) - int((m.key == m.key[-1]).sum())
            yield from work(m.take(slice(0, last)))
            rest = m.take(slice(last, None))
            held = [rest]
            if len(rest) > block:
                big_key, big_n, held = int(rest.key[0]), len(rest), []
                yield overflow(rest, 0)
        if big_key is not None:
            yield close(big_key, big_n)
        if held:
            yield from work(Members.join(held))

    return run


def _search_blocks(differ: float, cross: bool):
    """Over rows (key, i, j, blk, rep, role, sizes, sketch) sorted by (key, i, j, blk): links between blocks i and j, or within i = j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(part: pa.Table) -> Iterator[pa.RecordBatch]:
            part = part.combine_chunks().to_batches()[0]
            m = Members.of(part)
            blk, i, j = (part.column(c).to_numpy(zero_copy_only=False) for c in ("blk", "i", "j"))
            if cross:
                tree, ask = m.role == 1, m.role == 2
            else:
                tree, ask = blk == i, blk == j
            for ab in search(m, np.zeros(len(m), np.int64), differ, tree, ask, cross):
                yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy())], ["a", "b"])

        def groups(whole: bool) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            k = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")], 1)
            cut = np.concatenate([[0], np.nonzero((k[1:] != k[:-1]).any(axis=1))[0] + 1, [len(k)]])
            for a, z in zip(cut[:-1], cut[1:] if whole else cut[1:-1]):
                yield from work(t.slice(a, z - a))
            held[:] = [] if whole else t.slice(cut[-2]).combine_chunks().to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) > 4 * BLOCK:
                    yield from groups(False)
        if held:
            yield from groups(True)

    return run


def link_classes(fp: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, sides: str | None = None) -> DataFrame:
    """(a, b): classes that share a shard and whose sketches allow the likeness in both fields, each pair once, a < b.

    fp: (cls, sizes, sketch, bands) of ``fingerprints``. sides names a Boolean column of fp: then a is a class with it false and
    b one with it true, and other pairs are not looked for.
    """
    role = F.lit(0) if sides is None else F.when(F.col(sides), 2).otherwise(1)
    rows = fp.select(F.explode("bands").alias("key"), F.col("cls").alias("rep"), role.alias("role"), "sizes", *_SKETCH).repartition("key").sortWithinPartitions("key", "rep", "role")
    found = materialise(rows.mapInArrow(_search_shards(1 - threshold, block, sides is not None), PAIR))
    pair = (F.col("a"), F.col("b")) if sides is None else (F.col("b").alias("a"), F.col("a").alias("b"))
    links = found.where("key is null").select(*pair)
    many = found.where("key is not null and sizes is null").select("key", F.col("blk").alias("n"))
    big = found.where("key is not null and sizes is not null").select("key", "blk", F.col("a").alias("rep"), "role", "sizes", *_SKETCH).join(many, "key")
    pairs = big.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("key", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk", "rep", "role", "sizes", *_SKETCH)
    more = pairs.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "blk").mapInArrow(_search_blocks(1 - threshold, sides is not None), "a bigint, b bigint")
    return links.unionByName(more.select(*pair)).distinct()


def _verify(threshold: float):
    """Over rows (ga, gb, a, b, q, c) sorted by (ga, gb, a is NULL last): texts (b NULL) of a pair of blocks, then its links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, text, bag = None, {}, {}

        def words(cls: int, k: int) -> tuple[Counter, int]:
            got = bag.get((cls, k))
            if got is None:
                ws = bags.words(text[cls][k])
                got = bag[cls, k] = (Counter(ws), len(ws))
            return got

        for batch in batches:
            out = []
            for ga, gb, a, b, q, c in zip(*(c.to_pylist() for c in batch.columns)):
                if (ga, gb) != at:
                    at, text, bag = (ga, gb), {}, {}
                if b is None:
                    text[a] = (q, c)
                    continue
                x = bags.counted_likeness(*words(a, 0), *words(b, 0))
                if x < threshold:
                    continue
                y = bags.counted_likeness(*words(a, 1), *words(b, 1))
                if y >= threshold:
                    out.append((a, b, x, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))], ["a", "b", "like_q", "like_c"]
            )

    return run


def verify(links: DataFrame, rows: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, like_q, like_c) of the linked classes whose two fields are both alike.

    rows: (cls, row), the class of each row; texts: (row, q, c). Classes are spread over blocks, so many that a pair of
    them holds about BLOCK_CHARACTERS and, in a large group of copies, BLOCK_LINKS; links are grouped by the blocks of their two classes and each text goes to a group once, however many links it has there.
    Texts are shuffled to their classes at every size: nothing that grows with the data is broadcast.
    """
    need = links.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    first = materialise(rows.join(need, "cls", "left_semi").groupBy("cls").agg(F.min("row").alias("row")))
    t = materialise(texts.join(first.hint("merge"), "row").select("cls", "q", "c"))
    size = t.agg(F.sum(F.coalesce(F.length("q"), F.lit(0)) + F.coalesce(F.length("c"), F.lit(0))).alias("n")).first()["n"] or 0
    blocks = max(1 + 2 * int(size) // BLOCK_CHARACTERS, math.isqrt(links.count() // BLOCK_LINKS) + 1)
    block = lambda c: F.pmod(F.xxhash64(F.lit(5), c), F.lit(blocks)).cast("int")
    both = links.select(block("a").alias("ga"), block("b").alias("gb"), "a", "b")
    sent = both.select("ga", "gb", F.explode(F.array("a", "b")).alias("cls")).distinct().join(t, "cls").select("ga", "gb", F.col("cls").alias("a"), F.lit(None).cast("bigint").alias("b"), "q", "c")
    every = sent.unionByName(both.withColumn("q", F.lit(None).cast("string")).withColumn("c", F.lit(None).cast("string")))
    return every.repartition("ga", "gb").sortWithinPartitions("ga", "gb", F.col("b").asc_nulls_first(), "a").mapInArrow(_verify(threshold), "a bigint, b bigint, like_q double, like_c double")


def expand(links: DataFrame, members: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of records of linked classes and within a class. members: (cls, id)."""
    ma, mb = members.select(F.col("cls").alias("a"), F.col("id").alias("ia")), members.select(F.col("cls").alias("b"), F.col("id").alias("ib"))
    across = links.select("a", "b").join(ma, "a").join(mb, "b").select("ia", "ib")
    inside = ma.join(mb, F.col("a") == F.col("b")).where("ia < ib").select("ia", "ib")
    return across.unionByName(inside).select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))


def records(df: DataFrame, q: str = "question", c: str = "context", id_col: str = "id", row_col: str = "row_id", extra: list[str] | None = None, apart: str | None = None) -> DataFrame:
    """Fingerprints (id, row, ...extra, cls, sizes, sketch, bands) of all rows with an id, written once."""
    src = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(row_col).cast("bigint").alias("row"), *(extra or []), F.col(q).alias("q"), F.col(c).alias("c"))
    return materialise(fingerprints(src, "q", "c", ["id", "row", *(extra or [])], apart))


def texts_of(df: DataFrame, q: str = "question", c: str = "context", row_col: str = "row_id") -> DataFrame:
    return df.select(F.col(row_col).cast("bigint").alias("row"), F.col(q).alias("q"), F.col(c).alias("c"))


def near_duplicates(df: DataFrame, q: str = "question", c: str = "context", id_col: str = "id", row_col: str = "row_id", threshold: float = THRESHOLD, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(links between classes (a, b, like_q, like_c), members (id, cls)).

    A class is a set of records with equal word bags in both fields. Rows with a NULL id are no records; rows that repeat an
    id are the same record and count once, with the texts of the smallest row. NULL and empty texts are alike (likeness 1),
    an empty and a non-empty text are not (0). Other columns of df are ignored. An empty df gives empty results.
    """
    fp = records(df, q, c, id_col, row_col)
    members = fp.groupBy("id").agg(F.min_by("cls", "row").alias("cls"))
    links = materialise(link_classes(fp.where(F.size("bands") > 0), threshold, block))
    return verify(links, fp.select("cls", "row"), texts_of(df, q, c, row_col), threshold), members


def near_duplicate_pairs(df: DataFrame, **kw) -> DataFrame:
    """(id_a, id_b): all pairs of different records whose two fields are alike; see ``near_duplicates``."""
    links, members = near_duplicates(df, **kw)
    return expand(links, materialise(members))


def groups(df: DataFrame, **kw) -> DataFrame:
    """(id, cls, copies, links): a row per record with the key of its class, the other records of the class and the number of
    records of other classes that are alike. No pair of records is formed, so a group of any size costs its rows only."""
    links, members = near_duplicates(df, **kw)
    members = materialise(members)
    size = materialise(members.groupBy("cls").agg(F.count("*").alias("n")))
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(size.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    per = size.join(linked, "cls", "left").select("cls", (F.col("n") - 1).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"))
    return members.join(per, "cls").select("id", "cls", "copies", "links")
