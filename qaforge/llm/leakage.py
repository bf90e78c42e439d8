"""Evaluation texts leaking into training text.

Evaluation items are cut into windows of WINDOW words (CJK characters count as words, windows of them are longer; a shorter
item is one window of its own size), each with a 64-bit SimHash; together the windows of an item span it whole, so an item may
stand in a document as one run, in pieces, or with single words replaced. Every window of every document is fingerprinted in
the same way by running sums, and looked up in a multi-index of the items' fingerprints: four blocks of 16 bits, of which at
least one is equal whenever the distance is at most RADIUS = 3. A document and item with a window in common are a candidate,
which is verified by the weighted share of the item's own shingles that the document holds. Weights fall with the number of different texts that
hold a shingle, so that disclaimers and stock phrases count next to nothing; copies of a text, reformatted ones included,
count once, so that a leak does not become a stock phrase by being copied.

The pass over the corpus carries the index of the items (a few hundred; BLOCK_ITEMS at a time); nothing of the corpus is
ever gathered but counts of the items' shingles. Texts are told apart by a hash of their words in order.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bags
from .bags import chunks as _chunks
from ..session import materialise

#: Words of a window and of a shingle, for texts of letters and of CJK characters.
WINDOW, SHINGLE = (6, 10), (3, 6)
STRIDE = 2  # between an item's windows; documents have one at each word
RADIUS = 3
STOCK_ITEMS = 0.02  # a window that more than this share of the items (and more than 5) hold is a stock phrase, no item's own wording
SHARE = 0.3  # weighted share from which a document repeats about half of an item
STOCK_SHARE, STOCK_WEIGHT = 0.1, 0.05  # shingles in so many texts have the smallest weight
BLOCK_ITEMS = 20_000
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,60}>")
U = np.uint64


def plain(text: str | None) -> str:
    """Text without tags and entities."""
    if not text:
        return ""
    if "<" in text:
        text = _TAG.sub(" ", text)
    return html.unescape(text) if "&" in text else text


def _hashes(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, words per text, and whether each word is a CJK character."""
    flat: list[int] = []
    cjk: list[bool] = []
    n = np.empty(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        ws = bags.words(plain(t))
        n[i] = len(ws)
        flat.extend(bags.word_hashes(ws))
        cjk.extend([False] * len(ws) if t and t.isascii() else [len(w) == 1 and w > "㏿" for w in ws])
    return np.array(flat, dtype=np.uint64), n, np.array(cjk, dtype=bool)


def _runs(n: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every run of w words that lies within one text, and the text."""
    end = np.cumsum(n)
    owner = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(owner))
    ok = at + w <= end[owner] if len(at) else np.zeros(0, bool)
    return at[ok], owner[ok]


def _shingles(h: np.ndarray, starts: np.ndarray, w: int) -> np.ndarray:
    out = np.zeros(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(w):
            out = (out + h[starts + k]) * U(0x9E3779B97F4A7C15 + 2 * k)
            out ^= out >> U(29)
    return out


def _window_sums(x: np.ndarray, w: int) -> np.ndarray:
    """Sums of w consecutive rows from each row, by sums of 1, 2, 4, ... rows; w at most 255."""
    m = len(x) - w + 1
    total, at, span = np.zeros((m, x.shape[1]), dtype=np.uint8), 0, 1
    while w:
        if w & 1:
            total += x[at : at + m]
            at += span
        w >>= 1
        if w:
            x = x[:-span] + x[span:]
            span *= 2
    return total


def window_prints(h: np.ndarray, starts: np.ndarray, w: int, size: int = 1 << 14) -> np.ndarray:
    """SimHash of the w words from each start (ascending), by running sums of the words' bits."""
    out = np.empty(len(starts), dtype=np.uint64)
    for a in range(0, len(starts), size):
        s = starts[a : a + size]
        lo, hi = int(s[0]), int(s[-1]) + w
        ones = _window_sums(np.unpackbits(h[lo:hi].view(np.uint8).reshape(-1, 8), axis=1), w)
        prints = np.packbits(ones > w // 2, axis=1).view(np.uint64).ravel()
        out[a : a + size] = prints[s - lo]
    return out


class MultiIndex:
    """Fingerprints by four blocks of 16 bits; finds all within distance 3 of a probe."""

    def __init__(self, prints: np.ndarray, item: np.ndarray) -> None:
        self.prints, self.item = prints, item
        self.blocks = []
        for b in range(4):
            v = ((prints >> U(16 * b)) & U(0xFFFF)).astype(np.int64)
            self.blocks.append((np.concatenate([[0], np.cumsum(np.bincount(v, minlength=1 << 16))]), np.argsort(v, kind="stable")))

    def probe(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe, item) of all fingerprints within RADIUS; repeats are possible."""
        found = []
        for b, (start, order) in enumerate(self.blocks):
            v = ((prints >> U(16 * b)) & U(0xFFFF)).astype(np.int64)
            count = start[v + 1] - start[v]
            hit = np.nonzero(count)[0]
            n = count[hit]
            who = np.repeat(hit, n)
            at = np.repeat(start[v[hit]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(hit) else np.zeros(0, np.int64)
            fp = order[at]
            near = np.bitwise_count(prints[who] ^ self.prints[fp]) <= RADIUS
            found.append((who[near], self.item[fp[near]]))
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


class Items:
    """Index of a block of items: window fingerprints by kind of text and size, own shingles and which items hold them."""

    def __init__(self, texts: list[str | None]) -> None:
        h, n, cjk = _hashes(texts)
        ends = np.cumsum(n)
        per = np.array([cjk[a:b].mean() > 0.5 if b > a else False for a, b in zip(ends - n, ends)], dtype=bool)
        self.count = len(texts)
        self.index: list[tuple[int, int, MultiIndex]] = []  # kind, size, fingerprints
        self.shingle_sizes: list[tuple[int, int]] = []
        sh, own = [], []
        for kind in (0, 1):
            mine = (per == bool(kind)) & (n > 0)
            for size in np.unique(np.minimum(n[mine], WINDOW[kind])).tolist():
                take = mine & (np.minimum(n, WINDOW[kind]) == size)
                starts, owner = _runs(n, size)
                rel = starts - (ends - n)[owner]
                keep = take[owner] & ((rel % STRIDE == 0) | (rel + size == n[owner]))
                starts, owner = starts[keep], owner[keep]
                u, inv = np.unique(window_prints(h, starts, size), return_inverse=True)
                pairs = np.unique(np.stack([inv, owner], 1), axis=0)
                many = (np.bincount(pairs[:, 0], minlength=len(u)) > max(5, STOCK_ITEMS * self.count))[pairs[:, 0]]
                # an item that would lose half of its windows keeps them all
                few = 2 * np.bincount(pairs[many, 1], minlength=self.count) >= np.bincount(pairs[:, 1], minlength=self.count)
                pairs = pairs[~many | few[pairs[:, 1]]]
                self.index.append((kind, size, MultiIndex(u[pairs[:, 0]], pairs[:, 1])))
            for size in np.unique(np.minimum(n[mine], SHINGLE[kind])).tolist():
                starts, owner = _runs(n, size)
                keep = (mine & (np.minimum(n, SHINGLE[kind]) == size))[owner]
                sh.append(_shingles(h, starts[keep], size))
                own.append(owner[keep])
                self.shingle_sizes.append((kind, size))
        sh, own = np.concatenate([np.zeros(0, np.uint64), *sh]), np.concatenate([np.zeros(0, np.int64), *own])
        self.known, idx = np.unique(sh, return_inverse=True)
        pairs = np.unique(np.stack([own, idx], 1), axis=0) if len(sh) else np.zeros((0, 2), np.int64)
        self.by_item = np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, self.count))) if self.count else []
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[(self.known >> U(42)).astype(np.int64)] = True

    def known_shingles(self, h: np.ndarray, n: np.ndarray, cjk_texts: np.ndarray, other_texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, number of the shingle) of all shingles of items, each once per text."""
        got = [np.zeros(0, np.int64)]
        for kind, size in self.shingle_sizes:
            starts, owner = _runs(n, size)
            ok = (other_texts, cjk_texts)[kind][owner]
            starts, owner = starts[ok], owner[ok]
            s = _shingles(h, starts, size)
            maybe = self.filter[(s >> U(42)).astype(np.int64)]
            s, owner = s[maybe], owner[maybe]
            at = np.minimum(np.searchsorted(self.known, s), max(len(self.known) - 1, 0))
            hit = self.known[at] == s if len(self.known) else np.zeros(0, bool)
            got.append(owner[hit] * len(self.known) + at[hit])
        key = np.unique(np.concatenate(got))
        m = max(len(self.known), 1)
        return key // m, key % m


_FOUND = "doc_id bigint, item int, shingle array<int>, text bigint"
EVERY = -1  # stands among the shingles of every text, to count the texts


def _text_keys(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hash of the words of each text in order."""
    at = (np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
    with np.errstate(over="ignore"):
        return bags.mix(bags.segment_sum(bags.mix(h ^ bags.mix(at)), n) + n.astype(np.uint64)).view(np.int64)


def _scan(items: Items):
    """Candidates (doc_id, item, shingles of the item), and for each different text (its key, all shingles of items); a text
    can come from several batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            seen: dict[int, list[int]] = {}
            out: list[tuple[int, int, list[int]]] = []
            for a, z in _chunks([texts], 1_000_000):
                h, n, cjk = _hashes(texts[a:z])
                if not len(h):
                    continue
                zh = bags.segment_sum(cjk.astype(np.int64), n)
                is_zh, other = zh > 0, n > zh
                text, shingle = items.known_shingles(h, n, is_zh, other)
                first = np.searchsorted(text, np.arange(z - a + 1))
                for d, key in enumerate(_text_keys(h, n).tolist()):
                    if key not in seen:
                        seen[key] = [EVERY, *shingle[first[d] : first[d + 1]].tolist()]
                pairs = []
                for kind, size, index in items.index:
                    take = (other, is_zh)[kind]
                    rows = np.nonzero(take)[0]
                    starts, owner = _runs(n[rows], size)
                    if len(starts):
                        own = h if len(rows) == len(n) else h[np.repeat(take, n)]
                        who, item = index.probe(window_prints(own, starts, size))
                        pairs.append(rows[owner[who]] * items.count + item)
                if not pairs:
                    continue
                for p in np.unique(np.concatenate(pairs)).tolist():
                    d, i = divmod(p, items.count)
                    own = items.by_item[i]
                    have = np.intersect1d(own, shingle[first[d] : first[d + 1]], assume_unique=True)
                    if len(have):
                        out.append((ids[a + d], i, have.tolist()))
            k = len(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out] + [None] * k, pa.int64()), pa.array([x[1] for x in out] + [None] * k, pa.int32()),
                    pa.array([x[2] for x in out] + list(seen.values()), pa.list_(pa.int32())), pa.array([None] * len(out) + list(seen), pa.int64()),
                ],
                ["doc_id", "item", "shingle", "text"],
            )

    return run


def _verify(weight: np.ndarray, total: np.ndarray, item_ids: list[int], share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, i, have in zip(*(c.to_pylist() for c in batch.columns)):
                s = float(weight[have].sum()) / total[i] if total[i] else 0.0
                if s >= share:
                    out.append((doc, item_ids[i], s))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["doc_id", "item_id", "share"])

    return run


def leaks(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, share): documents that repeat at least about half of an item's own wording, and what weighted share.

    docs: (doc_id, text); items: (item_id, text), of which the driver holds BLOCK_ITEMS at a time, with one pass over docs for
    each. NULL and blank texts hold nothing; an item of any length is found, one shorter than a window only as a whole. Empty
    tables give no rows. Whole texts are scanned.
    """
    rows = ((r["item_id"], r["text"]) for r in items.where("text is not null").select("item_id", "text").orderBy("item_id").toLocalIterator())
    src = docs.select(F.col("doc_id").cast("bigint"), "text")
    out = None
    while block := list(islice(rows, BLOCK_ITEMS)):
        index = Items([t for _, t in block])
        found = materialise(src.mapInArrow(_scan(index), _FOUND))
        df, n_texts = np.ones(max(len(index.known), 1)), 1
        texts = found.where("text is not null").dropDuplicates(["text"])
        for r in texts.select(F.explode("shingle").alias("s")).groupBy("s").agg(F.count("*").alias("n")).collect():  # one row per shingle of the items
            if r["s"] == EVERY:
                n_texts = r["n"]
            else:
                df[r["s"]] = r["n"]
        weight = np.maximum(STOCK_WEIGHT, np.log(n_texts / df) - math.log(1 / STOCK_SHARE))
        total = np.array([weight[s].sum() for s in index.by_item])
        hit = found.where("item is not null").select("doc_id", "item", "shingle")
        part = hit.mapInArrow(_verify(weight, total, [i for i, _ in block], share), "doc_id bigint, item_id bigint, share double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, share double")
    return out


def leaked_items(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(item_id, documents, largest_share), one row per item that leaked."""
    return leaks(docs, items, share).groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("share").alias("largest_share"))
