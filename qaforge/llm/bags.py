"""Word bags of texts, as numpy arrays over whole batches.

Words: runs of letters and digits after compatibility folding and lower-casing; every CJK character is a word of its
own; punctuation and spacing separate words, except that a comma or point between two digits is dropped.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import xxhash

CJK = "㐀-䶿一-鿿豈-﫿"
_WORD = re.compile(rf"[{CJK}]|[^\W_{CJK}]+")
_NUM_SEP = re.compile(r"(\d)[.,](?=\d)")
_VOCAB_CAP = 200_000
_vocab: dict[str, int] = {}

U = np.uint64
_MIX1, _MIX2, _MIX3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def chunks(cols: list[list], size: int = 1_500_000) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about size characters."""
    a = total = 0
    for i, row in enumerate(zip(*cols)):
        total += sum(len(t) for t in row if t)
        if total >= size:
            yield a, i + 1
            a, total = i + 1, 0
    if cols and a < len(cols[0]):
        yield a, len(cols[0])


def words(text: str | None) -> list[str]:
    """The words of a text; [] for None and texts without letters or digits."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _WORD.findall(_NUM_SEP.sub(r"\1", text.lower()))


def word_hashes(ws: list[str]) -> list[int]:
    global _vocab
    if len(_vocab) > _VOCAB_CAP:
        _vocab = {}
    v = _vocab
    out = list(map(v.get, ws))
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                w = ws[i]
                out[i] = v[w] = xxhash.xxh64_intdigest(w)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, element by element."""
    with np.errstate(over="ignore"):
        x = x + _MIX1
        x = (x ^ (x >> U(30))) * _MIX2
        x = (x ^ (x >> U(27))) * _MIX3
        return x ^ (x >> U(31))


def hash_texts(texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one array, and the number of words of each text."""
    flat: list[int] = []
    n = np.empty(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        ws = words(t)
        n[i] = len(ws)
        flat.extend(word_hashes(ws))
    return np.array(flat, dtype=np.uint64), n


def occurrences(owner: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For each word, how many times the same word stands earlier in the same text."""
    if not len(h):
        return np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        key = mix(h + owner.astype(np.uint64) * _MIX2)
    order = np.argsort(key, kind="stable")
    k = key[order]
    start = np.ones(len(k), dtype=bool)
    start[1:] = k[1:] != k[:-1]
    idx = np.arange(len(k))
    first = np.maximum.accumulate(np.where(start, idx, 0))
    out = np.empty(len(k), dtype=np.int64)
    out[order] = idx - first
    return out


def bag_features(h: np.ndarray, n: np.ndarray, tag: int) -> np.ndarray:
    """Set elements that stand for a multiset of words: (word, how many before it, field)."""
    owner = np.repeat(np.arange(len(n)), n)
    occ = occurrences(owner, h)
    with np.errstate(over="ignore"):
        return mix(h ^ mix(occ.astype(np.uint64) * _MIX3 + U(tag)))


def segment_sum(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of x over consecutive segments of n elements; empty segments give 0."""
    with np.errstate(over="ignore"):
        c = np.concatenate([np.zeros(1, dtype=x.dtype), np.cumsum(x, dtype=x.dtype)])
    e = np.cumsum(n)
    with np.errstate(over="ignore"):
        return c[e] - c[e - n]


def likeness(a: list, b: list) -> float:
    """2 * common / (a + b) over words with multiplicity; two empty texts 1, an empty and a non-empty one 0."""
    return counted_likeness(Counter(a), len(a), Counter(b), len(b))


def counted_likeness(a: Counter, na: int, b: Counter, nb: int) -> float:
    """``likeness`` of bags that are counted already."""
    if not na or not nb:
        return float(na == nb)
    if len(a) > len(b):
        a, b = b, a
    return 2 * sum([k if k < b[w] else b[w] for w, k in a.items() if w in b]) / (na + nb)
