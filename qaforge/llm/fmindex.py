"""Compressed full-text index of word sequences.

The Burrows-Wheeler transform of all sequences is kept as runs of equal words only; texts that repeat each other give few
runs. Backward steps, the walk forward and single words of a text are all answered from the runs, and positions from a
sample of the suffix array, so neither the text nor the suffix array is kept.
"""

from __future__ import annotations

import numpy as np

STEP = 16  # one of so many text positions is kept
SLAB = 1 << 20  # occurrences located together


class FMIndex:
    """Words are small integers from 2; 1 ends each sequence and 0 the whole text. A word of number ``unknown`` stands nowhere."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        n = sum(len(s) + 1 for s in sequences) + 1
        text = np.zeros(n, dtype=np.int64)
        self.starts = np.zeros(len(sequences), dtype=np.int32)
        at = 0
        for i, s in enumerate(sequences):
            self.starts[i] = at
            text[at : at + len(s)] = s
            at += len(s)
            text[at] = 1
            at += 1
        self.n, self.unknown = n, int(text.max()) + 1
        sa = suffixes(text)
        bwt = text[sa - 1]  # of the suffix at 0 it is the last word, 0
        self.base = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.unknown)), [n]]).astype(np.int32)
        self.run = np.concatenate([[0], np.nonzero(bwt[1:] != bwt[:-1])[0] + 1]).astype(np.int32)  # first row of each run
        self.run_word = bwt[self.run].astype(np.int32)
        size = np.diff(np.append(self.run, n))
        order = np.argsort(self.run_word, kind="stable")
        self.key = self.run_word[order].astype(np.int64) * (n + 1) + self.run[order]  # (word, row) of the runs, ascending
        self.size = size[order].astype(np.int32)
        self.first = (np.cumsum(self.size, dtype=np.int64) - self.size).astype(np.int32)  # row that a run's first word leads to
        kept = np.nonzero(sa % STEP == 0)[0]
        self.kept, self.samples = kept.astype(np.int32), sa[kept].astype(np.int32)

    @property
    def nbytes(self) -> int:
        return sum(v.nbytes for v in vars(self).values() if isinstance(v, np.ndarray))

    def rank(self, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Row of the first suffix that begins with word followed by a suffix from row on."""
        whole = word * np.int64(self.n + 1)
        k = np.searchsorted(self.key, whole + row) - 1
        at = np.maximum(k, 0)
        ahead = row - (self.key[at] - whole)
        own = (k >= 0) & (self.key[at] >= whole)
        return np.where(own, self.first[at] + np.minimum(ahead, self.size[at]), self.base[word]).astype(np.int64)

    def step(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: ranges of the suffixes that begin with word followed by what lo to hi stand for."""
        return self.rank(word, lo), self.rank(word, hi)

    def before(self, row: np.ndarray) -> np.ndarray:
        """The word before each suffix."""
        return self.run_word[np.searchsorted(self.run, row, side="right") - 1].astype(np.int64)

    def back(self, row: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The suffixes one word longer; word must be the one before each."""
        return self.rank(word, row)

    def ahead(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word of each suffix, and the suffix after it."""
        k = np.searchsorted(self.first, row, side="right") - 1
        word = self.key[k] // (self.n + 1)
        return word, self.key[k] % (self.n + 1) + row - self.first[k]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps back until a kept one."""
        pos = np.zeros(len(rows), dtype=np.int64)
        left, r, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(left):
            k = np.minimum(np.searchsorted(self.kept, r), len(self.kept) - 1)
            hit = self.kept[k] == r
            pos[left[hit]] = self.samples[k[hit]] + steps
            left, r = left[~hit], r[~hit]
            steps += 1
            r = self.back(r, self.before(r))
        return pos

    def sequence(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, pos, side="right") - 1

    def ranges(self, flat: np.ndarray, at: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of flat[at : at + width] for all tiles at once; the range is empty where a tile stands nowhere."""
        lo, hi = np.zeros(len(at), dtype=np.int64), np.full(len(at), self.n, dtype=np.int64)
        for k in range(1, int(width.max(initial=0)) + 1):
            live = np.nonzero((hi > lo) & (width >= k))[0]
            if not len(live):
                break
            lo[live], hi[live] = self.step(flat[at[live] + width[live] - k], lo[live], hi[live])
        return lo, np.maximum(hi, lo)

    def grow(self, flat: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the maximal matches around occurrences (suffix row) of flat[lo:hi], within least to most."""
        lo, hi = lo.copy(), hi.copy()
        end = row.copy()
        for _ in range(int((hi - lo).max(initial=0))):  # suffixes after the seeds
            end = self.ahead(end)[1]
        # seeds of one call have one width
        live, r = np.arange(len(row)), row.copy()
        while len(live):
            live, r = _keep(lo[live] > least[live], live, r)
            word = self.before(r)
            same = flat[lo[live] - 1] == word
            live, r, word = live[same], r[same], word[same]
            lo[live] -= 1
            r = self.back(r, word)
        live, r = np.arange(len(row)), end
        while len(live):
            live, r = _keep(hi[live] < most[live], live, r)
            word, nxt = self.ahead(r)
            same = flat[hi[live]] == word
            live, r = live[same], nxt[same]
            hi[live] += 1
        return lo, hi


def _keep(ok: np.ndarray, *arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(a[ok] for a in arrays)


def suffixes(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling, from as many words as fit a number."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    k = 1
    key = text.astype(np.int64)
    while k * 2 * bits <= 62 and k < n:
        nxt = np.zeros(n, dtype=np.int64)
        nxt[:-k] = key[k:]
        key = (key << (bits * k)) | nxt
        k *= 2
    sa = np.argsort(key, kind="stable")
    while True:
        s = key[sa]
        new = np.zeros(n, dtype=np.int64)
        new[1:] = np.cumsum(s[1:] != s[:-1])
        rank = np.empty(n, dtype=np.int64)
        rank[sa] = new
        if new[-1] == n - 1 or k >= n:
            return sa
        second = np.zeros(n, dtype=np.int64)
        second[:-k] = rank[k:] + 1
        key = rank * (n + 1) + second
        sa = np.argsort(key, kind="stable")
        k *= 2
