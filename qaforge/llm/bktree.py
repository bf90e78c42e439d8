"""Burkhard-Keller trees over Hamming fingerprints, many at once.

Children are keyed by the integer Hamming distance to their parent, and a search follows only the edges within its radius of
the distance at hand. All trees of a batch (one per shard) are built level by level and searched together on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .sketches import distance

FRONT = 1 << 19  # (query, node) pairs looked at together


class Forest:
    """Trees over prints (rows of uint64), one per value of shard (ascending); equal prints of a shard share a node."""

    def __init__(self, prints: np.ndarray, shard: np.ndarray) -> None:
        n, w = prints.shape
        self.prints, self.wide = prints, 64 * w + 1
        first = np.ones(n, dtype=bool)
        first[1:] = shard[1:] != shard[:-1]
        self.shards = shard[first]
        roots = np.nonzero(first)[0]
        self.root = np.arange(len(roots))
        member, parent, edge = [roots], [np.full(len(roots), -1)], [np.zeros(len(roots), np.int64)]
        same_item, same_node = [], []
        at = np.nonzero(~first)[0]
        node = (np.cumsum(first) - 1)[at]  # number of the node whose subtree an item is in
        made = len(roots)
        top = roots  # item of each node
        while len(at):
            d = distance(prints[at], prints[top[node]])
            zero = d == 0
            if zero.any():
                same_item.append(at[zero])
                same_node.append(node[zero])
                at, node, d = at[~zero], node[~zero], d[~zero]
                if not len(at):
                    break
            key = node * self.wide + d
            keys, lead, inv = np.unique(key, return_index=True, return_inverse=True)
            member.append(at[lead])
            parent.append(keys // self.wide)
            edge.append(keys % self.wide)
            top = np.concatenate([top, at[lead]])
            node = made + inv
            made += len(keys)
            rest = np.ones(len(at), dtype=bool)
            rest[lead] = False
            at, node = at[rest], node[rest]
        self.item = np.concatenate(member)
        up, edge = np.concatenate(parent), np.concatenate(edge)
        kids = np.nonzero(up >= 0)[0]
        order = kids[np.argsort(up[kids] * self.wide + edge[kids], kind="stable")]
        self.kid, self.kid_key = order, up[order] * self.wide + edge[order]
        item, node = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (same_item, same_node))
        order = np.argsort(node, kind="stable")
        self.twin, self.twin_node = item[order], node[order]
        self.visited = 0  # nodes looked at by all searches so far

    def within(self, prints: np.ndarray, shard: np.ndarray, radius: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, item) of all items of the query's shard within its radius, in pieces."""
        if not len(self.shards):
            return
        tree = np.minimum(np.searchsorted(self.shards, shard), len(self.shards) - 1)
        ask = np.nonzero(self.shards[tree] == shard)[0]
        stack = [(ask, self.root[tree[ask]])]
        while stack:
            q, v = stack.pop()
            if len(q) > FRONT:
                stack.append((q[FRONT:], v[FRONT:]))
                q, v = q[:FRONT], v[:FRONT]
            self.visited += len(q)
            d = distance(prints[q], self.prints[self.item[v]])
            r = radius[q]
            hit = d <= r
            if hit.any():
                yield q[hit], self.item[v[hit]]
                yield from self._twins(q[hit], v[hit])
            lo = np.searchsorted(self.kid_key, v * self.wide + np.maximum(d - r, 1))
            hi = np.searchsorted(self.kid_key, v * self.wide + np.minimum(d + r, self.wide - 1), "right")
            q, at = _spread(q, lo, hi)
            if len(q):
                stack.append((q, self.kid[at]))


    def _twins(self, q: np.ndarray, v: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, item) of the other items of nodes that were hit, in pieces of about FRONT."""
        lo, hi = np.searchsorted(self.twin_node, v), np.searchsorted(self.twin_node, v, "right")
        some = np.nonzero(hi > lo)[0]
        piece = np.cumsum(hi[some] - lo[some]) // FRONT
        for part in np.split(some, np.nonzero(piece[1:] != piece[:-1])[0] + 1):
            if len(part):
                who, what = _spread(q[part], lo[part], hi[part])
                yield who, self.twin[what]


def _spread(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each q once for every number from lo up to hi."""
    n = np.maximum(hi - lo, 0)
    return np.repeat(q, n), np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
