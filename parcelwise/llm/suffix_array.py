"""Suffix arrays of one block of byte strings, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _words(data: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from each position on (zero-padded) as one unsigned integer per position."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    return np.ndarray((len(data),), f"{order}u8", buffer=padded, strides=(1,))


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each) by at least the first ``depth`` bytes.

    Larsson-Sadakane refinement: suffixes are sorted by eight bytes; while groups of equals
    remain, each group is sorted by the ranks of the suffixes h further on, and h doubles.  Suffixes that are
    already alone in their group are never touched again.
    """
    n = len(data)
    first = _words(data, ">").astype(np.uint64)
    sa = np.argsort(first, kind="stable").astype(np.int32)
    ordered = first[sa]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0)).astype(np.int32)  # first place of the group
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1
    rank[sa] = start
    alone = new & np.concatenate([new[1:], [True]])
    open_ = np.flatnonzero(~alone).astype(np.int32)  # places of suffixes not yet alone
    h = 8
    while h < depth and len(open_):
        at = sa[open_]
        group = start[open_]
        after = rank[np.minimum(at + h, n)]
        key = (group.astype(np.int64) << 32) + (after.astype(np.int64) + 1)
        by = np.argsort(key, kind="stable")
        key, at = key[by], at[by]
        sa[open_] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        place = np.maximum.accumulate(np.where(new, open_, 0)).astype(np.int32)
        start[open_] = place
        rank[at] = place
        last = np.concatenate([new[1:], [True]])
        open_ = open_[~(new & last)]
        h *= 2
    return sa, rank[:n]


def common_prefixes(data: np.ndarray, sa: np.ndarray, rank: np.ndarray, cap: int, stride: int = 16) -> np.ndarray:
    """Length (at most ``cap``) of the prefix that each suffix in order shares with the one before it.

    Kasai's bound carried along text order: a suffix shares with its predecessor at least one byte less than
    the suffix one position earlier did.  The bound holds where that suffix was told apart from its predecessor; one that
    was not (same rank) shares ``cap`` bytes, and its successor compares from zero.  Positions go in ``stride`` interleaved
    chains, so each step is one array operation; the chain that comes first also compares from zero.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = np.concatenate([_words(data, "<"), np.zeros(cap + 16, np.uint64)])
    tied = np.zeros(n, bool)
    tied[sa[1:]] = rank[sa[1:]] == rank[sa[:-1]]
    shared = np.where(tied, cap, 0)
    for chain in range(min(stride, n)):
        p = np.arange(chain, n, stride)
        p = p[~tied[p]]
        if chain:
            length = np.where(tied[p - 1], 0, np.maximum(shared[p - 1] - 1, 0))
        else:
            length = np.zeros(len(p), np.int64)
        other = before[p]
        length[other < 0] = 0
        live = np.flatnonzero((other >= 0) & (length < cap))
        while len(live):
            a, b, l = p[live], other[live], length[live]
            x = words[a + l] ^ words[b + l]
            same = x == 0
            low = x & (~x + np.uint64(1))
            extra = np.where(same, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
            length[live] = np.minimum(l + extra, cap)
            live = live[same & (length[live] < cap)]
        ends = np.minimum(n - p, n - np.maximum(other, 0))
        shared[p] = np.where(other < 0, 0, np.minimum(length, ends))
    return shared[sa]


@dataclass
class Block:
    """A suffix array over pieces laid end to end; a window is ``length`` bytes inside one piece."""

    data: np.ndarray
    sa: np.ndarray
    group: np.ndarray    # of each place in order: number of its class of equal windows
    valid: np.ndarray    # of each position: whether a window begins there
    length: int

    @classmethod
    def of(cls, pieces: list[bytes], length: int) -> Block:
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        valid = np.zeros(len(data), bool)
        for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
            valid[a:max(a, b - length + 1)] = True
        sa, rank = suffix_array(data, length)
        shared = common_prefixes(data, sa, rank, length)
        # places whose prefix reaches the length belong together; places without a window make no class of their own
        group = np.cumsum(shared < length)
        return cls(data, sa, group, valid, length)

    def repeated(self, weight: np.ndarray) -> np.ndarray:
        """For each position: whether its window occurs more than once (``weight``: occurrences of each position)."""
        at = self.sa[self.valid[self.sa]]
        group = self.group[self.valid[self.sa]]
        total = np.bincount(group, weights=weight[at], minlength=self.group[-1] + 1 if len(self.group) else 0)
        out = np.zeros(len(self.data), bool)
        out[at] = total[group] > 1
        return out

    def firsts(self) -> np.ndarray:
        """One position of each class of equal windows."""
        at = self.valid[self.sa]
        _, one = np.unique(self.group[at], return_index=True)
        return self.sa[at][one]

    def find(self, other: Block, starts: np.ndarray) -> np.ndarray:
        """For windows of ``other`` that begin at ``starts``: the class of the equal window here, -1 if there is none.

        Binary search over the ordered suffixes, all windows at once; comparisons read eight bytes at a time.
        """
        order = self.sa[self.valid[self.sa]]
        if not len(order):
            return np.full(len(starts), -1, np.int64)
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(order), np.int64)
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) // 2
            less = self._compare(order[mid], other, starts[live]) < 0
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
        at = np.minimum(lo, len(order) - 1)
        same = self._compare(order[at], other, starts) == 0
        return np.where(same, self.group[self.valid[self.sa]][at], -1)

    def _compare(self, mine: np.ndarray, other: Block, theirs: np.ndarray) -> np.ndarray:
        """Sign of the difference of windows, by the whole length."""
        a, b = _words(self.data, ">"), _words(other.data, ">")
        out = np.zeros(len(mine), np.int64)
        live = np.arange(len(mine))
        for i in [*range(0, self.length - 7, 8), *([self.length - 8] if self.length % 8 else [])]:
            x, y = a[mine[live] + i], b[theirs[live] + i]
            out[live] = np.where(x < y, -1, (x > y).astype(np.int64))
            live = live[x == y]
            if not len(live):
                break
        return out
