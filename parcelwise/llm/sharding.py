"""Sharding by minimax contiguous partition (DataFrame functions only).

Method: rows with equal texts are one atomic group; groups stand in the order of a 64-bit hash of
the text.  The smallest capacity that lets the ordered groups fit into the shards is found by binary
search, each candidate checked greedily, and the groups are cut there.

Scale: the search runs on the driver over sums of hash ranges, never over groups.  It starts with
2**14 ranges.  Where a range is taken as indivisible the search gives an upper bound, where it may be cut
anywhere a lower one; only ranges in which a cut can still fall are refined (256 parts each) until
both bounds meet, so the capacity is exact while each round collects some thousand rows.  The cuts are
then literals, so rows get their shard without a join or a shuffle.  Slots are numbered in
blocks of a shard whose number grows with the rows; a hot text's rows lie in all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import EQUAL_ROWS, free_names, materialize, repeated_keys, split_repeats, text_key, whole_row_key

SHARDS = 16
FIRST_BITS, MORE_BITS = 14, 8
BLOCK_ROWS = 100_000


@dataclass
class Ranges:
    """Consecutive key ranges: total size, smallest and largest key; ``bits`` of the key that name the range."""

    total: np.ndarray
    low: np.ndarray
    high: np.ndarray
    bits: np.ndarray

    @property
    def atomic(self) -> np.ndarray:
        return self.low == self.high

    @property
    def sums(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.total)])


def _summed(groups: DataFrame, bits: int) -> list[tuple]:
    return [(r.total, r.low, r.high, bits) for r in groups.groupBy(F.shiftright("key", 64 - bits).alias("range")).agg(
        F.sum("size").alias("total"), F.min("key").alias("low"), F.max("key").alias("high")).collect()]


def _ranges(rows: list[tuple]) -> Ranges:
    rows = sorted(rows, key=lambda r: r[1])
    return Ranges(*(np.array(c, np.int64) for c in zip(*rows, strict=True)))


def _walk(r: Ranges, capacity: int, shards: int, whole: bool) -> list[float] | None:
    """Greedy ends of the shards; ``whole``: no range is divided, else only those of one group.  None: no fit."""
    s, atomic, at, ends = r.sums, r.atomic, 0, []
    for _ in range(shards):
        to = min(at + capacity, s[-1])
        i = int(np.searchsorted(s, to, "right")) - 1
        if to < s[-1] and (whole or atomic[i]):
            to = max(int(s[i]), at) if s[i] > at else at
        if to == at and at < s[-1]:
            return None
        at = to
        ends.append(at)
    return ends if at == s[-1] else None


def _least(r: Ranges, shards: int, whole: bool) -> int:
    lo, hi = 0, int(r.sums[-1])
    while lo < hi:
        mid = (lo + hi) // 2
        if _walk(r, mid, shards, whole) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _undecided(r: Ranges, least: int, most: int, shards: int) -> np.ndarray:
    """Ranges of several groups in which a greedy cut can fall for some capacity from least to most."""
    s, open_ = r.sums, np.zeros(len(r.total), bool)
    below = above = 0
    for _ in range(shards):
        i = int(np.searchsorted(s, min(below + least, s[-1]), "right")) - 1
        below = int(s[i]) if s[i] > below else min(below + least, int(s[-1]))
        above = min(above + most, int(s[-1]))
        a = max(int(np.searchsorted(s, below, "right")) - 1, 0)
        b = int(np.searchsorted(s, above, "left"))
        open_[a:b] = True
    return np.flatnonzero(open_ & ~r.atomic)


def minimax_cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[int]]:
    """(smallest capacity, keys at which shards 1, 2, ... begin) for rows (key long, size long).

    Rows with equal keys are one group and stay together; groups stand in key order.  Among the partitions
    that keep to the capacity, each cut is the known boundary nearest to an equal share of what is left.
    No rows: capacity 0 and no cuts.
    """
    rows = _summed(groups, FIRST_BITS)
    if not rows:
        return 0, []
    while True:
        r = _ranges(rows)
        least, most = _least(r, shards, whole=False), _least(r, shards, whole=True)
        open_ = _undecided(r, least, most, shards)
        if least == most or not len(open_):
            break
        kept = [row for i, row in enumerate(sorted(rows, key=lambda x: x[1])) if i not in set(open_.tolist())]
        for bits in sorted(set(r.bits[open_].tolist())):
            names = [int(k) >> (64 - bits) for k in r.low[open_][r.bits[open_] == bits]]
            kept += _summed(groups.where(F.shiftright("key", 64 - bits).isin(names)), min(bits + MORE_BITS, 64))
        rows = kept
    return most, _even_cuts(r, most, shards)


def _even_cuts(r: Ranges, capacity: int, shards: int) -> list[int]:
    s = r.sums
    latest = [len(s) - 1]  # latest[k]: first boundary from which k shards hold the rest
    for _ in range(shards):
        latest.append(int(np.searchsorted(s, s[latest[-1]] - capacity, "left")))
    at, cuts = 0, []
    for k in range(shards - 1):
        want = s[at] + (s[-1] - s[at]) / (shards - k)
        i = int(np.searchsorted(s, want))
        if i > 0 and (i == len(s) or want - s[i - 1] < s[i] - want):
            i -= 1
        i = min(max(i, at, latest[shards - 1 - k]), int(np.searchsorted(s, s[at] + capacity, "right")) - 1)
        at = i
        cuts.append(int(r.low[at]) if at < len(r.low) else (1 << 63) - 1)
    return cuts


def _described(docs: DataFrame) -> dict:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return {"key": F.xxhash64(text), "size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text)}


def _numbered(docs: DataFrame, own: list[Column], many: DataFrame, cuts: list[int], shards: int, count: int, key: str,
              names: list[str]) -> DataFrame:
    """``docs`` with their shard and slot, named as ``names`` says (shard, slot, and further names to work with).

    ``own`` is the rows' key and ``many`` the keys that very many rows share: these lie in several blocks.
    """
    shard, slot, block, before, k1, k2, i, n = names
    rows, hot = split_repeats(docs, own, many, [k1, k2, i, n])
    rows = rows.withColumn(i, F.lit(0).cast("long"))
    if hot is not None:
        rows = rows.unionByName(hot.drop(n))
    ids = [k1, k2, i]
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.col(key) >= F.lit(cut)).cast("int")
    blocks = max(8, -(-count // (shards * BLOCK_ROWS)))
    dealt = rows.withColumn(shard, number).withColumn(block, F.pmod(F.xxhash64(k1, k2, F.expr(f"`{i}` div {EQUAL_ROWS}")), F.lit(blocks)))
    along = Window.partitionBy(shard).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(dealt.groupBy(shard, block).agg(F.count("*").alias("m")), "blocks") \
        .withColumn(before, F.coalesce(F.sum("m").over(along), F.lit(0))).drop("m")
    inside = Window.partitionBy(shard, block).orderBy(*ids)
    return (dealt.withColumn(slot, F.row_number().over(inside)).join(counts, [shard, block])
            .withColumn(slot, (F.col(before) + F.col(slot) - 1).cast("long")).drop(block, before, k1, k2, i))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): k1, k2, doc_id, key, size, text_crc32, shard, slot.

    size is the text's UTF-8 bytes plus 1; null counts as the empty text.  Equal texts share a shard.
    slot numbers a shard's rows from 0 without gaps, in an order that depends on the rows only (equal rows
    may swap).  Null and repeated ids are allowed; other columns are ignored; no rows give no rows.
    """
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(docs),
                                   *[c.alias(n) for n, c in _described(docs).items()]), "sized")
    _, cuts = minimax_cuts(rows.select("key", "size"), shards)
    own = [F.col("k1"), F.col("k2")]
    return _numbered(rows, own, repeated_keys(rows), cuts, shards, rows.count(), "key",
                     ["shard", "slot", "block", "before", "h1", "h2", "i", "rows"]).select(
        "k1", "k2", "doc_id", "key", "size", "text_crc32", "shard", "slot")


def place_in_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with shard and slot (see ``shard``); columns of ``docs`` with these names are replaced."""
    docs = docs.drop("shard", "slot")
    described = _described(docs)
    own = whole_row_key(docs)
    sized = materialize(docs.select(described["key"].alias("key"), described["size"].alias("size"), *own), "sized")
    _, cuts = minimax_cuts(sized.select("key", "size"), shards)
    names = free_names(docs, "key", "block", "before", "k1", "k2", "i", "rows")
    rows = docs.withColumn(names[0], described["key"])
    return _numbered(rows, own, repeated_keys(sized), cuts, shards, sized.count(), names[0], ["shard", "slot", *names[1:]]).select(
        *docs.columns, "shard", "slot")
