"""Benchmark decontamination by a prefix-filtered set join.

Method: an item is cut into windows of ``window`` consecutive words (an item with fewer words is one
window).  A window's shingles (``width`` words) are ordered by rarity over all documents; a document that
contains the window whole must contain every shingle, so the necessary prefix is the rarest one.
Documents are joined to windows on that prefix shingle; the shingle's offset bounds where the window
can start and its length where it must end, and what is left is verified word by word.

Scale: the benchmark is the stated query set.  It is read in blocks of at most ``BLOCK_WORDS`` words, and one
block's windows (a measured, bounded size) are sent to the tasks at a time; documents are never shuffled
for the search.  Rarity is counted over all documents in the same way, with one sum per shingle and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialize, received, send, text_key
from .words import ALNUM, shingle_hashes, text_chunks, words_of

WINDOW, WIDTH = 10, 5
BLOCK_WORDS = 1_000_000
HITS = "k1 long, k2 long, doc_id long, n_words long, n_hit long, spans binary, items array<string>"


@dataclass
class Windows:
    """Distinct windows of a block of items, their words and shingles."""

    words: np.ndarray    # words of all items
    start: np.ndarray    # of each window in ``words``
    length: np.ndarray
    owners: list         # of each window: the items that have it
    shingles: list       # of each window: its shingle hashes, in order


def read_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """Items (id as text, text) in blocks of bounded size; null ids are the empty text."""
    block, held = [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"),
                                F.col("text").cast("binary").alias("text")).where("text IS NOT NULL").toLocalIterator():
        block.append((row.id, bytes(row.text)))
        held += len(row.text) // 4 + 1
        if held >= block_words:
            yield block
            block, held = [], 0
    if block:
        yield block


def windows_of(items: list[tuple[str, bytes]], window: int, width: int) -> Windows:
    seen: dict[bytes, int] = {}
    words, start, length, owners, shingles, base = [], [], [], [], [], 0
    for name, text in items:
        w, _ = words_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ALNUM)
        if not len(w):
            continue
        size = min(window, len(w))
        parts = shingle_hashes(w, min(width, size))
        each = size - min(width, size) + 1
        for i in range(len(w) - size + 1):
            at = seen.setdefault(w[i:i + size].tobytes(), len(start))
            if at == len(start):
                start.append(base + i)
                length.append(size)
                owners.append(set())
                shingles.append(parts[i:i + each])
            owners[at].add(name)
        words.append(w)
        base += len(w)
    return Windows(np.concatenate(words) if words else np.empty(0, np.uint64), np.array(start, np.int64),
                   np.array(length, np.int64), [sorted(o) for o in owners], shingles)


def _widths(windows: Windows, width: int) -> list[int]:
    return sorted({min(width, int(n)) for n in windows.length})


def _doc_shingles(words: np.ndarray, at: np.ndarray, k: int):
    """(hash, word position) of every k-word run inside one text of the chunk."""
    if len(words) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = shingle_hashes(words, k)
    ends = np.repeat(at[1:], np.diff(at))[:len(hashes)]
    pos = np.flatnonzero(np.arange(len(hashes)) + k <= ends)
    return hashes[pos], pos


def _lookup(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value among the keys, -1 where absent."""
    i = np.searchsorted(sorted_keys, values)
    i[i == len(sorted_keys)] = 0
    return np.where(sorted_keys[i] == values, i, -1)


def _rarity(docs: DataFrame, windows: Windows, width: int) -> dict[int, int]:
    """Occurrences of each window shingle over all documents."""
    tokens = np.unique(np.concatenate(windows.shingles)) if windows.shingles else np.empty(0, np.uint64)
    sent = send(docs.sparkSession, (tokens, _widths(windows, width)))

    def run(batches):
        keys, widths = received(sent)
        counts = np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                words, at = words_of(data, offsets, ALNUM)
                for k in widths:
                    found = _lookup(keys, _doc_shingles(words, at, k)[0])
                    counts += np.bincount(found[found >= 0], minlength=len(keys))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["token", "n"])

    counted = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = {int(tokens[r.token]): r.n for r in counted.collect()} if len(tokens) else {}
    sent.unpersist()
    return found


def _prefix_index(windows: Windows, rarity: dict[int, int]):
    """(sorted prefix shingles, window of each, offset of the shingle in the window)."""
    key, offset = np.empty(len(windows.start), np.uint64), np.empty(len(windows.start), np.int64)
    for i, parts in enumerate(windows.shingles):
        j = min(range(len(parts)), key=lambda j: (rarity.get(int(parts[j]), 0), int(parts[j])))
        key[i], offset[i] = parts[j], j
    order = np.argsort(key, kind="stable")
    return key[order], order, offset[order]


def _hits_in(words, at, windows: Windows, index, widths):
    """(start, end) word spans of all verified window occurrences in a chunk, and their windows."""
    keys, owner, offset = index
    begins, which = [], []
    for k in widths:
        hashes, pos = _doc_shingles(words, at, k)
        first = np.searchsorted(keys, hashes, "left")
        count = np.searchsorted(keys, hashes, "right") - first
        some = np.flatnonzero(count)
        if not len(some):
            continue
        n = count[some]
        entry = np.repeat(first[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        begin, window = np.repeat(pos[some], n) - offset[entry], owner[entry]
        text = np.searchsorted(at, np.repeat(pos[some], n), "right") - 1
        inside = (begin >= at[text]) & (begin + windows.length[window] <= at[text + 1])
        begin, window = begin[inside], window[inside]
        same = np.ones(len(begin), bool)
        for j in range(int(windows.length.max())):
            live = np.flatnonzero(same & (windows.length[window] > j))
            same[live] = words[begin[live] + j] == windows.words[windows.start[window[live]] + j]
        begins.append(begin[same])
        which.append(window[same])
    if not begins:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(begins), np.concatenate(which)


def _search(docs: DataFrame, windows: Windows, index, width: int) -> DataFrame:
    sent = send(docs.sparkSession, (windows, index, _widths(windows, width)))

    def run(batches):
        found, table, widths = received(sent)
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                words, at = words_of(data, offsets, ALNUM)
                begin, window = _hits_in(words, at, found, table, widths) if len(found.start) else ([], [])
                cover = np.zeros(len(words) + 1, np.int64)
                items = [None] * (hi - lo)
                spans = [None] * (hi - lo)
                if len(begin):
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, begin + found.length[window], -1)
                    text = np.searchsorted(at, begin, "right") - 1
                    for t in np.unique(text).tolist():
                        mine = text == t
                        items[t] = sorted({o for w in np.unique(window[mine]).tolist() for o in found.owners[w]})
                        spans[t] = np.unique(np.stack([begin[mine] - at[t], begin[mine] - at[t] + found.length[window[mine]]], 1),
                                             axis=0).astype("<i8").tobytes()
                hit = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1"), part.column("k2"), part.column("doc_id"), pa.array(np.diff(at)),
                     pa.array(hit[at[1:]] - hit[at[:-1]]), pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string()))],
                    ["k1", "k2", "doc_id", "n_words", "n_hit", "spans", "items"])

    return docs.mapInArrow(run, HITS)


def _merge(groups: pa.Table) -> pa.Table:
    """One row from a document's rows of several blocks: hit words and items united."""
    spans = [np.frombuffer(s, "<i8").reshape(-1, 2) for s in groups.column("spans").to_pylist() if s]
    spans = np.unique(np.concatenate(spans), axis=0) if spans else np.empty((0, 2), np.int64)
    hit, reach = 0, 0
    for a, b in spans.tolist():
        hit += max(0, b - max(a, reach))
        reach = max(reach, b)
    items = sorted({i for x in groups.column("items").to_pylist() for i in x or ()})
    first = groups.slice(0, 1).to_pylist()[0]
    return pa.table({"k1": [first["k1"]], "k2": [first["k2"]], "n_hit": [hit], "spans": pa.array([spans.astype("<i8").tobytes()], pa.binary()),
                     "items": pa.array([items], pa.list_(pa.string()))})


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, width: int = WIDTH,
                  block_words: int = BLOCK_WORDS, key: list[Column] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): k1, k2, doc_id, n_words, n_hit, spans, items.

    spans holds the distinct occurrences of windows as pairs of little-endian longs (first word, end word);
    items the sorted ids (as text) of the items with an occurring window; both null without a hit.  Null texts
    have no words; null or wordless items have no windows; a null item id is the empty text; equal ids count once.
    Repeated rows each get a row.  Other columns are ignored; an empty benchmark hits nothing.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                      *(key or text_key(docs)))
    parts = []
    for items in read_blocks(benchmark, block_words):
        windows = windows_of(items, window, width)
        index = _prefix_index(windows, _rarity(own, windows, width))
        parts.append(_search(own, windows, index, width))
    if not parts:
        return _search(own, windows_of([], window, width), None, width)
    if len(parts) == 1:
        return parts[0]
    hits = parts[0].where("n_hit > 0").drop("doc_id", "n_words")
    for part in parts[1:]:
        hits = hits.unionByName(part.where("n_hit > 0").drop("doc_id", "n_words"))
    one = materialize(hits.dropDuplicates(["k1", "k2", "spans", "items"]).groupBy("k1", "k2").applyInArrow(
        _merge, "k1 long, k2 long, n_hit long, spans binary, items array<string>"), "hits")
    return (parts[0].select("k1", "k2", "doc_id", "n_words").join(one, ["k1", "k2"], "left")
            .select("k1", "k2", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "spans", "items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, width: int = WIDTH) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item; all columns are returned as they are."""
    hits = contamination(docs, benchmark, window, width).where("n_hit > 0").select("k1", "k2").distinct()
    k1, k2 = free_names(docs, "k1", "k2")
    own = text_key(docs)
    return docs.withColumns({k1: own[0], k2: own[1]}).join(
        hits.withColumnsRenamed({"k1": k1, "k2": k2}), [k1, k2], "left_anti").select(*docs.columns)
