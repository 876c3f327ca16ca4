"""Ranked lexical search by the Best Position Algorithm over impact lists.

Method: every term has a list of (document, impact) in falling order of impact.  A search reads the lists of its terms
from the top (sorted access), looks each new document up in all of them (direct access) and marks the positions it finds
there as seen.  The best position of a list is the last one before which nothing is unseen; a document that was not met
stands behind it in every list, so the impacts behind the best positions bound its score.  That bound is tighter than the one
from the positions last read.  A search stops when the bound is strictly below the k-th score, as an equal score may win by its id.

Scale: documents are never shuffled.  A task indexes its documents in blocks of bounded size and searches every item in each
block, with the k-th score of the blocks before it; it hands on the best k per item.  Items are read in blocks of
``BLOCK_TERMS`` and sent to the tasks one block at a time.  Before the search over all documents, one over a
sample of about ``BOUND_ROWS`` of them gives each item a score that its k-th can only exceed: tasks then stop early and hand on
only documents that reach it.  The sample saves work and decides nothing.

Terms are compared whole: a 64-bit hash finds them, length and bytes confirm them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, received, send
from .words import ALNUM, text_chunks, word_spans

BLOCK_TERMS = 1_000_000   # term occurrences of items sent at a time
BLOCK_BYTES = 16 << 20    # text indexed at a time
BLOCK_ROWS = 1 << 15
BOUND_ROWS = 1 << 15
FIRST_READ, MOST_READ = 16, 2048  # positions read in a round, doubled from round to round
HITS = "item int, item_id long, doc_id long, score long"
COUNTS = "term long, docs long, n long"
TOTAL = -1                # term number of the row that counts documents and occurrences


@dataclass
class Items:
    """A block of items: their ids, and terms by number (in order of the terms' hashes) with repeats."""

    ids: list
    hashes: np.ndarray        # of each term, ascending
    length: np.ndarray
    names: list               # bytes of each term
    terms: list               # of each item: its distinct terms' numbers
    times: list               # of each item: how often each stands in it


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in order."""
    _, mapped, start, length, _ = word_spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ALNUM)
    return [mapped[s:s + n].tobytes() for s, n in zip(start.tolist(), length.tolist(), strict=True)]


def read_items(benchmark: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Items]:
    """Items with at least one term, in blocks of bounded size."""
    rows, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")) \
            .where("text IS NOT NULL").toLocalIterator():
        terms = terms_of(bytes(row.text))
        if terms:
            rows.append((row.item_id, terms))
            held += len(terms)
        if held >= block_terms:
            yield items_of(rows)
            rows, held = [], 0
    if rows:
        yield items_of(rows)


def items_of(rows: list[tuple]) -> Items:
    names = sorted({t for _, terms in rows for t in terms})
    joined = b" ".join(names)
    hashes, _, _, length, _ = word_spans(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), ALNUM)
    order = np.argsort(hashes, kind="stable")
    number = {names[j]: i for i, j in enumerate(order.tolist())}
    counted = [np.unique([number[t] for t in terms], return_counts=True) for _, terms in rows]
    return Items([i for i, _ in rows], hashes[order], length[order], [names[j] for j in order.tolist()],
                 [t for t, _ in counted], [c.astype(np.int64) for _, c in counted])


class Matcher:
    """Occurrences of the items' terms in chunks of texts."""

    def __init__(self, items: Items):
        self.items = items
        longest = max(map(len, items.names))
        self.tails = np.zeros((len(items.names), max(0, longest - 8)), np.uint8)  # bytes after the eighth
        for i, name in enumerate(items.names):
            self.tails[i, :max(0, len(name) - 8)] = np.frombuffer(name, np.uint8)[8:]

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of terms of each text; text, term, occurrences of each distinct pair, by text and term)."""
        hashes, mapped, start, length, at = word_spans(data, offsets, ALNUM)
        n = np.diff(at)
        place = np.minimum(np.searchsorted(self.items.hashes, hashes), len(self.items.hashes) - 1)
        hit = np.flatnonzero((self.items.hashes[place] == hashes) & (self.items.length[place] == length))
        # the hash tells words of up to eight bytes and equal length apart; longer ones are compared byte by byte
        long = np.flatnonzero(length[hit] > 8)
        wrong = np.zeros(len(hit), bool)
        for j in range(self.tails.shape[1] if len(long) else 0):
            long = long[length[hit[long]] > 8 + j]
            wrong[long] |= mapped[start[hit[long]] + 8 + j] != self.tails[place[hit[long]], j]
        hit = hit[~wrong]
        pair = np.repeat(np.arange(len(n)), n)[hit] * np.int64(len(self.items.hashes)) + place[hit]
        pair, times = np.unique(pair, return_counts=True)
        return n, pair // len(self.items.hashes), pair % len(self.items.hashes), times


@dataclass
class Weights:
    """What a score needs of the whole corpus: documents with a term, terms of all of them, weight of each term."""

    documents: int
    occurrences: int
    weight: np.ndarray

    def least_length(self, n: np.ndarray) -> np.ndarray:
        """m of documents with n terms."""
        return 75 + (25 * n.astype(np.int64) * self.documents) // max(1, self.occurrences)

    def impacts(self, term: np.ndarray, times: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.weight[term] * ((1_000_000_000 * times) // (1000 * times + 12 * self.least_length(n)))


class ImpactIndex:
    """Impact lists of a block of documents, numbered from 0."""

    def __init__(self, documents: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, terms: int):
        self.documents = documents
        key = term * np.int64(documents) + doc
        by_key = np.argsort(key)
        self.key, self.impact = key[by_key], impact[by_key]
        term = term[by_key]
        self.first = np.searchsorted(term, np.arange(terms + 1))
        falling = np.lexsort((-self.impact, term))
        self.listed_doc, self.listed_impact = (self.key % documents)[falling], self.impact[falling]
        self.place = np.empty(len(key), np.int64)  # of each posting in its term's list
        self.place[falling] = np.arange(len(key)) - self.first[term]

    def search(self, terms: np.ndarray, times: np.ndarray, most: int, kth=None, reads: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all that can be among the ``most`` highest, given ``kth``: a score that others reach already.

        ``reads`` receives (positions read, positions in the lists).
        """
        lo, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        terms, times, lo, size = (x[size > 0] for x in (terms, times, lo, size))
        kth = kth or 0
        base = np.concatenate([[0], np.cumsum(size)])
        seen = np.zeros(base[-1], bool)
        known = np.zeros(self.documents, bool)
        best, docs, scores, read, step = np.zeros(len(terms), np.int64), [], [], 0, FIRST_READ
        top = np.empty(0, np.int64)
        while len(terms):
            behind = np.where(best < size, self.listed_impact[np.minimum(lo + best, lo + size - 1)], 0)
            limit = max(kth, top.min() if len(top) == most else 0)
            bound = int((times * behind).sum())
            if bound < limit or bound == 0:
                break
            at = read + np.arange(step)
            new = np.unique(self.listed_doc[(lo[:, None] + at)[at < size[:, None]]])
            new = new[~known[new]]
            known[new] = True
            read, step = read + step, min(2 * step, MOST_READ)
            if not len(new):
                best = np.minimum(size, np.maximum(best, read))
                continue
            key = terms[:, None] * np.int64(self.documents) + new
            found = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            there = self.key[found] == key
            seen[(base[:-1, None] + self.place[found])[there]] = True
            total = times @ np.where(there, self.impact[found], 0)
            docs.append(new)
            scores.append(total)
            top = np.concatenate([top, total])
            top = top if len(top) <= most else np.partition(top, len(top) - most)[-most:]
            for i, (b, n) in enumerate(zip(best.tolist(), size.tolist(), strict=True)):
                rest = seen[base[i] + b:base[i] + n]
                j = int(rest.argmin()) if len(rest) else 0
                best[i] = n if not len(rest) or rest[j] else b + j
        if reads is not None:
            reads.append((int(np.minimum(size, read).sum()), int(size.sum())))
        docs = np.concatenate(docs) if docs else np.empty(0, np.int64)
        scores = np.concatenate(scores) if scores else np.empty(0, np.int64)
        keep = scores >= max(1, kth, top.min() if len(top) == most else 0)
        return docs[keep], scores[keep]


def _best(ids: np.ndarray, null: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    return np.lexsort((ids, null, -scores))[:most]


def _blocks(batches, matcher: Matcher, block_bytes: int, block_rows: int):
    """(doc_id column, terms of each document, document, term, occurrences of each posting) of blocks of documents."""
    parts, rows, held = [], 0, 0

    def block():
        ids = pa.concat_arrays([p[0] for p in parts])
        starts = np.cumsum([0] + [len(p[1]) for p in parts])
        joined = [np.concatenate([p[j] for p in parts]) for j in (1, 3, 4)]
        return ids, joined[0], np.concatenate([p[2] + s for p, s in zip(parts, starts[:-1], strict=True)]), joined[1], joined[2]

    for batch in batches:
        for lo, hi, data, offsets in text_chunks(batch.column("text")):
            parts.append((batch.column("doc_id").slice(lo, hi - lo), *matcher.counts(data, offsets)))
            rows, held = rows + hi - lo, held + len(data)
            if held >= block_bytes or rows >= block_rows:
                yield block()
                parts, rows, held = [], 0, 0
    if parts:
        yield block()


def _counting(sent):
    def run(batches):
        items: Items = received(sent)
        matcher, docs = Matcher(items), np.zeros(len(items.hashes), np.int64)
        documents = occurrences = 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                n, _, term, _ = matcher.counts(data, offsets)
                docs += np.bincount(term, minlength=len(docs))
                documents, occurrences = documents + int((n > 0).sum()), occurrences + int(n.sum())
        some = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array([TOTAL, *some.tolist()], pa.int64()), pa.array([documents, *docs[some].tolist()], pa.int64()),
                                          pa.array([occurrences] + [0] * len(some), pa.int64())], ["term", "docs", "n"])
    return run


def _searching(sent, most: int, block_bytes: int, block_rows: int):
    def run(batches):
        items, weights, least = received(sent)
        matcher = Matcher(items)
        empty = (np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
        held = [empty] * len(items.ids)
        for ids, n, doc, term, times in _blocks(batches, matcher, block_bytes, block_rows):
            index = ImpactIndex(len(n), doc, term, weights.impacts(term, times, n[doc]), len(items.hashes))
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for i, (terms, repeats) in enumerate(zip(items.terms, items.times, strict=True)):
                kth = max(int(least[i]), int(held[i][2][-1]) if len(held[i][2]) == most else 0)
                docs, scores = index.search(terms, repeats, most, kth)
                if len(docs):
                    all_ = [np.concatenate(x) for x in zip(held[i], (ids[docs], null[docs], scores), strict=True)]
                    held[i] = tuple(x[_best(*all_, most)] for x in all_)
        sizes = [len(h[2]) for h in held]
        if sum(sizes):
            ids, null, scores = (np.concatenate(x) for x in zip(*held, strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                pa.array([items.ids[i] for i, s in enumerate(sizes) for _ in range(s)], pa.int64()),
                pa.array(ids, pa.int64(), mask=null), pa.array(scores, pa.int64())], ["item", "item_id", "doc_id", "score"])
    return run


def weights_of(docs: DataFrame, items: Items, sent=None) -> Weights:
    """Counts over all documents, and the weights of the items' terms."""
    sent = sent or send(docs.sparkSession, items)
    counted = docs.mapInArrow(_counting(sent), COUNTS).groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).collect()
    held = {r.term: r for r in counted}
    documents, occurrences = (held[TOTAL].docs, held[TOTAL].n) if TOTAL in held else (0, 0)
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * held[t].docs + 1))) if t in held else 0 for t in range(len(items.hashes))]
    return Weights(documents, occurrences, np.array(weight, np.int64))


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def rank_documents(docs: DataFrame, benchmark: DataFrame, most: int = 20, block_terms: int = BLOCK_TERMS,
                   block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS, bound_rows: int = BOUND_ROWS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``most`` highest-scoring rows of ``docs`` (doc_id, text) for each row of ``benchmark`` (item_id, text).

    Terms are runs of letters, digits and all that is not ASCII, lower-cased in A-Z.  N documents have a term, L terms stand in
    all of them, n in one; a term of weight w = floor(1000 ln((2N + 2) / (2 df + 1))) that occurs tf times adds
    w * (10^9 tf div (1000 tf + 12 m)), m = 75 + (25 n N) div L, to the score for each time it stands in the item.
    Highest first, equal scores by ascending doc_id (null ids last); rows without a positive score are not returned.

    Null and empty texts, items or tables have no terms and give no rows.  Every row is a document and every row of the benchmark an
    item of its own: repeated rows are ranked, and repeated items answered, each time.  Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    result = None
    for items in read_items(benchmark, block_terms):
        weights = weights_of(texts, items)
        least = np.zeros(len(items.ids), np.int64)

        def search(rows: DataFrame) -> DataFrame:
            sent = send(spark, (items, weights, least))  # noqa: B023 - called in this round only
            return _ranked(rows.mapInArrow(_searching(sent, most, block_bytes, block_rows), HITS), most)

        share = weights.documents // max(1, bound_rows)
        if share > 1:
            some = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
            for r in search(some).where(F.col("rank") == most).select("item", "score").collect():
                least[r["item"]] = r["score"]
        found = materialize(search(texts).select("item_id", "rank", "doc_id", "score"), "ranked")
        result = found if result is None else result.unionByName(found)
    return result if result is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
