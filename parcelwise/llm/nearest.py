"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

Method: vectors are centred and rotated by several learned rotations (iterative quantisation), and the
signs give a code.  A code is cut into 16-bit substrings, each with its own index from value to rows.  Two codes within
radius r differ by at most r // m in one of m substrings, so probing every substring's buckets up to that distance
retrieves every code within the radius; those are reranked by exact distances of the original vectors.

The radius is calibrated: for a bounded sample of queries the true neighbours are found by brute force over all rows,
and the radius takes in the stated share of them.  A query with fewer neighbours than asked for within the
radius is searched again with the largest radius, which takes in every row.

Scale: equal vectors are one entry of the index with their smallest ids, so a vector of a third of all rows is
compared once.  Every vector is indexed; an index unit is one Arrow batch of a partition and is dropped after the search.
Queries are a stated set, read in blocks of ``QUERY_BLOCK`` and sent to the units; a task returns its best few per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, received, send

BITS, PIECE = 256, 16
SAMPLE, CALIBRATION, QUERY_BLOCK = 20_000, 64, 4096
WANTED_RECALL = 0.985
_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << PIECE)], np.uint8)
HITS = "rep long, vec_id long, score double, hamming int"


@dataclass
class Coder:
    """Sign codes of ``(x - mean) @ rotation`` as 16-bit substrings."""

    mean: np.ndarray
    rotation: np.ndarray

    def codes(self, x: np.ndarray) -> np.ndarray:
        bits = np.packbits((x - self.mean) @ self.rotation > 0, axis=1)
        return bits.view(">u2").astype(np.uint16)


def learn_codes(sample: np.ndarray, bits: int = BITS, rounds: int = 15, seed: int = 5) -> Coder:
    """Rotations learned by iterative quantisation, each from another start, until ``bits`` columns are filled."""
    mean = sample.mean(axis=0)
    x, d = sample - mean, sample.shape[1]
    random, columns = np.random.RandomState(seed), []
    while sum(c.shape[1] for c in columns) < bits:
        r = np.linalg.qr(random.randn(d, d))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
            r = u @ v
        columns.append(r)
    return Coder(mean, np.concatenate(columns, axis=1)[:, :bits])


class Unit:
    """Index of one batch: per substring its values and each row's value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.values = [np.unique(codes[:, j], return_inverse=True) for j in range(codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, Hamming distances) of every code within ``radius``."""
        near = np.zeros(len(self.codes), bool)
        for (values, row), q in zip(self.values, code, strict=True):
            near |= (_POPCOUNT[values ^ q] <= radius // len(code))[row]
        rows = np.flatnonzero(near)
        distance = _POPCOUNT[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64)
        keep = distance <= radius
        return rows[keep], distance[keep]


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _first_of_each(found: list[tuple]) -> list[tuple]:
    """The nearest (distance, vec_id, hamming) of each vec_id, nearest first."""
    out = {}
    for hit in sorted(found):
        out.setdefault(hit[1], hit)
    return list(out.values())


def _search(sent, most: int):
    def run(batches):
        reps, queries, codes, coder, radius = received(sent)
        best = [[] for _ in reps]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = _vectors(batch.column("embedding")), batch.column("ids").to_pylist()
            unit = Unit(coder.codes(x))
            for i in range(len(reps)):
                rows, hamming = unit.within(codes[i], radius)
                if not len(rows):
                    continue
                distance = np.sqrt(((x[rows] - queries[i]) ** 2).sum(axis=1))
                wanted = most
                while True:  # vectors of one id may fill the first places: more are taken until there are enough ids
                    keep = distance <= np.partition(distance, wanted - 1)[wanted - 1] if len(rows) > wanted else np.ones(len(rows), bool)
                    found = [(d, v, h) for r, d, h in zip(rows[keep].tolist(), distance[keep].tolist(), hamming[keep].tolist(), strict=True)
                             for v in ids[r]]
                    if keep.all() or len({v for _, v, _ in found}) >= most:
                        break
                    wanted *= 4
                best[i] = _first_of_each(best[i] + found)[:most]
        flat = [(rep, v, d, h) for rep, found in zip(reps.tolist(), best, strict=True) for d, v, h in found]
        if flat:
            rep, v, d, h = zip(*flat, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(v, pa.int64()), pa.array(d, pa.float64()),
                                              pa.array(h, pa.int32())], ["rep", "vec_id", "score", "hamming"])
    return run


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    reps, vectors = [], []
    for row in queries.toLocalIterator():
        reps.append(row.rep)
        vectors.append(row.embedding)
        if len(reps) == size:
            yield np.array(reps, np.int64), np.array(vectors, np.float64)
            reps, vectors = [], []
    if reps:
        yield np.array(reps, np.int64), np.array(vectors, np.float64)


def _run(entries: DataFrame, reps, queries, coder: Coder, radius: int, most: int) -> DataFrame:
    sent = send(entries.sparkSession, (reps, queries, coder.codes(queries), coder, radius))
    hits = entries.mapInArrow(_search(sent, most), HITS).groupBy("rep", "vec_id").agg(F.min(F.struct("score", "hamming")).alias("hit"))
    hits = hits.select("rep", "vec_id", "hit.score", "hit.hamming")
    first = Window.partitionBy("rep").orderBy("score", "vec_id")
    return materialize(hits.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most), "hits")


def usable(embeddings: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding array<double>) of the vectors that take part; an id may have several.

    Left out: null ids, and vectors that are null, empty, all zero or hold a null or non-finite component.
    """
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad & F.exists("embedding", lambda x: x != 0))
    return materialize(v.distinct(), "vectors")


def nearest(embeddings: DataFrame, k: int = 10, every: int = 100, bits: int = BITS, recall: float = WANTED_RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``, nearest first.

    score is the Euclidean distance of the original vectors in double precision; ties go to the smaller vec_id; a query's
    own id is no candidate.  Vectors of equal length are compared; of an id with several vectors the least distance counts.
    All candidates are returned if there are fewer than k.  See ``usable`` for rows that take no part.
    """
    rows = usable(embeddings)
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    lengths = sorted(r.d for r in rows.where(is_query).select(F.size("embedding").alias("d")).distinct().collect())
    found = embeddings.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    for d in lengths:
        found = found.unionByName(_of_length(rows.where(F.size("embedding") == d), is_query, k + 1, bits, recall))  # one may be the query itself
    found = found.where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_length(rows: DataFrame, is_query: Column, most: int, bits: int, recall: float) -> DataFrame:
    """(query_id, vec_id, score): for each vector of a query the ``most`` nearest ids found among ``rows``, vectors of one length."""
    small = Window.partitionBy("embedding").orderBy("vec_id")
    entries = materialize(rows.withColumn("place", F.row_number().over(small)).where(F.col("place") <= most)
                          .groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "entries")
    asked = rows.where(is_query)
    # written once, so the numbers stay; an id with several vectors has several
    reps = materialize(asked.groupBy("embedding").agg(F.min("vec_id").alias("least")).withColumn("rep", F.monotonically_increasing_id()), "queries")
    owners = asked.join(reps, "embedding").select(F.col("vec_id").alias("query_id"), "rep")
    n, total = entries.count(), rows.select("vec_id").distinct().count()
    part = F.pmod(F.xxhash64("embedding"), F.lit(1 << 20)) < F.lit(min(1.0, SAMPLE / n) * (1 << 20))
    sample = entries.where(part).select("embedding").toPandas()["embedding"].tolist() or [entries.first().embedding]
    coder = learn_codes(np.array(sample, np.float64), bits)
    share = min(1.0, CALIBRATION / reps.count())
    trial = [np.array(x) for x in zip(*[(r.rep, r.embedding) for r in reps.where(
        F.pmod(F.xxhash64("least"), F.lit(1 << 20)) <= F.lit(share * (1 << 20))).collect()], strict=True)] or next(_blocks(reps, CALIBRATION))
    true = _run(entries, trial[0], trial[1], coder, bits, most).select("hamming").toPandas()["hamming"].to_numpy()
    radius = int(np.ceil(np.quantile(true, recall)))
    found = None
    for block, vectors in _blocks(reps, QUERY_BLOCK):
        hits = _run(entries, block, vectors, coder, radius, most)
        enough = {r.rep for r in hits.groupBy("rep").agg(F.count("*").alias("n")).where(F.col("n") >= min(most, total)).collect()}
        few = np.array([r not in enough for r in block.tolist()])
        if few.any():
            again = _run(entries, block[few], vectors[few], coder, bits, most)
            hits = hits.join(again.select("rep").distinct(), "rep", "left_anti").unionByName(again)
        found = hits if found is None else found.unionByName(hits)
    return owners.join(found, "rep").select("query_id", "vec_id", "score")
