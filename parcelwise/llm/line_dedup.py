"""Line dedup with sharded cuckoo filters backed by exact reference-count tables.

Method: a line's key (stripped, A-Z lower-cased) is counted once per document.  Keys are spread over
shards by a 128-bit digest.  A shard has an exact table (digest -> number of documents) and a cuckoo
filter of the digests that have reached the threshold.  Lines are tested against the filter and confirmed
in the table.  Inserting documents adds to the counts, deleting them subtracts, and a digest enters or leaves its
filter as it crosses the threshold, so the index after a deletion is the index without those documents.

Scale: tasks send each shard one packed row per batch of texts, with a batch's repeats of a line
already summed, so a line of a third of all documents costs one entry per batch.  A shard's rows are read as a
sorted stream.  For marking, a shard's index row is copied to every salt of the shard and put before the lines of that
salt, so hot lines spread over all salts.  Only dropped line numbers go back to the documents.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, text_key

THRESHOLD = 10
SHARD_LINES = 500_000
SALTS = 8
SPACE = b" \t\n\x0b\x0c\r"
INDEX = "shard int, digests binary, counts binary, filter binary"


class CuckooFilter:
    """16-bit fingerprints in buckets of four; supports insert, delete and vectorised lookup."""

    SLOTS, KICKS = 4, 200

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def of(cls, digests: list[bytes]) -> CuckooFilter:
        """Filter of the given digests, with room to grow; larger until all fit."""
        buckets = 1 << max(3, int(np.ceil(np.log2(max(1, len(digests)) / cls.SLOTS * 1.3 + 1))))
        while True:
            new = cls(np.zeros((buckets, cls.SLOTS), np.uint16))
            if all(new.insert(d) for d in digests):
                return new
            buckets *= 2

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:8], "little") & (len(self.table) - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 5) & (len(self.table) - 1))

    def insert(self, digest: bytes) -> bool:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        bucket = second
        for kick in range(self.KICKS):
            slot = (kick + mark) % self.SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket = self._other(bucket, mark)
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        return False  # the caller builds a larger filter from the exact table

    def delete(self, digest: bytes) -> None:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            held = np.flatnonzero(self.table[bucket] == mark)
            if len(held):
                self.table[bucket, held[0]] = 0
                return

    def contains(self, digests: np.ndarray) -> np.ndarray:
        """For rows of 16 bytes: whether each may be in the filter (never wrong for one that is)."""
        mark = digests[:, :2].copy().view("<u2")[:, 0].astype(np.int64)
        mark[mark == 0] = 1
        wide = np.zeros((len(digests), 8), np.uint8)
        wide[:, :6] = digests[:, 2:8]
        mask = len(self.table) - 1
        first = (wide.view("<u8")[:, 0] & np.uint64(mask)).astype(np.int64)
        second = first ^ ((mark * 0x5BD1E995 >> 5) & mask)
        return ((self.table[first] == mark[:, None]) | (self.table[second] == mark[:, None])).any(axis=1)


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _shard_of(digest: bytes, shards: int) -> int:
    return int.from_bytes(digest[8:12], "little") % shards


def _counted(shards: int, sign: int):
    """Per batch and shard: digests of its lines and the number of documents with each (times ``sign``)."""
    def run(batches):
        for batch in batches:
            count: dict[bytes, int] = defaultdict(int)
            for text in batch.column("text").to_pylist():
                for key in {line_key(x) for x in (text or b"").split(b"\n")} - {b""}:
                    count[_digest(key)] += sign
            out = defaultdict(list)
            for digest in count:
                out[_shard_of(digest, shards)].append(digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int32()), pa.array([b"".join(v) for v in out.values()], pa.binary()),
                 pa.array([np.array([count[d] for d in v], "<i8").tobytes() for v in out.values()], pa.binary()),
                 pa.nulls(len(out), pa.binary())], ["shard", "digests", "counts", "filter"])
    return run


def _split(blob: bytes) -> list[bytes]:
    return [blob[i:i + 16] for i in range(0, len(blob), 16)]


def _fold(threshold: int):
    """Sorted stream of (shard, digests, counts, filter): one summed row per shard with its filter brought up to date."""
    def close(shard, counts, old, before):
        counts = {d: n for d, n in counts.items() if n}
        now = {d for d, n in counts.items() if n >= threshold}
        if old is None:
            filter_ = CuckooFilter.of(sorted(now))
        else:
            filter_ = CuckooFilter(np.frombuffer(old, "<u2").reshape(-1, CuckooFilter.SLOTS).copy())
            for d in sorted(before - now):
                filter_.delete(d)
            if not all(filter_.insert(d) for d in sorted(now - before)):
                filter_ = CuckooFilter.of(sorted(now))
        keys = sorted(counts)
        return (shard, b"".join(keys), np.array([counts[k] for k in keys], "<i8").tobytes(),
                filter_.table.astype("<u2").tobytes())

    def run(batches):
        shard, counts, old, before = None, {}, None, set()
        for batch in batches:
            for s, digests, numbers, held in zip(*(batch.column(c).to_pylist() for c in ("shard", "digests", "counts", "filter")),
                                                 strict=True):
                if s != shard:
                    if shard is not None:
                        yield _row(close(shard, counts, old, before))
                    shard, counts, old, before = s, defaultdict(int), None, set()
                for d, n in zip(_split(digests), np.frombuffer(numbers, "<i8").tolist(), strict=True):
                    counts[d] += n
                if held is not None:  # the stored row comes first
                    old, before = held, {d for d, n in counts.items() if n >= threshold}
        if shard is not None:
            yield _row(close(shard, counts, old, before))
    return run


def _row(values) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                                      ["shard", "digests", "counts", "filter"])


class LineIndex:
    """Reference counts and filters of the lines of a set of documents, one row per shard.

    ``insert`` and ``delete`` return a new index and leave the old one as it is.  Every row is a document of its own: repeated
    rows and rows of one id each count.  A document's null text has one
    empty line, and empty keys are never counted.
    """

    def __init__(self, table: DataFrame, shards: int, threshold: int):
        self.table, self.shards, self.threshold = table, shards, threshold

    @classmethod
    def build(cls, docs: DataFrame, threshold: int = THRESHOLD, shards: int | None = None) -> LineIndex:
        """``shards``: by default one for ``SHARD_LINES`` lines, and at least twice the session's shuffle partitions."""
        shards = shards or max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-_count_lines(docs) // SHARD_LINES))
        return cls(None, shards, threshold)._changed(docs, 1)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with ``docs`` too; its digests are dealt to more shards where they have outgrown theirs twice over."""
        held = self.table.agg(F.sum(F.octet_length("digests"))).first()[0] or 0
        shards = -(-(held // 16 + _count_lines(docs)) // SHARD_LINES)
        return (self.resized(shards) if shards > 2 * self.shards else self)._changed(docs, 1)

    def resized(self, shards: int) -> LineIndex:
        """The same counts in another number of shards."""
        dealt = self.table.mapInArrow(_dealt_again(shards), INDEX)
        return LineIndex(materialize(_by_shard(dealt, ["shard"], []).mapInArrow(_fold(self.threshold), INDEX), "line-index"),
                         shards, self.threshold)

    def delete(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, -1)

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        new = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_counted(self.shards, sign), INDEX)
        both = new if self.table is None else self.table.unionByName(new)
        both = both.withColumn("order", F.when(F.col("filter").isNull(), 1).otherwise(0))
        return LineIndex(materialize(_by_shard(both, ["shard"], ["order"]).drop("order").mapInArrow(
            _fold(self.threshold), INDEX), "line-index"), self.shards, self.threshold)


def _count_lines(docs: DataFrame) -> int:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.agg(F.sum(F.octet_length(text) - F.octet_length(F.translate(text, "\n", "")) + 1)).first()[0] or 0


def _dealt_again(shards: int):
    """Index rows taken apart by their digests' new shards; filters are built anew."""
    def run(batches):
        for batch in batches:
            for digests, counts in zip(batch.column("digests").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                digests, counts = np.frombuffer(digests, np.uint8).reshape(-1, 16), np.frombuffer(counts, "<i8")
                shard = (digests[:, 8:12].copy().view("<u4")[:, 0] % np.uint32(shards)).astype(np.int32)
                order = np.argsort(shard, kind="stable")
                names, cuts = np.unique(shard[order], return_index=True)
                for s, own in zip(names.tolist(), np.split(order, cuts[1:]), strict=True):
                    yield _row((s, digests[own].tobytes(), counts[own].tobytes(), None))
    return run


def _by_shard(df: DataFrame, keys: list[str], then: list[str]) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys, *then)


def _lines(shards: int, salts: int):
    """Per batch and shard: digest, document and number of each line."""
    def run(batches):
        for batch in batches:
            out = defaultdict(lambda: ([], [], [], []))
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for a, b, text in zip(k1, k2, batch.column("text").to_pylist(), strict=True):
                for i, line in enumerate((text or b"").split(b"\n")):
                    if key := line_key(line):
                        digest = _digest(key)
                        for held, value in zip(out[_shard_of(digest, shards)], (digest, a, b, i), strict=True):
                            held.append(value)
            salt = xxhash.xxh3_64_intdigest(np.array(k2[:64], np.int64).tobytes()) % salts
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int32()), pa.array([salt] * len(out), pa.int32()), pa.array([1] * len(out), pa.int32()),
                 pa.array([b"".join(v[0]) for v in out.values()], pa.binary()),
                 pa.array([np.array(v[1:], "<i8").tobytes() for v in out.values()], pa.binary()),
                 pa.nulls(len(out), pa.binary())], ["shard", "salt", "kind", "digests", "places", "filter"])
    return run


def _marked():
    """Sorted stream: a shard's index row, then its lines; gives the lines that are dropped."""
    def run(batches):
        shard, filter_, common = None, None, set()
        for batch in batches:
            k1, k2, line = [], [], []
            for s, kind, digests, places, held in zip(*(batch.column(c).to_pylist() for c in
                                                        ("shard", "kind", "digests", "places", "filter")), strict=True):
                if kind == 0:
                    shard, filter_ = s, CuckooFilter(np.frombuffer(held, "<u2").reshape(-1, CuckooFilter.SLOTS))
                    common = set(_split(digests))
                    continue
                if s != shard or not common:  # nothing of this shard is common
                    continue
                maybe = np.flatnonzero(filter_.contains(np.frombuffer(digests, np.uint8).reshape(-1, 16)))
                sure = [i for i in maybe.tolist() if digests[16 * i:16 * i + 16] in common]
                where = np.frombuffer(places, "<i8").reshape(3, -1)[:, sure]
                k1.append(where[0])
                k2.append(where[1])
                line.append(where[2])
            if k1:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (k1, k2, line)],
                                                 ["k1", "k2", "line"])
    return run


def _frequent(threshold: int):
    """Index rows with only the digests that reached the threshold."""
    def run(batches):
        for batch in batches:
            for shard, digests, counts, held in zip(*(batch.column(c).to_pylist() for c in ("shard", "digests", "counts", "filter")),
                                                    strict=True):
                keep = np.flatnonzero(np.frombuffer(counts, "<i8") >= threshold)
                yield _row((shard, np.frombuffer(digests, np.uint8).reshape(-1, 16)[keep].tobytes(), None, held))
    return run


def _rebuild(batches):
    for batch in batches:
        texts, kept, total, gone = batch.column("text").to_pylist(), [], [], []
        for text, drop in zip(texts, batch.column("lines").to_pylist(), strict=True):
            lines = (text or b"").split(b"\n")
            drop = set(drop or ())
            kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in drop))
            total.append(len(lines))
            gone.append(len(drop))
        yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), batch.column("doc_id"), pa.array(total, pa.int64()),
                                          pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                                         ["k1", "k2", "doc_id", "n_lines", "n_dropped", "kept"])


def drop_common_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): k1, k2, doc_id, n_lines, n_dropped, kept (UTF-8 bytes of the text left).

    Lines whose key the index holds at its threshold are dropped, all of them; the others stay, joined by \\n.
    Null or empty texts are one empty line, which stays.  Repeated rows are documents of their own and each get a row.
    Other columns are ignored; no rows give no rows.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                      *text_key(docs))
    lines = own.select("k1", "k2", "text").mapInArrow(
        _lines(index.shards, SALTS), "shard int, salt int, kind int, digests binary, places binary, filter binary")
    filters = index.table.mapInArrow(_frequent(index.threshold), INDEX)
    heads = filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(
        "shard", "salt", F.lit(0).alias("kind"), "digests", F.lit(None).cast("binary").alias("places"), "filter")
    stream = _by_shard(heads.unionByName(lines), ["shard", "salt"], ["kind"])
    dropped = stream.mapInArrow(_marked(), "k1 long, k2 long, line long").groupBy("k1", "k2").agg(
        F.collect_set("line").alias("lines"))
    return own.join(materialize(dropped, "dropped-lines"), ["k1", "k2"], "left").mapInArrow(
        _rebuild, "k1 long, k2 long, doc_id long, n_lines long, n_dropped long, kept binary")


def load_index(spark: SparkSession, path: str, shards: int, threshold: int = THRESHOLD) -> LineIndex:
    """Index written with ``index.table.write.parquet(path)``."""
    return LineIndex(spark.read.parquet(path), shards, threshold)
