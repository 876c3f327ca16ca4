"""MinHash near-duplicate detection with circulant signatures.

Method: two permutations make all signature coordinates.  One (sigma) places a
shingle on a ring of ``2**RING_BITS`` cells; the other (pi) is a random
permutation of the ring, and coordinate k is the minimum of pi shifted by k.
The coordinates of one shingle are therefore one contiguous slice of pi, and a
signature is the element-wise minimum of slices.  Signatures are cut into bands;
documents that share a band are candidates, and every link is confirmed on the
full shingle sets.

Scale: rows with the same set are one node, so exact copies never meet each
other.  Within a band bucket every member is compared with two leaders of the bucket,
the one that meets most others and the least (a star, never all pairs).  Buckets whose members are then still in several
components are finished by an exact prefix-filtered join on rare shingles
between different components, so no link between different sets is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, materialize, repeated_keys, text_key, whole_row_key
from .components import connected_components
from .words import SPACED, mix64, shingle_runs, text_chunks, words_of

RING_BITS = 20
BANDS, ROWS = 32, 6
SEED = 11


def ring_slices(coordinates: int, seed: int = SEED) -> np.ndarray:
    """Row x holds pi[x], pi[x+1], ... (circular): a view, not a copy."""
    pi = np.random.RandomState(seed).permutation(1 << RING_BITS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:coordinates - 1]]), coordinates)


def signature(shingles: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Circulant MinHash of a non-empty set of 64-bit shingle hashes."""
    cells = (mix64(shingles ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(64 - RING_BITS)).astype(np.int64)
    out = slices[cells[:2048]].min(axis=0)
    for i in range(2048, len(cells), 2048):
        np.minimum(out, slices[cells[i:i + 2048]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band (the band's number is part of it)."""
    parts = sig.reshape(bands, rows).astype(np.uint64)
    key = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    for j in range(rows):
        key = mix64(key + parts[:, j])
    return key.view(np.int64)


def _chunk_sets(texts: pa.Array, width: int):
    """(first row, end row, the sorted shingle set of each text) for chunks of a column."""
    for lo, hi, data, offsets in text_chunks(texts):
        words, at = words_of(data, offsets, SPACED)
        yield lo, hi, [np.unique(s) for s in shingle_runs(words, at, width)]


def _signatures(width: int, bands: int, rows: int):
    def run(batches):
        slices = ring_slices(bands * rows)
        for batch in batches:
            for lo, hi, sets in _chunk_sets(batch.column("text"), width):
                part = batch.slice(lo, hi - lo)
                ids = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
                keys = [band_keys(signature(s, slices), bands, rows) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1"), part.column("k2"), part.column("doc_id"),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64()))],
                    ["k1", "k2", "doc_id", "n_shingles", "node", "bands"])
    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            for lo, hi, sets in _chunk_sets(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(lo, hi - lo).column("node"),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "shingles"])
    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .withColumn("common", F.size(F.array_intersect("sa", "sb"))))
    return both.where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.size("sa") + F.size("sb") - F.col("common"))) \
        .select("a", "b")


def _sizes_allow(x: str, y: str, percent: int):
    return (F.lit(100) * F.least(x, y) >= F.lit(percent) * F.greatest(x, y))


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5,
                    bands: int = BANDS, rows: int = ROWS, key: list[Column] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): k1, k2, doc_id, n_shingles, label, component_id, kept.

    Words are runs without ASCII white space, lower-cased in A-Z.  Null, empty or blank
    texts have the empty set, link with nothing and are their own component.
    component_id is the smallest non-null doc_id reachable (null only where a
    component has none); kept is doc_id = component_id (false for null ids).
    label tells components apart (null for an empty set).  Repeated rows each get a row.  Other columns of ``docs`` only
    count where ``key`` (two columns k1, k2; by default of doc_id and text) has them.
    """
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"),
                      *(key or text_key(docs)))
    described = materialize(own.select("k1", "k2", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _signatures(width, bands, rows),
        "k1 long, k2 long, doc_id long, n_shingles long, node long, bands array<long>"), "signatures")
    nodes = materialize(described.where("node IS NOT NULL").groupBy("node").agg(
        F.min_by(F.struct("k1", "k2", "bands"), F.struct("k1", "k2")).alias("first"),
        F.min("n_shingles").alias("n")).select("node", "n", "first.k1", "first.k2", "first.bands"), "nodes")

    members = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    buckets = materialize(members.groupBy("bucket").agg(F.min("node").alias("low"), F.count("*").alias("m")).where("m > 1"),
                          "buckets")
    shared = materialize(members.join(buckets, "bucket"), "members")
    sized = materialize(shared.groupBy("node").agg(F.first("n").alias("n"), F.sum("m").alias("met")), "sized")
    # the member that meets most others is the one nearest to what a group of copies has in common
    central = materialize(shared.select("node", "bucket").join(sized.select("node", "met"), "node")
                          .groupBy("bucket").agg(F.max_by("node", F.struct("met", "node")).alias("high")), "central")
    stars = shared.select("node", "bucket", "low").join(central, "bucket") \
        .select("node", F.explode(F.array_distinct(F.array("low", "high"))).alias("leader")) \
        .where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")) \
        .distinct()
    sizes = lambda side: sized.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"))
    stars = stars.join(sizes("a"), "a").join(sizes("b"), "b").where(_sizes_allow("na", "nb", percent)).select("a", "b")

    wanted = nodes.join(sized.select("node"), "node", "left_semi").select("k1", "k2", "node")
    sets = materialize(own.join(wanted, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("node", "text").mapInArrow(
        _sets(width), "node long, shingles array<long>"), "sets")
    links = materialize(_confirm(stars, sets, percent), "links")
    labels = connected_components(links)

    more = materialize(_confirm(_open_pairs(shared, labels, sets, percent), sets, percent), "more-links")
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))

    rows_ = described.drop("bands").join(labels.select(F.col("node"), "label"), "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    rows_ = materialize(rows_, "rows")
    least = materialize(rows_.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id")),
                        "least")
    return (rows_.join(least, "label", "left")
            .withColumn("component_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
            .select("k1", "k2", "doc_id", "n_shingles", "label", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")))


def keep_one_of_each(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id's (a null id only where there is no other).

    Rows with an empty set all stay.  All columns are returned as they are.
    """
    found = near_duplicates(docs, percent, width, key=whole_row_key(docs))
    found = materialize(found.select("k1", "k2", "doc_id", "label"), "near-duplicates")
    first = found.where("label IS NOT NULL").groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("s")).select("s.k1", "s.k2", F.lit(1).alias("times"))
    alone = found.where("label IS NULL").select("k1", "k2", F.lit(None).cast("int").alias("times")).distinct()
    return keep_rows(docs, first.unionByName(alone), "times", whole_row_key(docs), repeated_keys(found))


def _open_pairs(shared: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs between different components that meet in some bucket.

    Exact: two sets that pass the threshold share one of the rarest
    n - ceil(percent * n / 100) + 1 shingles of each, under one global order (rarity, then hash), and from the first
    one they share on, each still has at least as many shingles that others share as their intersection needs.
    """
    tagged = shared.select("node", "n", "bucket").join(labels, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    tagged = materialize(tagged, "tagged")
    open_ = materialize(tagged.groupBy("bucket").agg(F.min("label").alias("l0"), F.max("label").alias("l1"))
                        .where("l0 <> l1").select("bucket"), "open-buckets")
    left = materialize(tagged.join(open_, "bucket", "left_semi").select("node", "n", "label").distinct(), "open-nodes")
    tokens = left.join(sets, "node").select("node", "n", "label", F.explode("shingles").alias("token"))
    rarity = materialize(tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("label").alias("l0"),
                                                     F.max("label").alias("l1")).where("df > 1"), "rarity")
    # Shingles of one node only come first in its order but can make no pair: they only use up prefix places.
    known = tokens.join(rarity, "token").groupBy("node", "n", "label").agg(
        F.array_sort(F.collect_list(F.struct("df", "token", "l0", "l1"))).alias("shared"))
    known = known.withColumn("m", F.size("shared"))
    places = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1 - (F.col("n") - F.col("m"))
    prefix = materialize(known.withColumn("places", places.cast("int")).where("places > 0").select(
        "node", "n", "label", "m", F.posexplode(F.slice("shared", F.lit(1), F.col("places"))).alias("at", "t"))
        .where("t.l0 <> t.l1").select("node", "n", "label", (F.col("m") - F.col("at")).alias("rest"), F.col("t.token").alias("token")),
        "prefix")
    a = prefix.select("token", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "label", "rest")])
    b = prefix.select("token", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "label", "rest")])
    # from the first common shingle on, both must still have as many shared shingles as the intersection needs
    reaches = F.least("rest_a", "rest_b") * (100 + percent) >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))
    return (a.join(b, "token").where("node_a < node_b AND label_a <> label_b")
            .where(_sizes_allow("n_a", "n_b", percent) & reaches)
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())
