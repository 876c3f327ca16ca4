"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Method: every document of a source has the same expected number of copies,
target / source size.  The prefix sum of that number over the source's documents, plus
one random offset, crosses an integer boundary once per copy that is emitted.
Documents stand in order of size class, salt, size and id, so each stretch of the
line holds documents of near the same size and a source's taken words come close to its target.

Scale: the prefix sum is made in two levels.  A source is cut into blocks (size class and a
salt of id and text whose range grows with the rows of that class), rows are numbered inside their block, and only
the per-block counts are summed per source.  Equal rows that are more than a block have blocks of their own: they stand together, so
which of them takes which place makes no difference.  No task holds a whole source, id or text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import EQUAL_ROWS, keep_rows, materialize, text_key, whole_row_key

#: fixed values of the mix: weights by rank of the source, share of all sizes, most copies of a size
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
SEED = 17
BLOCK_ROWS = 1000
_WORD = r"[^\x20\x09-\x0D]+"
_BINS = 4  # size classes per doubling


def word_count(text: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size): one row per source.

    Sources rank by code point, null last, and take the weights in turn.  Targets share
    ``share`` of all sizes by weight; none exceeds ``most`` times its source's size, and the
    excess goes to the others by weight: with sources in order of size / weight, those below
    the water level are full and the rest share what is left.
    """
    one = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("rank", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long"))
    order = one.orderBy((F.col("source_size") / F.col("weight")).asc(), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (ranked
             .withColumn("total", F.sum("source_size").over(one))
             .withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             .withColumn("open", F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
             .withColumn("left", F.lit(share) * F.col("total") - F.lit(most) * F.col("full"))
             .withColumn("fits", F.col("left") * F.col("weight") / F.col("open") <= F.lit(most) * F.col("source_size")))
    # the first source in this order that is not filled sets the level for itself and all after it
    first = level.withColumn("key", F.when(F.col("fits"), F.row_number().over(order))) \
        .withColumn("from_", F.min("key").over(one)).withColumn("place", F.row_number().over(order))
    at = lambda c: F.max(F.when(F.col("place") == F.col("from_"), F.col(c))).over(one)
    return (first.withColumn("l", at("left")).withColumn("o", at("open"))
            .withColumn("target", F.when(F.col("place") < F.coalesce("from_", F.lit(1 << 62)),
                                         F.lit(most) * F.col("source_size"))
                        .otherwise(F.col("l") * F.col("weight") / F.col("o")))
            .select("source", "source_size", "weight", "target"))


def unit(seed: int, source: Column) -> Column:
    """Offset in [0, 1) drawn from the seed and the source: the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED,
        key: list[Column] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): k1, k2, doc_id, source, size, source_size, target, copies.

    copies is 0, 1, ... (at most ``most``, rounded up).  A null text has size 0; null is a source of its
    own; a source without words gets no copies.  Repeated rows are documents of their own (equal rows may
    swap their copies), and rows with a null or the same id are told apart by their texts.  Other columns are ignored; no rows give no rows.
    """
    salt = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary"))
    sized = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string")
                                    .alias("source"), word_count(F.col("text")).alias("size"),
                                    F.conv(F.substring(salt, 1, 8), 16, 10).cast("long").alias("salt"),
                                    F.monotonically_increasing_id().alias("tie"), *(key or text_key(docs))), "sizes")
    hot = materialize(sized.groupBy(F.col("source").alias("h_source"), F.col("k1").alias("h1"), F.col("k2").alias("h2"))
                      .agg(F.count("*").alias("h_rows")).where(F.col("h_rows") > BLOCK_ROWS), "hot")
    # integer size class: doublings from the bit length, each cut in equal parts
    bin_ = F.expr(f"if(size = 0, -1L, (length(bin(size)) - 1) * {_BINS}L + (size - shiftleft(1L, length(bin(size)) - 1))"
                  f" * {_BINS}L div shiftleft(1L, length(bin(size)) - 1))")
    binned = sized.withColumn("bin", bin_)
    counts = binned.groupBy(F.col("source").alias("of"), F.col("bin").alias("class")).agg(F.count("*").alias("rows"))
    placed = binned.join(counts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("class"))) \
        .withColumn("salt", F.pmod("salt", F.ceil(F.col("rows") / BLOCK_ROWS))).drop("of", "class", "rows")
    placed = placed.join(hot, F.col("source").eqNullSafe(F.col("h_source")) & (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")), "left") \
        .withColumn("part", F.pmod(F.xxhash64("tie"), F.ceil(F.col("h_rows") / BLOCK_ROWS))).drop("h_source", "h_rows", "tie")
    keys = ["source", "bin", "salt", "h1", "h2", "part"]
    blocks = materialize(placed.groupBy(*keys).agg(F.count("*").alias("m"), F.sum("size").alias("words")), "blocks")
    along = Window.partitionBy("source").orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    starts = (blocks.withColumn("before", F.coalesce(F.sum("m").over(along), F.lit(0)))
              .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "m", "words"))
    inside = Window.partitionBy(*keys).orderBy("size", "doc_id", "k2")
    numbered = placed.withColumn("i", F.row_number().over(inside))
    starts = starts.select(*[F.col(c).alias(f"b_{c}") for c in keys], "before", "source_size", "target")
    joined = numbered.join(starts, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in keys])
    # rate in units of 2^-20; products stay exact in decimals
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * (1 << 20))).otherwise(0)
    place = (F.col("before") + F.col("i")).cast("decimal(20,0)")
    units = lambda p: (p * F.col("rate").cast("decimal(12,0)") + F.col("offset").cast("decimal(12,0)"))
    count = lambda p: F.floor(units(p) / F.lit(1 << 20).cast("decimal(12,0)"))
    return (joined.withColumn("rate", rate.cast("long"))
            .withColumn("offset", F.floor(unit(seed, F.col("source")) * (1 << 20)))
            .withColumn("copies", (count(place) - count(place - 1)).cast("long"))
            .select("k1", "k2", "doc_id", "source", "size", "source_size", "target", "copies"))


def take_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as it has copies, all columns as they are."""
    key = whole_row_key(docs)
    copies = materialize(mix(docs, weights, share, most, seed, key).groupBy("k1", "k2").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0"), "copies")
    return keep_rows(docs, copies, "copies", key, copies.where(F.col("rows") > EQUAL_ROWS).select("k1", "k2", "rows"))
