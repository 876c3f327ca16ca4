"""A training corpus from ``documents``: toxic, near-duplicate and contaminated documents go, then mix and shards.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as
Parquet and read again as the next one's docs.  All but the last return the columns of ``documents``; the last adds
``shard`` and ``slot``.  Null and repeated rows, empty tables and further columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelwise.llm.common import materialize, table
from parcelwise.llm.decontaminate import drop_contaminated
from parcelwise.llm.mixing import take_mix
from parcelwise.llm.near_dup import keep_one_of_each
from parcelwise.llm.sharding import place_in_shards
from parcelwise.llm.toxicity import drop_toxic, fit


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject."""
    return drop_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8 or more): the least doc_id."""
    return keep_one_of_each(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return take_mix(docs)


def make_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard (0 to 15) and slot in it."""
    return place_in_shards(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("make_shards", make_shards)]

#: SQL cannot express the learned first stage; the tests hold each operator against brute force and run() against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
