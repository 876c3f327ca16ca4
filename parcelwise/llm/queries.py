"""Registered queries of the corpus operators: each derives its contract's columns from an operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import contamination
from .language_id import id_fold, identify, learn
from .line_dedup import LineIndex, drop_common_lines
from .mixing import mix
from .near_dup import near_duplicates
from .nearest import nearest
from .pii import KINDS, find_personal_data, learn as learn_pii
from .ranked_search import rank_documents
from .sharding import shard
from .suffix_dedup import remove_repeats
from .token_frames import read_tokens, write_tokens
from .toxicity import fit, score
from .whitening import whiten


def op1_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, manifest).drop("ids")


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return drop_common_lines(docs, LineIndex.build(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return identify(docs, learn(docs.where(~held_out)), keep=held_out).withColumnRenamed("held", "held_out")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_fold(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = score(docs, fit(docs.where(~held_out), labels.where(~held_out)), keep=held_out)
    return scored.select("doc_id", F.col("held").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_personal_data(docs, learn_pii(docs))
    names = F.lit(list(KINDS))
    joined = lambda spans: F.array_join(F.transform(  # noqa: E731 - by start, then kind as listed
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_frames": op1_token_frames,
    "op2_shards": op2_shards,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_mix": op8_mix,
    "op9_nearest": op9_nearest,
    "op10_near_dup": op10_near_dup,
    "op11_pii": op11_pii,
    "op12_whitening": op12_whitening,
    "op13_ranked_search": op13_ranked_search,
}
