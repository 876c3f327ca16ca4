"""Connected components of a link table by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the least node reachable.

    Each round takes the least label among a node's neighbours, then the label of
    that label; both tables of a round are written to the shared folder, so a
    round never recomputes earlier ones.  No links give no rows.
    """
    both = materialize(links.select(F.col("a").alias("x"), F.col("b").alias("y"))
                       .unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), "edges")
    labels = materialize(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label"))
                         .select(F.col("x").alias("node"), "label"), "labels")
    while True:
        jumped = labels.alias("l").join(labels.alias("m"), F.col("l.label") == F.col("m.node"), "left").select(
            F.col("l.node").alias("node"), F.col("l.label").alias("old"),
            F.coalesce("m.label", "l.label").alias("label"))
        jumped = materialize(jumped, "jumped")
        around = both.join(jumped.select(F.col("node").alias("y"), "label"), "y").groupBy("x") \
            .agg(F.min("label").alias("near"))
        step = materialize(jumped.join(around.withColumnRenamed("x", "node"), "node").select(
            "node", "old", F.least("label", "near").alias("label")), "step")
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            return labels
