"""Related-table closure: every vertex reachable from the seeds (W12 scope).

Undirected (``direction='both'``): breadth-first frontier expansion.  Each round joins the new frontier with the edges; the
neighbours of a layer lie in that layer, the one before or the next, so a round compares with two layers, not with all.
Rounds = distance from the seeds to the farthest reached vertex.  ``component_labels`` gives the same closure in a number of
rounds that does not grow with the graph's depth.

Directed (``'out'``): the first ``PLAIN`` steps are taken one at a time.  As long as few vertices are reached they are sent to the
edges, so a step reads the edges once and shuffles none of them.  A graph that goes on after that is deep, and path doubling
takes over.  Pairs of vertices that are exactly 1, 2, 4, ... steps apart are made by joining each
set of pairs with itself, as long as the next set stays within ``GROWTH`` times the edges (counted before it is made).  With the
sets up to 2^k, one round takes the frontier up to 2^(k+1) - 1 steps on, so a long chain takes few rounds, and a bushy
graph falls back to single steps.  Reached vertices that are many or far are kept in layers that are partitioned by vertex
(``Reached``): a round shuffles what it has just reached, never what was reached before.

Edges, frontiers and pairs follow the data, so each is written to ``spark.checkpoint.dir`` (the edges of a directed closure as
a scratch table, the others as reliable checkpoints) and a lost executor only recomputes one round.  Cycles end because a
vertex is only ever added once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, drop_folder, scratch_path

NODE = "table_name"
GROWTH = 2     # a set of pairs holds at most so many times as many rows as there are edges
PLAIN = 8      # steps of a directed closure taken one at a time before pairs are made
FEW = 100_000  # so many reached vertices, at most, are sent to the edges


def related_closure(edges: DataFrame, seeds: DataFrame, direction: str = "both",
                    method: str = "frontier") -> DataFrame:
    """Seeds plus every vertex reachable over ``edges`` (src, dst).

    ``direction='both'`` treats edges as undirected (a table and everything
    related to it, directly or not); ``'out'`` follows src -> dst only.
    ``seeds`` has one column (any name).  Output: one column ``table_name``,
    one row per reached vertex.  ``method='components'`` (undirected only)
    labels connected components instead of walking the frontier: fewer
    rounds on deep graphs such as long chains, more work per round.
    """
    if direction not in ("both", "out"):
        raise ValueError("direction must be 'both' or 'out'")
    if method == "components":
        if direction != "both":
            raise ValueError("method='components' needs direction='both'")
        return related_components(edges, seeds)
    if method != "frontier":
        raise ValueError("method must be 'frontier' or 'components'")
    e = edges.select(F.col("src").cast("string").alias("_src"),
                     F.col("dst").cast("string").alias("_dst"))
    if direction == "both":
        e = e.unionByName(e.select(F.col("_dst").alias("_src"), F.col("_src").alias("_dst")))
    e = e.where(F.col("_src").isNotNull() & F.col("_dst").isNotNull())
    start = checkpointed(seeds.select(F.col(seeds.columns[0]).cast("string").alias(NODE)).where(F.col(NODE).isNotNull()).distinct())
    if direction == "out":
        path = scratch_path(e.sparkSession, "edges")
        try:
            e.write.parquet(path)
            return _directed(e.sparkSession.read.schema(e.schema).parquet(path), start)
        finally:
            drop_folder(e.sparkSession, path)
    e = checkpointed(e.distinct())
    # Reached = the union of the checkpointed frontiers.
    layers = [start]
    while True:
        step = (e.join(layers[-1], e["_src"] == layers[-1][NODE])
                .select(F.col("_dst").alias(NODE)).distinct())
        frontier = checkpointed(step.join(_union(layers[-2:]), NODE, "left_anti"))
        if frontier.isEmpty():
            return _union(layers)
        layers.append(frontier)


def _powers(e: DataFrame, growth: float = GROWTH) -> list[DataFrame]:
    """Pairs (_src, _dst) that are 1, 2, 4, ... steps apart, up to the first set that would be empty or too large."""
    edges = e.count()
    most, powers = growth * edges, [e]
    while 2 ** len(powers) <= edges:  # no shortest path is longer
        last = powers[-1]
        # rows of the join of the pairs with themselves: for each vertex those that end in it times those that start there
        ends = last.groupBy(F.col("_dst").alias("v")).agg(F.count("*").alias("n"))
        starts = last.groupBy(F.col("_src").alias("v")).agg(F.count("*").alias("m"))
        size = ends.join(starts, "v").agg(F.sum(F.col("n").cast("double") * F.col("m"))).first()[0]
        if not size or size > most:
            break
        then = last.select(F.col("_src").alias("_mid"), F.col("_dst").alias("_end"))
        powers.append(checkpointed(last.join(then, F.col("_dst") == F.col("_mid")).select("_src", F.col("_end").alias("_dst")).distinct()))
    return powers


class Reached:
    """Vertices reached so far, in layers partitioned by vertex.

    The layers belong to a session of their own without adaptive plans, because Spark only relies on how a checkpoint is
    partitioned in a plan that it does not change while it runs.  Vertices are distinct, so no partition is hot.
    """

    def __init__(self, spark):
        self.spark = spark
        self.own = spark.newSession()
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        for key, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.shuffle.partitions", str(self.parts)),
                           ("spark.sql.autoBroadcastJoinThreshold", "-1")):
            self.own.conf.set(key, value)
        self.layers: list[DataFrame] = []

    def unseen(self, vertices: DataFrame) -> DataFrame:
        """Distinct ``vertices`` (of the own session) that no layer has; only they are shuffled."""
        new = vertices.repartition(self.parts, NODE)
        for layer in self.layers:
            new = new.join(layer, NODE, "left_anti")
        return new

    def add(self, vertices: DataFrame) -> DataFrame:
        """The ``vertices`` that are new; they are a layer from now on."""
        path = scratch_path(self.spark, "frontier")
        vertices.write.parquet(path)
        self.layers.append(checkpointed(self.unseen(self.own.read.schema(vertices.schema).parquet(path))))
        drop_folder(self.spark, path)
        return self.layers[-1]


def _onward(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """Where ``pairs`` lead from ``vertices``; may repeat."""
    return pairs.join(vertices, pairs["_src"] == vertices[NODE]).select(F.col("_dst").alias(NODE))


def _near(e: DataFrame, start: DataFrame) -> tuple[list[DataFrame], bool]:
    """Layers 0, 1, ... up to ``PLAIN`` steps from ``start``, as long as they hold few vertices, and whether those are all.

    The reached vertices are broadcast, so that no step shuffles or sorts edges.
    """
    layers, reached = [start], start.count()
    while len(layers) <= PLAIN and reached <= FEW:
        step = _onward(e, F.broadcast(layers[-1])).distinct()
        frontier = checkpointed(step.join(F.broadcast(_union(layers)), NODE, "left_anti"))
        new = frontier.count()
        if not new:
            return layers, True
        layers.append(frontier)
        reached += new
    return layers, False


def _directed(e: DataFrame, start: DataFrame) -> DataFrame:
    near, done = _near(e, start)
    if done:
        return _union(near)
    steps, powers, reached = len(near) - 1, [e], Reached(e.sparkSession)
    reached.add(_union(near))
    frontier = near[-1]
    while True:
        if steps == PLAIN:
            powers = _powers(checkpointed(e.distinct()))
        walk = frontier
        for k, pairs in reversed(list(enumerate(powers))):  # 2^k steps or none, ..., 2 steps or none, 1 step or none
            walk = _onward(pairs, walk).unionByName(walk).distinct()
            walk = checkpointed(walk) if k else walk  # the last one is written as it is added
        frontier = reached.add(walk)
        steps += 1
        if frontier.isEmpty():
            return _union([*near, *reached.layers[1:-1]])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label): label = smallest vertex id of the node's undirected component.

    Large-star / small-star alternation (Kiveris et al., 2014): each round is
    a grouped ``min`` plus a join, and the number of rounds grows with the
    logarithm of the component size rather than with its depth, so long
    chains do not need one round per hop.  Each round's edge set and its minima are
    reliable checkpoints: the join of edges and minima then reads two shuffles of its own,
    which Spark can split where a vertex has very many edges.  Vertices only appear through edges.
    """
    base = edges.select(F.col("src").cast("string").alias("u"), F.col("dst").cast("string").alias("v"))
    e = checkpointed(_symmetric(base.where(F.col("u").isNotNull() & F.col("v").isNotNull())))
    n_edges = e.count()
    while True:
        # Large star: attach every larger neighbour of u to the minimum of u's closed neighbourhood.
        m_all = checkpointed(e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = (e.join(m_all, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = checkpointed(_symmetric(large))
        # Small star: attach u and its smaller neighbours to the minimum of those.
        lower = large.where(F.col("v") < F.col("u"))
        m_low = checkpointed(lower.groupBy("u").agg(F.min("v").alias("m")))
        small = (lower.join(m_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(m_low.select("u", F.col("m").alias("v"))))
        new = checkpointed(_symmetric(small))
        n_new = new.count()
        # Converged when the edge set is unchanged.  Count and an order-free
        # hash signature are compared first (one aggregate, no shuffle); the
        # exact set comparison only runs when they agree.
        if n_new == n_edges and _signature(new) == _signature(e) and new.exceptAll(e).isEmpty():
            break
        e, n_edges = new, n_new
    return (e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label"))
            .select(F.col("u").alias(NODE), "label"))


def _signature(e: DataFrame):
    return e.agg(F.bit_xor(F.xxhash64("u", "v"))).first()[0]


def _symmetric(e: DataFrame) -> DataFrame:
    """Both directions of each edge, no self loops, no duplicates."""
    return (e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            .where(F.col("u") != F.col("v")).distinct())


def related_components(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Undirected closure through component labels: same result as
    ``related_closure(edges, seeds, 'both')`` in a number of rounds that does
    not depend on the graph's depth."""
    labels = component_labels(edges)
    seed = (seeds.select(F.col(seeds.columns[0]).cast("string").alias(NODE))
            .where(F.col(NODE).isNotNull()).distinct())
    seed_labels = (seed.join(labels, NODE, "left")
                   .select(F.coalesce("label", NODE).alias("label")).distinct())
    reached = labels.join(seed_labels, "label", "left_semi").select(NODE)
    return reached.unionByName(seed).distinct()
