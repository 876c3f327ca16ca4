"""Scope, closure and refresh-set resolution (goldens G6-G8, both modes)."""

import os

import pytest
from pyspark.sql import functions as F

from parcelwise.operators.closure import related_closure
from parcelwise.operators.selection import refresh_scope, related_names, resolve_refresh_set
from parcelwise.operators.validate import InvalidInput
from parcelwise.session import checkpointed
from parcelwise.sources.control import edges_frame, read_selection, table_list


@pytest.fixture
def model(spark):
    tables = spark.createDataFrame([(t,) for t in ("Sales", "Customer", "Product", "Store", "Orders", "Budget")],
                                   "table_name string")
    parts = spark.createDataFrame(
        [("Sales", "Sales_20250101_20250331"), ("Sales", "Sales_20250401_20250630"),
         ("Sales", "Sales_20250701_20250930"), ("Customer", "Customer"), ("Product", "Product"),
         ("Store", "Store"), ("Orders", "Orders_20250101_20251231"), ("Budget", "Budget")],
        "table_name string, partition_name string")
    edges = edges_frame(spark, [("Sales", "Customer"), ("Sales", "Product"), ("Sales", "Store"),
                                ("Orders", "Customer")])
    return tables, parts, edges


def names(df):
    return sorted((r.table_name, r.partition_name) for r in df.collect())


def test_g6_everything(spark, model):
    tables, parts, _ = model
    scope = refresh_scope(None, tables)
    assert len(names(resolve_refresh_set(scope, parts))) == 8


def test_g7_one_table_with_related(spark, model):
    tables, parts, edges = model
    scope = refresh_scope(table_list(spark, "Store"), tables, edges)
    got = {t for t, _ in names(resolve_refresh_set(scope, parts))}
    # Undirected closure: Store - Sales - Customer/Product - Orders.
    assert got == {"Sales", "Customer", "Product", "Store", "Orders"}
    out_only = refresh_scope(table_list(spark, "Sales"), tables, edges, direction="out")
    assert sorted(r.table_name for r in out_only.collect()) == ["Customer", "Product", "Sales", "Store"]


def test_g8_chosen_partitions_both_modes(spark, model):
    tables, parts, edges = model
    scope = refresh_scope(table_list(spark, "Sales"), tables, edges, direction="out")
    sel = read_selection(spark, '[{"table":"Sales","selected_partitions":'
                                '["Sales_20250101_20250331","Sales_20250401_20250630"]}]')
    documented = names(resolve_refresh_set(scope, parts, sel, "documented"))
    assert documented == [("Customer", "Customer"), ("Product", "Product"),
                          ("Sales", "Sales_20250101_20250331"), ("Sales", "Sales_20250401_20250630"),
                          ("Store", "Store")]
    only = names(resolve_refresh_set(scope, parts, sel, "selected_only"))
    assert only == [("Sales", "Sales_20250101_20250331"), ("Sales", "Sales_20250401_20250630")]


def test_duplicates_count_once(spark, model):
    tables, parts, _ = model
    scope = refresh_scope(None, tables)
    sel = read_selection(spark, [{"table": "Sales", "selected_partitions": "Sales_20250101_20250331"},
                                 {"table": "Sales", "selected_partitions":
                                  "Sales_20250101_20250331, Sales_20250101_20250331"}])
    got = names(resolve_refresh_set(scope, parts, sel, "selected_only"))
    assert got == [("Sales", "Sales_20250101_20250331")]


def test_errors_and_fallbacks(spark, model, caplog):
    tables, parts, edges = model
    with pytest.raises(ValueError, match="invalid table names"):
        refresh_scope(table_list(spark, "Sales,Ghost"), tables, edges)
    scope = refresh_scope(table_list(spark, "Sales"), tables, edges, direction="out")
    bad = read_selection(spark, '[{"table":"Sales","selected_partitions":"Sales_19990101_19990331"}]')
    with pytest.raises(ValueError, match="invalid partitions"):
        resolve_refresh_set(scope, parts, bad)
    # Some selected tables unavailable: warning, the rest is honoured.
    mixed = read_selection(spark, '[{"table":"Sales","selected_partitions":"Sales_20250101_20250331"},'
                                  '{"table":"Budget","selected_partitions":"Budget"}]')
    with caplog.at_level("WARNING"):
        got = names(resolve_refresh_set(scope, parts, mixed, "selected_only"))
    assert got == [("Sales", "Sales_20250101_20250331")]
    assert "Budget" in caplog.text
    # Every selected table unavailable: everything in scope.
    none_ok = read_selection(spark, '[{"table":"Budget","selected_partitions":"Budget"}]')
    assert len(names(resolve_refresh_set(scope, parts, none_ok, "selected_only"))) == 6


def test_closure_stops_on_cycles_and_chains(spark):
    ring = edges_frame(spark, [(f"v{i}", f"v{(i + 1) % 6}") for i in range(6)] + [("x", "y")])
    seeds = spark.createDataFrame([("v0",)], "s string")
    assert sorted(r.table_name for r in related_closure(ring, seeds).collect()) == [f"v{i}" for i in range(6)]
    chain = edges_frame(spark, [(f"c{i}", f"c{i + 1}") for i in range(12)])
    out = related_closure(chain, spark.createDataFrame([("c5",)], "s string"), direction="out")
    assert sorted(r.table_name for r in out.collect()) == sorted(f"c{i}" for i in range(5, 13))


def test_components_match_frontier(spark):
    import random

    rnd = random.Random(7)
    pairs = [(f"n{rnd.randrange(60)}", f"n{rnd.randrange(60)}") for _ in range(45)]
    pairs += [(f"k{i:03d}", f"k{i + 1:03d}") for i in range(40)]  # a long chain
    g = edges_frame(spark, pairs)
    for seed in ("n1", "n7", "k020", "lonely"):
        seeds = spark.createDataFrame([(seed,)], "s string")
        a = sorted(r.table_name for r in related_closure(g, seeds).collect())
        b = sorted(r.table_name for r in related_closure(g, seeds, method="components").collect())
        assert a == b, seed


def test_hub_and_directed_cycle(spark):
    """A vertex with very many edges, and back edges to layers further up."""
    hub = edges_frame(spark, [("hub", f"leaf{i:04d}") for i in range(2000)])
    for method in ("frontier", "components"):
        assert related_closure(hub, spark.createDataFrame([("leaf0007",)], "s string"), method=method).count() == 2001
    loop = edges_frame(spark, [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("d", "b")])
    got = related_closure(loop, spark.createDataFrame([("a",)], "s string"), direction="out")
    assert sorted(r.table_name for r in got.collect()) == list("abcd")


def test_a_hub_join_can_be_split(spark):
    """The minima are read from a checkpoint, so both sides of the hub's join have a shuffle of their own and AQE
    splits the hub's rows over several tasks."""
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        e = checkpointed(spark.range(60_000).selectExpr("if(id % 10 < 8, 'hub', cast(id as string)) as u", "cast(id as string) as v").repartition(8))
        minima = checkpointed(e.groupBy("u").agg(F.min("v").alias("m")))
        joined = e.join(minima, "u")
        assert joined.count() == 60_000
        rows = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in rows) < 30_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_related_names_equal_the_closure(spark):
    pairs = [("a", "b"), ("b", "c"), ("x", "y"), ("c", "a"), ("d", "c")]
    seeds = spark.createDataFrame([("b",)], "s string")
    for direction in ("both", "out"):
        want = sorted(r.table_name for r in related_closure(edges_frame(spark, pairs), seeds, direction).collect())
        assert related_names(pairs, ["b"], direction) == want


@pytest.mark.parametrize("text", ['[{"table": "Sales", "selected_partitions": "Sales_2025', "not json", '{"tabel": "Sales", "selected_partitions": "x"}',
                                  '[{"table": "Sales"}]', '[{"table": "Sales", "selected_partitions": ""}]', "[]",
                                  '[{"table": "Sales", "selected_partitions": " , "}]', '[{"table": "Sales", "selected_partitions": []}]', '["Sales"]', "3"])
def test_a_bad_selection_never_widens(spark, text):
    with pytest.raises(ValueError):
        read_selection(spark, text)


def test_a_bad_selection_frame_never_widens(spark, model):
    tables, parts, _ = model
    scope = refresh_scope(None, tables)
    for rows in ([], [("Sales", " , ")], [(None, "x")], [("", "x")], [("Sales", None)]):
        with pytest.raises(ValueError):
            resolve_refresh_set(scope, parts, spark.createDataFrame(rows, "table string, selected_partitions string"))


def test_a_list_without_a_name_is_no_list(spark):
    assert table_list(spark, None) is None
    assert table_list(spark, "  ") is None
    assert sorted(r.table_name for r in table_list(spark, "a,,b , a").collect()) == ["a", "b"]
    for empty in (",", " , ", [" "], []):
        with pytest.raises(ValueError, match="names no table"):
            table_list(spark, empty)


def test_every_problem_is_reported(spark, caplog):
    """More than sixty unknown, unavailable and invalid names: all of them are named and counted."""
    tables = spark.createDataFrame([("T",)], "table_name string")
    parts = spark.createDataFrame([("T", "T_1")], "table_name string, partition_name string")
    with pytest.raises(InvalidInput) as unknown:
        refresh_scope(table_list(spark, [f"ghost{i}" for i in range(70)]), tables)
    assert unknown.value.count == 70
    assert {p["table_name"] for p in unknown.value.problems} == {f"ghost{i}" for i in range(70)}
    bad = read_selection(spark, [{"table": "T", "selected_partitions": [f"T_{i}" for i in range(1, 66)]}])
    with pytest.raises(InvalidInput) as invalid:
        resolve_refresh_set(tables, parts, bad)
    assert invalid.value.count == 64
    assert "T_65" in str(invalid.value)
    away = read_selection(spark, [{"table": "T", "selected_partitions": "T_1"}]
                          + [{"table": f"U{i}", "selected_partitions": "U"} for i in range(61)])
    with caplog.at_level("WARNING"):
        assert names(resolve_refresh_set(tables, parts, away, "selected_only")) == [("T", "T_1")]
    assert "61 selected tables" in caplog.text
    assert all(f"U{i}" in caplog.text for i in range(61))


def test_selection_is_computed_once(spark, model, tmp_path):
    """What the selection is derived from is read once for all checks and the result."""
    tables, parts, _ = model
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r
    sel = spark.createDataFrame(spark.sparkContext.parallelize([("Sales", "Sales_20250101_20250331")], 1).mapPartitions(count),
                                "table string, selected_partitions string")
    resolve_refresh_set(refresh_scope(None, tables), parts, sel).collect()
    assert seen.value == 1


def _chain(n):
    return [(f"c{i}", f"c{i + 1}") for i in range(n)]


def test_directed_closure_equals_brute_force(spark):
    """Random directed graphs with cycles, hubs, self loops and null ends."""
    import random

    from parcelwise.operators.closure import related_closure

    rnd = random.Random(8)
    for n, m in ((30, 25), (30, 60), (60, 90)):
        edges = [(f"v{rnd.randrange(n)}", f"v{rnd.randrange(n)}") for _ in range(m)] + [("hub", f"v{i}") for i in range(n)] + [(f"v{n // 2}", "hub"), ("x", None), (None, "y")] + _chain(20) + [("c20", "c5")]
        seeds = ["v1", "c0", "alone", None, "v1"]
        reached, todo = {s for s in seeds if s}, [s for s in seeds if s]
        while todo:
            v = todo.pop()
            new = {d for s, d in edges if s == v and d} - reached
            reached |= new
            todo += new
        got = related_closure(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(s,) for s in seeds], "v string"), "out")
        assert sorted(r.table_name for r in got.collect()) == sorted(reached)
    assert related_closure(spark.createDataFrame([], "src string, dst string"), spark.createDataFrame([("a",)], "v string"), "out").count() == 1


def test_a_long_directed_chain_takes_few_rounds(spark, monkeypatch):
    from parcelwise.operators import closure

    rounds = []
    own = closure.Reached.add
    monkeypatch.setattr(closure.Reached, "add", lambda self, v: rounds.append(1) or own(self, v))
    got = closure.related_closure(spark.createDataFrame(_chain(1000), "src string, dst string"), spark.createDataFrame([("c3",)], "v string"), "out")
    assert got.count() == 998 and len(rounds) <= 4


def test_pairs_stay_bounded(spark):
    """A bushy graph falls back to single steps: no set of pairs exceeds its bound."""
    from parcelwise.operators.closure import GROWTH, _powers

    edges = [(f"a{i}", f"a{(i * 7 + k * 13) % 200}") for i in range(200) for k in range(5)]
    e = spark.createDataFrame(edges, "_src string, _dst string").distinct()
    powers = _powers(e)
    assert len(powers) == 1
    chain = spark.createDataFrame(_chain(100), "_src string, _dst string")
    assert [p.count() for p in _powers(chain)] == [100, 99, 97, 93, 85, 69, 37] and max(p.count() for p in _powers(chain)) <= GROWTH * 100


def test_a_round_shuffles_only_its_frontier(spark):
    from parcelwise.operators.closure import Reached

    reached = Reached(spark)
    for k in range(3):
        reached.add(spark.createDataFrame([(f"v{i}",) for i in range(10 * k, 10 * k + 15)], "table_name string"))
    path = __import__("parcelwise.session", fromlist=["scratch_path"]).scratch_path(spark, "t-frontier")
    spark.createDataFrame([("v1",), ("new",)], "table_name string").write.parquet(path)
    new = reached.unseen(reached.own.read.parquet(path))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("LeftAnti") == 3  # the frontier's own
    assert [r.table_name for r in new.collect()] == ["new"]
    assert [layer.count() for layer in reached.layers] == [15, 10, 10]


def test_selection_from_a_file(spark, tmp_path):
    """A JSON array or a record per line; a file that is no JSON or holds nothing fails."""
    import json

    from parcelwise.sources.control import read_selection

    records = [{"table": "orders", "selected_partitions": ["a", "b"]}, {"table": "events", "selected_partitions": "c"}]
    want = [("orders", "a,b"), ("events", "c")]
    for name, text in (("array", json.dumps(records, indent=1)), ("lines", "\n".join(map(json.dumps, records)))):
        path = tmp_path / f"{name}.json"
        path.write_text(text)
        assert [tuple(r) for r in read_selection(spark, str(path)).collect()] == want
    for name, text in (("broken", '[{"table": "orders"'), ("empty", ""), ("none", "[]"), ("other", '[{"tabel": "orders"}]')):
        path = tmp_path / f"{name}.json"
        path.write_text(text)
        with pytest.raises(ValueError):
            read_selection(spark, str(path))


@pytest.mark.parametrize("few, plain", [(100_000, 8), (3, 8), (100_000, 1), (0, 0), (0, 3)])
def test_directed_closure_near_and_far(spark, monkeypatch, few, plain):
    """Few or many vertices, shallow or deep: each way of walking gives the same vertices, and the edges' scratch table goes."""
    from parcelwise.operators import closure

    dropped, own = [], closure.drop_folder
    monkeypatch.setattr(closure, "drop_folder", lambda s, path: dropped.append(path) or own(s, path))
    monkeypatch.setattr(closure, "FEW", few)
    monkeypatch.setattr(closure, "PLAIN", plain)
    edges = _chain(14) * 2 + [("c14", "c9"), ("c2", "c2"), ("c3", None), (None, "c4"), ("far", "c1")] + [("c4", f"leaf{i}") for i in range(5)]
    seeds = spark.createDataFrame([("c1",), (None,), ("c1",), ("alone",)], "v string")
    got = closure.related_closure(spark.createDataFrame(edges, "src string, dst string"), seeds, "out")
    assert sorted(r.table_name for r in got.collect()) == sorted([f"c{i}" for i in range(1, 15)] + [f"leaf{i}" for i in range(5)] + ["alone"])
    assert any("parcelwise-edges" in path for path in dropped) and not any(os.path.exists(path.removeprefix("file:")) for path in dropped)


def test_a_shallow_directed_closure_makes_no_pairs(spark, monkeypatch):
    """Four steps from one vertex of very many: no pairs, and no frame as large as the edges is checkpointed."""
    from parcelwise.operators import closure

    sizes, own = [], closure.checkpointed
    monkeypatch.setattr(closure, "checkpointed", lambda df: sizes.append((out := own(df)).count()) or out)
    monkeypatch.setattr(closure, "_powers", lambda e, growth=2: pytest.fail("pairs were made"))
    ids = spark.range(4000)
    edges = ids.selectExpr("concat('a', id) AS src", "concat('b', id) AS dst") \
        .unionByName(ids.selectExpr("concat('b', id) AS src", "concat('c', id % 50) AS dst")) \
        .unionByName(spark.range(50).selectExpr("concat('c', id) AS src", "concat('d', id % 5) AS dst"))
    got = closure.related_closure(edges, spark.createDataFrame([("a7",)], "v string"), "out")
    assert sorted(r.table_name for r in got.collect()) == ["a7", "b7", "c7", "d2"] and max(sizes) == 1
