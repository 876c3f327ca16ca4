"""Materialise, retire the catch-all, refresh (both modes), report."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from parcelwise.plans.orchestrate import run
from parcelwise.plans.partition import (
    TableBinding,
    materialize_partitions,
    partition_tables,
    retire_default,
    write_default_partition,
)
from parcelwise.plans.refresh import refresh
from parcelwise.operators.assign import assign_partition, partition_profile
from parcelwise.operators.ranges import period_ranges
from parcelwise.operators.validate import pending_partitions
from parcelwise.session import local_path, scratch_path
from parcelwise.sources.control import read_spec
from parcelwise.sources.storage import partition_dir, read_manifest, read_snapshot, read_table

D = dt.date
AS_OF = D(2001, 8, 1)
SPEC = [{"table": "orders", "first_date": "19950215", "partition_by": "o_orderdate", "interval": "YEAR"}]


def _orders(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet")


def _profile(spark, root):
    data = read_table(spark, root)
    return {r.partition_name: r.n_rows for r in
            data.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows")).collect()}


def _expected(orders, keep=None):
    tagged = assign_partition(orders, "orders", "o_orderdate", "YEAR", "19950215", AS_OF)
    if keep is not None:
        tagged = tagged.where(keep)
    return {r.partition_name: r.n_rows for r in partition_profile(tagged, "o_orderdate", "orders").collect()}


def _files(root, name):
    """Files of a partition in the write that the manifest names."""
    held = read_snapshot(SparkSession.getActiveSession(), root).partitions[name]
    return sorted(glob.glob(os.path.join(local_path(partition_dir(root, held)), "*.parquet")))


def test_g9_materialize_and_retire_default(spark, sf_small):
    orders = _orders(spark, sf_small)
    root = scratch_path(spark, "t-orders")
    write_default_partition(orders, root, "orders")
    assert _profile(spark, root) == {"orders": orders.count()}
    created = partition_tables(spark, SPEC, {"orders": TableBinding(orders, root, "o_orderdate")}, AS_OF)
    assert len(created["orders"]) == 7
    assert _profile(spark, root) == _expected(orders)  # catch-all gone, rows before first_date too
    manifest = read_manifest(spark, root)
    assert manifest.where(F.col("partition_name") == "orders").count() == 0
    # W7 after W13 is empty; a second run creates nothing.
    expected = period_ranges(read_spec(spark, SPEC), AS_OF)
    assert pending_partitions(expected, manifest).count() == 0
    again = partition_tables(spark, SPEC, {"orders": TableBinding(orders, root, "o_orderdate")}, AS_OF)
    assert again == {"orders": []}


def test_empty_range_exists_via_manifest_and_overlap_refused(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 5)), (2, D(2020, 3, 9))], "id int, d date")
    root = scratch_path(spark, "t-empty")
    spec = [{"table": "T", "first_date": "20200101", "partition_by": "d", "interval": "MONTH"}]
    partition_tables(spark, spec, {"T": TableBinding(df, root, "d")}, D(2020, 4, 1))
    assert read_manifest(spark, root).count() == 4  # Feb and Apr hold no rows but exist
    assert pending_partitions(period_ranges(read_spec(spark, spec), D(2020, 4, 1)),
                              read_manifest(spark, root)).count() == 0
    quarters = period_ranges(read_spec(spark, [dict(spec[0], interval="QUARTER")]), D(2020, 4, 1))
    with pytest.raises(ValueError, match="overlapping"):
        materialize_partitions(df, root, quarters, "d")


def test_require_covered(spark):
    df = spark.createDataFrame([(1, D(2019, 5, 1)), (2, D(2020, 3, 9))], "id int, d date")
    root = scratch_path(spark, "t-covered")
    write_default_partition(df, root, "T")
    spec = [{"table": "T", "first_date": "20200101", "partition_by": "d", "interval": "YEAR"}]
    with pytest.raises(ValueError, match="would hide"):
        partition_tables(spark, spec, {"T": TableBinding(df, root, "d")}, D(2020, 4, 1),
                         require_covered=True)
    assert _profile(spark, root) == {"T": 2}  # refused before anything is written
    partition_tables(spark, spec, {"T": TableBinding(df.where("id = 2"), root, "d")}, D(2020, 4, 1), require_covered=True)
    assert _profile(spark, root) == {"T_20200101_20201231": 1}
    write_default_partition(df, root, "T")
    with pytest.raises(ValueError, match="would hide"):
        retire_default(spark, root, "T", source=df, date_col="d", require_covered=True)
    assert retire_default(spark, root, "T") is True
    assert _profile(spark, root) == {"T_20200101_20201231": 1}


def _stale_target(spark, orders):
    root = scratch_path(spark, "t-refresh")
    stale = orders.where(F.col("o_orderstatus") == "O")
    partition_tables(spark, SPEC, {"orders": TableBinding(stale, root, "o_orderdate")}, AS_OF)
    return root


def _selection(names):
    return [{"table": "orders", "selected_partitions": ",".join(names)}]


@pytest.mark.parametrize("mode", ["transactional", "partialBatch"])
def test_refresh_only_selected(spark, sf_small, mode):
    orders = _orders(spark, sf_small)
    root = _stale_target(spark, orders)
    chosen = ["orders_19990101_19991231", "orders_20010101_20011231"]
    untouched_before = _files(root, "orders_19970101_19971231")
    binding = {"orders": TableBinding(orders, root, "o_orderdate")}
    report = refresh(spark, binding, "orders", _selection(chosen), mode, max_parallelism=2)
    assert {r.partition_name: (r.status, r.rows) for r in report.collect()} == \
        {n: ("Completed", _expected(orders)[n]) for n in chosen}
    want = _expected(orders, (F.col("o_orderstatus") == "O")
                     | F.year("o_orderdate").isin(1999, 2001))
    assert _profile(spark, root) == want
    assert _files(root, "orders_19970101_19971231") == untouched_before
    # Refreshing twice equals refreshing once.
    refresh(spark, binding, "orders", _selection(chosen), mode, max_parallelism=2)
    assert _profile(spark, root) == want


@pytest.mark.parametrize("mode", ["transactional", "partialBatch"])
def test_emptied_partition_is_cleared(spark, sf_small, mode):
    orders = _orders(spark, sf_small)
    root = _stale_target(spark, orders)
    source = orders.where(F.year("o_orderdate") != 1998)  # 1998 now has no rows
    chosen = ["orders_19980101_19981231", "orders_19990101_19991231"]
    report = refresh(spark, {"orders": TableBinding(source, root, "o_orderdate")}, "orders",
                     _selection(chosen), mode, max_parallelism=2)
    got = {r.partition_name: r.rows for r in report.collect()}
    assert got["orders_19980101_19981231"] == 0
    assert "orders_19980101_19981231" not in _profile(spark, root)


def _failing(orders, year):
    bad = F.year("o_orderdate") == year
    return orders.withColumn("o_totalprice",
                             F.when(bad, F.raise_error(F.lit("boom"))).otherwise(F.col("o_totalprice")))


def test_transactional_failure_publishes_nothing(spark, sf_small):
    orders = _orders(spark, sf_small)
    root = _stale_target(spark, orders)
    before = _profile(spark, root)
    chosen = ["orders_19990101_19991231", "orders_20000101_20001231"]
    binding = {"orders": TableBinding(_failing(orders, 2000), root, "o_orderdate")}
    with pytest.raises(RuntimeError, match="refresh failed"):
        refresh(spark, binding, "orders", _selection(chosen), "transactional")
    report = refresh(spark, binding, "orders", _selection(chosen), "transactional",
                     raise_on_failure=False)
    assert {r.status for r in report.collect()} == {"Failed"}
    assert _profile(spark, root) == before


def test_partial_batch_failure_keeps_the_rest(spark, sf_small):
    orders = _orders(spark, sf_small)
    root = _stale_target(spark, orders)
    before = _profile(spark, root)
    chosen = ["orders_19990101_19991231", "orders_20000101_20001231"]
    binding = {"orders": TableBinding(_failing(orders, 2000), root, "o_orderdate")}
    report = refresh(spark, binding, "orders", _selection(chosen), "partialBatch",
                     max_parallelism=2, raise_on_failure=False)
    status = {r.partition_name: r.status for r in report.collect()}
    assert status == {"orders_19990101_19991231": "Completed", "orders_20000101_20001231": "Failed"}
    after = _profile(spark, root)
    assert after["orders_20000101_20001231"] == before["orders_20000101_20001231"]
    assert after["orders_19990101_19991231"] == _expected(orders)["orders_19990101_19991231"]


def test_run_derives_selection_from_spec(spark, sf_small):
    orders = _orders(spark, sf_small)
    root = scratch_path(spark, "t-run")
    write_default_partition(orders.where(F.col("o_orderstatus") == "O"), root, "orders")
    spec = [dict(SPEC[0], refresh_from="TODAY", number_of_intervals="2")]
    report = run(spark, {"orders": TableBinding(orders, root, "o_orderdate")}, AS_OF,
                 partitions_config=spec)
    assert sorted(r.partition_name for r in report.collect()) == \
        ["orders_20000101_20001231", "orders_20010101_20011231"]
    # Partitions are created from the binding's (full) source, then the two
    # derived ones refreshed: every partition ends with the full rows.
    assert _profile(spark, root) == _expected(orders)


@pytest.mark.parametrize("mode", ["transactional", "partialBatch"])
def test_names_with_special_characters(spark, mode):
    """Table names are data: spaces and characters Spark escapes in directory
    names must round-trip, including when an emptied partition is cleared."""
    table = "Order Lines:EU/#1"
    df = spark.createDataFrame([(i, D(2020, 1, 1) + dt.timedelta(days=i)) for i in range(0, 120, 3)],
                               "id int, d date")
    root = scratch_path(spark, "t-special")
    spec = [{"table": table, "first_date": "20200101", "partition_by": "d", "interval": "MONTH"}]
    partition_tables(spark, spec, {table: TableBinding(df, root, "d")}, D(2020, 4, 30))
    got = _profile(spark, root)
    assert got[f"{table}_20200101_20200131"] == 11 and len(got) == 4
    emptied = df.where(F.month("d") != 2)
    names = [f"{table}_20200201_20200229", f"{table}_20200301_20200331"]
    sel = [{"table": table, "selected_partitions": ",".join(names)}]
    report = refresh(spark, {table: TableBinding(emptied, root, "d")}, [table], sel, mode)
    assert {r.partition_name: r.rows for r in report.collect()} == {names[0]: 0, names[1]: 11}
    after = _profile(spark, root)
    assert names[0] not in after and after[names[1]] == 11


def test_hot_partition_is_split_across_writers(spark):
    """All of ``events`` falls in one month: the rebalanced write must not put
    that hot partition in a single task.  With a small advisory size AQE
    splits it, so the partition gets several files."""
    # AQE splits a hot partition by ranges of map outputs; the test file is a
    # single small Parquet file (one map task), so spread it over 8 map tasks
    # as a large scan would be.
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").repartition(8)
    root = scratch_path(spark, "t-hot")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "32k")
    try:
        spec = [{"table": "events", "first_date": "20240101", "partition_by": "ts", "interval": "MONTH"}]
        partition_tables(spark, spec, {"events": TableBinding(events, root, "ts")}, D(2024, 1, 31))
    finally:
        spark.conf.set(key, old)
    files = _files(root, "events_20240101_20240131")
    assert len(files) > 1
    assert _profile(spark, root) == {"events_20240101_20240131": events.count()}


def test_transactional_tables_in_parallel_fail_independently(spark, sf_small):
    orders = _orders(spark, sf_small)
    good_root = _stale_target(spark, orders)
    bad_root = scratch_path(spark, "t-copy")
    copy_spec = [dict(SPEC[0], table="orders_copy")]
    stale = orders.where(F.col("o_orderstatus") == "O")
    partition_tables(spark, copy_spec, {"orders_copy": TableBinding(stale, bad_root, "o_orderdate")}, AS_OF)
    before_bad = _profile(spark, bad_root)
    bindings = {"orders": TableBinding(orders, good_root, "o_orderdate"),
                "orders_copy": TableBinding(_failing(orders, 1999), bad_root, "o_orderdate")}
    sel = [{"table": "orders", "selected_partitions": "orders_19990101_19991231"},
           {"table": "orders_copy", "selected_partitions": "orders_copy_19990101_19991231,"
                                                           "orders_copy_20000101_20001231"}]
    report = refresh(spark, bindings, "orders,orders_copy", sel, "transactional",
                     max_parallelism=2, raise_on_failure=False, mode="selected_only")
    status = {(r.table_name, r.partition_name): r.status for r in report.collect()}
    assert status == {("orders", "orders_19990101_19991231"): "Completed",
                      ("orders_copy", "orders_copy_19990101_19991231"): "Failed",
                      ("orders_copy", "orders_copy_20000101_20001231"): "Failed"}
    assert _profile(spark, bad_root) == before_bad  # nothing of the failed table published
    assert _profile(spark, good_root)["orders_19990101_19991231"] == \
        _expected(orders)["orders_19990101_19991231"]


@pytest.mark.parametrize("mode", ["transactional", "partialBatch"])
def test_refresh_survives_a_lost_task(spark, sf_small, mode):
    """The first attempt of one source task dies mid-way; Spark retries it and
    the refresh still publishes exactly the source rows (no duplicates from
    the failed attempt, and the observed names are right)."""
    from pyspark import TaskContext

    def flaky(x):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
            raise RuntimeError("simulated executor loss")
        return x

    flaky_udf = F.udf(flaky, "double")  # test-only failure injection
    orders = _orders(spark, sf_small)
    root = _stale_target(spark, orders)
    source = orders.repartition(4).withColumn("o_totalprice", flaky_udf("o_totalprice"))
    chosen = ["orders_19990101_19991231", "orders_20000101_20001231"]
    report = refresh(spark, {"orders": TableBinding(source, root, "o_orderdate")}, "orders",
                     _selection(chosen), mode, max_parallelism=2)
    assert {r.status for r in report.collect()} == {"Completed"}
    want = _expected(orders, (F.col("o_orderstatus") == "O") | F.year("o_orderdate").isin(1999, 2000))
    assert _profile(spark, root) == want


def test_command_line_partitions_then_refreshes(spark, sf_small, capsys):
    import json as _json

    from parcelwise.__main__ import main

    root = scratch_path(spark, "t-cli")
    spec = _json.dumps([dict(SPEC[0], refresh_from="TODAY", number_of_intervals="2")])
    assert main(["--table", f"orders={sf_small}/orders.parquet,{root}",
                 "--partitions-config", spec, "--as-of", "2001-08-01"], spark=spark) == 0
    lines = [_json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert sorted(x["partition_name"] for x in lines) == ["orders_20000101_20001231", "orders_20010101_20011231"]
    assert {x["status"] for x in lines} == {"Completed"}
    assert _profile(spark, root) == _expected(_orders(spark, sf_small))


def _written(spark, root):
    return _profile(spark, root), sorted(r.partition_name for r in read_manifest(spark, root).collect())


@pytest.mark.parametrize("step", ["write_partitions", "written_sizes", "commit"])
def test_a_broken_run_then_a_run_equals_a_clean_run(spark, sf_small, monkeypatch, step):
    """The run breaks off before a step; the source then loses a year; the next run leaves no old row."""
    import parcelwise.plans.targets as plan

    orders = _orders(spark, sf_small)
    later = orders.where(F.year("o_orderdate") != 1998)
    clean, broken = scratch_path(spark, "t-clean"), scratch_path(spark, "t-broken")
    for root in (clean, broken):
        write_default_partition(orders, root, "orders")

    def boom(*_, **__):
        raise RuntimeError("gone")
    with monkeypatch.context() as m:
        m.setattr(plan, step, boom)
        with pytest.raises(RuntimeError, match="gone"):
            partition_tables(spark, SPEC, {"orders": TableBinding(orders, broken, "o_orderdate")}, AS_OF)
    assert _written(spark, broken) == ({"orders": orders.count()}, ["orders"])  # nothing of the broken run is seen
    for root in (clean, broken):
        partition_tables(spark, SPEC, {"orders": TableBinding(later, root, "o_orderdate")}, AS_OF)
    assert _written(spark, broken) == _written(spark, clean)
    assert _written(spark, clean)[0] == _expected(later)


def test_nothing_is_written_before_all_checks(spark, sf_small):
    orders = _orders(spark, sf_small)
    root = scratch_path(spark, "t-checks")
    binding = {"orders": TableBinding(orders, root, "o_orderdate")}
    bad = [{"refresh_commit_mode": "both"}, {"refresh_max_parallelism": 0}, {"refresh_max_parallelism": "4"}, {"tables_to_refresh": "orders,ghost"},
           {"tables_to_refresh": ","}, {"partitions_to_refresh": '[{"table": "orders"'}, {"partitions_to_refresh": '[{"tabel": "orders"}]'},
           {"mode": "some"}, {"edges": [("orders", "x")], "tables_to_refresh": "orders", "direction": "in"},
           {"partitions_config": '[{"table": "orders"'}, {"partitions_config": [dict(SPEC[0], table="ghost")]},
           {"partitions_config": [dict(SPEC[0], refresh_from="soon", number_of_intervals="2")]}, {"partitions_config": " "}]
    for more in bad:
        with pytest.raises(ValueError):
            run(spark, binding, AS_OF, **{"partitions_config": SPEC} | more)
        assert read_table(spark, root) is None, more
    with pytest.raises(ValueError, match="not valid JSON"):
        partition_tables(spark, '[{"table": "orders", "first', binding, AS_OF)


def test_refresh_by_the_recorded_date_column(spark, sf_small, capsys):
    """Partition with a spec, then refresh from the command line without one; related tables join the scope."""
    import json as _json

    from parcelwise.__main__ import main

    orders = _orders(spark, sf_small)
    root = _stale_target(spark, orders)
    table = f"orders={sf_small}/orders.parquet,{root}"
    selection = _json.dumps(_selection(["orders_19990101_19991231"]))
    assert main(["--table", table, "--no-partition", "--as-of", "2001-08-01", "--partitions-to-refresh", selection], spark=spark) == 0
    out = [_json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert [(x["partition_name"], x["status"]) for x in out] == [("orders_19990101_19991231", "Completed")]
    assert _profile(spark, root) == _expected(orders, (F.col("o_orderstatus") == "O") | (F.year("o_orderdate") == 1999))
    assert main(["--table", table, "--table", f"customer={sf_small}/customer.parquet,{scratch_path(spark, 't-c')}", "--no-partition",
                 "--tables-to-refresh", "customer", "--edges", "orders:customer", "--direction", "both"], spark=spark) == 0
    out = [_json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {x["table_name"] for x in out} == {"orders"} and len(out) == 7
    assert _profile(spark, root) == _expected(orders)


def test_all_failures_are_reported(spark):
    from parcelwise.plans.refresh import RefreshFailed, check_report
    from parcelwise.session import local_frame
    from parcelwise.plans.refresh import REPORT_SCHEMA

    report = local_frame(spark, [("T", f"T_{i}", "Failed", 0, "boom") for i in range(65)] + [("T", "ok", "Completed", 1, None)], REPORT_SCHEMA)
    with pytest.raises(RefreshFailed) as failed:
        check_report(report)
    assert len(failed.value.failures) == 65


def test_refresh_of_one_partition_takes_few_jobs(spark, sf_small):
    orders = _orders(spark, sf_small)
    root = _stale_target(spark, orders)
    sc = spark.sparkContext
    sc.setJobGroup("one-partition", "count the jobs")
    try:
        refresh(spark, {"orders": TableBinding(orders, root, "o_orderdate")}, "orders", _selection(["orders_19990101_19991231"]), max_parallelism=1)
        jobs = sc.statusTracker().getJobIdsForGroup("one-partition")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 10


def test_manifest_is_one_file_whatever_the_number_of_partitions(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 5))], "id int, d date")
    root = scratch_path(spark, "t-one-file")
    spec = [{"table": "T", "first_date": "20200101", "partition_by": "d", "interval": "MONTH"}]
    for end in (D(2021, 1, 1), D(2022, 1, 1), D(2023, 1, 1)):
        partition_tables(spark, spec, {"T": TableBinding(df, root, "d")}, end)
    assert read_manifest(spark, root).count() == 37
    versions = sorted(os.listdir(os.path.join(local_path(root), "_ranges")))
    assert versions == [f"v{i:012d}.json" for i in range(3)]


def test_command_line_on_a_catalog_table_with_a_selection_file(spark, sf_small, tmp_path, capsys):
    import json as _json

    from parcelwise.__main__ import main
    from parcelwise.sources.catalog import create_table, partition_names

    orders = _orders(spark, sf_small)
    create_table(spark, "t_cli_orders", orders, scratch_path(spark, "t-cli-catalog"))
    try:
        selection = tmp_path / "selection.json"
        selection.write_text(_json.dumps(_selection(["orders_19990101_19991231"])))
        assert main(["--table", f"orders={sf_small}/orders.parquet,catalog:t_cli_orders", "--partitions-config", _json.dumps(SPEC),
                     "--as-of", "2001-08-01", "--partitions-to-refresh", str(selection)], spark=spark) == 0
        out = [_json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
        assert [(x["partition_name"], x["status"]) for x in out] == [("orders_19990101_19991231", "Completed")]
        assert len(partition_names(spark, "t_cli_orders")) == 7
    finally:
        spark.sql("DROP TABLE t_cli_orders")
    root = scratch_path(spark, "t-cli-vacuum")
    for _ in range(3):
        assert main(["--table", f"orders={sf_small}/orders.parquet,{root}", "--partitions-config", _json.dumps([dict(SPEC[0], refresh_from="TODAY", number_of_intervals="*")]),
                     "--as-of", "2001-08-01", "--vacuum-hours", "0"], spark=spark) == 0
    assert len(os.listdir(os.path.join(local_path(root), "_data"))) == 2  # the newest two versions' writes
    assert _profile(spark, root) == _expected(orders)
