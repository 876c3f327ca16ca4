"""Snapshot commits: concurrent writers, readers during a commit, crashes at every step, statistics, vacuum."""

import datetime as dt
import multiprocessing
import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from parcelwise.operators.assign import partition_profile
from parcelwise.operators.validate import InvalidInput
from parcelwise.plans import targets
from parcelwise.plans.partition import TableBinding, manifest_profile, materialize_partitions, partition_tables, retire_default, write_default_partition
from parcelwise.plans.refresh import packed, refresh, refresh_partial_batch, refresh_report, work_list
from parcelwise.plans.targets import MOST_SPANS, FolderTarget, merged_intervals, span_filter
from parcelwise.session import local_path, scratch_path
from parcelwise.sources import storage
from parcelwise.sources.storage import (
    CommitConflict,
    Partition,
    create_if_absent,
    manifest_frame,
    manifest_versions,
    read_manifest,
    read_snapshot,
    read_table,
    vacuum,
    write_manifest,
)

D = dt.date
SPEC = [{"table": "T", "first_date": "20200101", "partition_by": "d", "interval": "MONTH"}]


def _rows(spark, days=366, value=0):
    return spark.range(days).select(F.col("id").cast("int").alias("id"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("d"), F.lit(value).alias("v"))


def _table(spark, label, value=0):
    root = scratch_path(spark, label)
    partition_tables(spark, SPEC, {"T": TableBinding(_rows(spark, value=value), root, "d")}, D(2020, 12, 31))
    return root


def _values(spark, root):
    return {r.v: r["count"] for r in read_table(spark, root).groupBy("v").count().collect()}


def _range(i):
    start = D(2020, 1, 1) + dt.timedelta(days=10 * i)
    return ("T", f"T_{start:%Y%m%d}", start, start + dt.timedelta(days=9))


def test_concurrent_manifests_hold_each_name_once(spark):
    root = scratch_path(spark, "t-many")
    with ThreadPoolExecutor(max_workers=16) as pool:
        list(pool.map(lambda i: write_manifest(spark, [_range(i), _range(0)], root, "d"), range(40)))
    held = [r.partition_name for r in read_manifest(spark, root).collect()]
    assert sorted(held) == sorted({_range(i)[1] for i in range(40)})
    assert manifest_versions(spark, root) == list(range(40))


def test_conflicting_ranges_of_concurrent_writers_are_refused(spark):
    root = scratch_path(spark, "t-clash")
    other = [("T", f"T_x{i}", D(2020, 1, 5), D(2020, 1, 5 + i)) for i in range(8)]  # all overlap each other

    def attempt(r):
        try:
            write_manifest(spark, [r], root)
            return True
        except InvalidInput as exc:
            return not exc.problems
    with ThreadPoolExecutor(max_workers=8) as pool:
        done = list(pool.map(attempt, other))
    assert sum(done) == 1 and read_manifest(spark, root).count() == 1


def _link(path, number, results):
    """Another process of the same machine creates the same file by the same steps."""
    draft = f"{path}.{number}"
    with open(draft, "w") as f:
        f.write(str(number))
    try:
        os.link(draft, path)
        results.put(number)
    except FileExistsError:
        pass


def test_a_file_is_created_by_one_of_many(spark):
    folder = scratch_path(spark, "t-file")
    path = f"{folder}/one"
    with ThreadPoolExecutor(max_workers=8) as pool:
        won = list(pool.map(lambda i: create_if_absent(spark, path, f"{i}".encode()), range(30)))
    assert sum(won) == 1
    assert storage._read_bytes(spark, path) == str(won.index(True)).encode()
    assert os.listdir(local_path(folder)) == ["one"]  # no drafts are left
    results = multiprocessing.get_context("fork").Queue()
    assert _link(local_path(path), 99, results) is None and results.empty()


def test_rename_without_overwriting_on_other_file_systems(spark, monkeypatch):
    """The way of stores that are no local folders, here on a local one."""
    folder = scratch_path(spark, "t-rename")
    monkeypatch.setattr(storage, "_local", lambda fs, path: None)
    assert create_if_absent(spark, f"{folder}/one", b"a")
    assert not create_if_absent(spark, f"{folder}/one", b"b")
    assert storage._read_bytes(spark, f"{folder}/one") == b"a"
    write_manifest(spark, [_range(1)], folder)
    write_manifest(spark, [_range(2)], folder)
    assert read_manifest(spark, folder).count() == 2


def test_writers_of_the_same_range_leave_its_rows_once(spark):
    root = scratch_path(spark, "t-same")
    src = _rows(spark, 40)
    ranges = [storage.Partition(*_range(i)) for i in range(4)]
    with ThreadPoolExecutor(max_workers=6) as pool:
        made = list(pool.map(lambda i: FolderTarget(spark, root).add(src, "d", ranges if i % 2 else ranges[:2]), range(6)))
    assert sorted(n for names in made for n in names) == sorted(r.partition_name for r in ranges)
    assert read_table(spark, root).count() == 40
    with pytest.raises((CommitConflict, InvalidInput)):
        FolderTarget(spark, root).add(src, "d", [ranges[0]._replace(range_end=D(2020, 1, 4))])
    with pytest.raises(InvalidInput):
        FolderTarget(spark, root).add(src, "d", [Partition("T", "T_other", D(2020, 1, 3), D(2020, 1, 4))])
    assert read_table(spark, root).count() == 40


def test_a_reader_sees_all_old_or_all_new_rows(spark):
    root = _table(spark, "t-reader")
    stop, seen = threading.Event(), []

    def watch():
        while not stop.is_set():
            seen.append(_values(spark, root))
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        for value in (1, 2, 3):
            refresh(spark, {"T": TableBinding(_rows(spark, value=value), root, "d")}, "T")
            vacuum(spark, root, keep_versions=3, older_than=dt.timedelta(hours=1))
    finally:
        time.sleep(0.5)
        stop.set()
        watcher.join()
    assert _values(spark, root) == {3: 366}
    assert seen and all(len(s) == 1 and list(s.values()) == [366] for s in seen)
    held = read_table(spark, root)
    refresh(spark, {"T": TableBinding(_rows(spark, value=4), root, "d")}, "T")
    assert {r.v for r in held.select("v").distinct().collect()} == {3}  # a frame keeps the version it was made of
    assert {r.v for r in read_table(spark, root, version=0).select("v").distinct().collect()} == {0}


@pytest.mark.parametrize("mode", ["transactional", "partialBatch"])
@pytest.mark.parametrize("step", ["write_partitions", "written_sizes", "commit", "create_if_absent"])
def test_a_crash_at_any_step_of_a_refresh_leaves_the_old_rows(spark, monkeypatch, step, mode):
    root = _table(spark, "t-crash")

    def boom(*_, **__):
        raise OSError("gone")
    with monkeypatch.context() as m:
        m.setattr(storage if step == "create_if_absent" else targets, step, boom)
        report = refresh(spark, {"T": TableBinding(_rows(spark, value=1), root, "d")}, "T", commit_mode=mode, raise_on_failure=False)
        assert {r.status for r in report.collect()} == {"Failed"} and {r["rows"] for r in report.collect()} == {29, 30, 31}
    assert _values(spark, root) == {0: 366}
    refresh(spark, {"T": TableBinding(_rows(spark, value=2), root, "d")}, "T", commit_mode=mode)
    assert _values(spark, root) == {2: 366}


def test_a_lost_race_is_reported_and_publishes_nothing(spark, monkeypatch):
    """Another refresh commits between this one's read and its commit."""
    root = _table(spark, "t-race")
    own = targets.written_sizes

    def meanwhile(*args):
        out = own(*args)
        monkeypatch.setattr(targets, "written_sizes", own)
        refresh(spark, {"T": TableBinding(_rows(spark, value=7), root, "d")}, "T", [{"table": "T", "selected_partitions": "T_20200301_20200331"}],
                mode="selected_only")
        return out
    for mode, want in (("transactional", {0: 335, 7: 31}), ("partialBatch", {1: 335, 7: 31})):
        monkeypatch.setattr(targets, "written_sizes", meanwhile)
        report = refresh(spark, {"T": TableBinding(_rows(spark, value=1), root, "d")}, "T", commit_mode=mode, raise_on_failure=False).collect()
        failed = {r.partition_name for r in report if r.status == "Failed"}
        assert "T_20200301_20200331" in failed and len(failed) == (12 if mode == "transactional" else 1)
        assert all("CommitConflict" in r.error for r in report if r.status == "Failed")
        assert _values(spark, root) == want


def test_statistics_equal_a_scan(spark, sf_small):
    """W6 from the manifest alone, after writes, refreshes with fewer rows and an empty period; no Spark job."""
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    root = scratch_path(spark, "t-stats")
    spec = [{"table": "orders", "first_date": "19950215", "partition_by": "o_orderdate", "interval": "MONTH"}]
    partition_tables(spark, spec, {"orders": TableBinding(orders, root, "o_orderdate")}, D(2001, 12, 1))
    refresh(spark, {"orders": TableBinding(orders.where("o_orderkey % 3 = 0 AND year(o_orderdate) <> 1998"), root)}, "orders",
            [{"table": "orders", "selected_partitions": [p.partition_name for p in FolderTarget(spark, root).partitions() if p.range_start.year in (1997, 1998)]}])
    got = sorted(map(tuple, manifest_profile(spark, root).collect()))
    want = sorted(map(tuple, partition_profile(read_table(spark, root), "o_orderdate", "orders", manifest=read_manifest(spark, root)).collect()))
    assert got == want and any(r[2] == 0 for r in got)
    sizes = {r.partition_name: r.n_bytes for r in manifest_frame(spark, root).collect()}
    assert all((sizes[r[1]] > 0) == (r[2] > 0) for r in got)
    sc = spark.sparkContext
    sc.setJobGroup("stats", "count the jobs")
    try:
        manifest_profile(spark, root).collect()
        refresh_report(spark, {"orders": TableBinding(orders, root)}, [("orders", r[1]) for r in got]).collect()
        assert len(sc.statusTracker().getJobIdsForGroup("stats")) == 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_statistics_without_a_metric_are_read(spark, monkeypatch):
    monkeypatch.setattr(targets.Counted, "stats", lambda self: None)
    root = _table(spark, "t-scan")
    assert sorted(r.n_rows for r in manifest_profile(spark, root).collect()) == [29] + [30] * 4 + [31] * 7


def test_report_counts_what_was_committed_and_reads_nothing(spark, monkeypatch):
    root = _table(spark, "t-report")
    monkeypatch.setattr(FolderTarget, "read", lambda *_: pytest.fail("the target was read"))
    for mode in ("transactional", "partialBatch"):
        report = refresh(spark, {"T": TableBinding(_rows(spark, 50, 5), root, "d")}, "T", commit_mode=mode)
        assert {r.partition_name: r["rows"] for r in report.collect() if r["rows"]} == {"T_20200101_20200131": 31, "T_20200201_20200229": 19}


def test_catch_all_is_retired_with_the_commit_that_adds(spark):
    root = scratch_path(spark, "t-one-commit")
    write_default_partition(_rows(spark), root, "T")
    partition_tables(spark, SPEC, {"T": TableBinding(_rows(spark), root, "d")}, D(2020, 12, 31))
    assert manifest_versions(spark, root) == [0, 1]
    assert "T" in read_snapshot(spark, root, 0).partitions and "T" not in read_snapshot(spark, root).partitions
    refresh(spark, {"T": TableBinding(_rows(spark, 10), root, "d")}, "T")
    write_default_partition(_rows(spark), root, "T")
    refresh(spark, {"T": TableBinding(_rows(spark, 20), root, "d")}, "T")
    assert read_table(spark, root).where("partition_name = 'T'").count() == 20
    assert retire_default(spark, root, "T") and not retire_default(spark, root, "T")
    assert materialize_partitions(_rows(spark), root, read_manifest(spark, root).limit(0), "d") == []


def test_vacuum_removes_only_what_no_kept_version_names(spark):
    root = _table(spark, "t-vacuum")
    for value in (1, 2, 3):
        refresh(spark, {"T": TableBinding(_rows(spark, value=value), root, "d")}, "T", [{"table": "T", "selected_partitions": "T_20200301_20200331"}], mode="selected_only")
    FolderTarget(spark, root).stage(_rows(spark, value=9), "d", FolderTarget(spark, root).partitions())  # a write without a commit
    assert vacuum(spark, root) == 0  # all is younger than a day
    before = _values(spark, root)
    assert vacuum(spark, root, keep_versions=1, older_than=dt.timedelta(0)) == 3 + 2 + 1 + 1  # versions, writes, the stale partition, the lone write
    assert _values(spark, root) == before == {0: 335, 3: 31}
    with pytest.raises(ValueError, match="removed"):
        read_table(spark, root, version=0)
    refresh(spark, {"T": TableBinding(_rows(spark, value=4), root, "d")}, "T")
    assert _values(spark, root) == {4: 366}


def test_thousands_of_scattered_ranges(spark):
    """5,000 separate ranges in one refresh: few pushed intervals, and only rows inside the ranges."""
    days = 20_000
    src = _rows(spark, days)
    ranges = [Partition("T", f"p{i}", D(2020, 1, 1) + dt.timedelta(days=4 * i), D(2020, 1, 1) + dt.timedelta(days=4 * i + 1)) for i in range(5000)]
    intervals = merged_intervals(ranges, MOST_SPANS)
    assert len(intervals) == MOST_SPANS and intervals[0][0] == ranges[0].range_start and intervals[-1][1] == ranges[-1].range_end
    tagged = targets.ranged_rows(src, "d", ranges)
    assert "Join" not in tagged._jdf.queryExecution().executedPlan().toString()
    got = tagged.groupBy("partition_name").count().agg(F.count("*"), F.min("count"), F.max("count")).first()
    assert tuple(got) == (5000, 2, 2)
    path = scratch_path(spark, "t-src")
    src.write.parquet(path)
    plan = span_filter(spark.read.parquet(path), "d", ranges[:3000:2999])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(" in plan


def test_widest_gaps_are_not_read():
    ranges = [Partition("T", str(i), D(2020, 1, 1) + dt.timedelta(days=k), D(2020, 1, 1) + dt.timedelta(days=k)) for i, k in enumerate([0, 2, 4, 100, 103, 300])]
    day = lambda k: D(2020, 1, 1) + dt.timedelta(days=k)
    assert merged_intervals(ranges, 3) == [(day(0), day(4)), (day(100), day(103)), (day(300), day(300))]
    assert merged_intervals(ranges, 1) == [(day(0), day(300))]
    assert len(merged_intervals(ranges)) == 6


def test_ten_thousand_partitions_are_planned_in_seconds():
    parts = [Partition("T", f"p{i}", D(1900, 1, 1) + dt.timedelta(days=i), D(1900, 1, 1) + dt.timedelta(days=i), n_bytes=10 << 20) for i in range(10_000)]
    chosen = [("T", p.partition_name) for p in parts[::2]]
    start = time.perf_counter()
    work = work_list(chosen, {"T": parts}, 256 << 20)
    assert time.perf_counter() - start < 2
    assert [p.partition_name for _, pack in work for p in pack] == [n for _, n in chosen]
    assert max(len(pack) for _, pack in work) == 25 and len(work) == 200
    mixed = [parts[0], parts[1]._replace(n_bytes=1 << 40), parts[2]._replace(n_bytes=None), Partition("T", "T", n_bytes=5), parts[3]]
    assert [[p.partition_name for p in pack] for pack in packed(mixed)] == [["p0"], ["p1"], ["p2"], ["p3"], ["T"]]


def test_a_failing_partition_of_a_pack_fails_alone(spark):
    root = _table(spark, "t-pack")
    bad = _rows(spark, value=1).withColumn("v", F.when(F.month("d") == 5, F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    binding = {"T": TableBinding(bad, root, "d")}
    names = [p.partition_name for p in FolderTarget(spark, root).partitions()]
    rows: dict = {}
    failures = refresh_partial_batch(binding, [("T", n) for n in names], rows=rows)
    assert list(failures) == [("T", "T_20200501_20200531")] and len(rows) == 11
    assert _values(spark, root) == {0: 31, 1: 335}


def test_packs_are_fewer_writes(spark):
    root = _table(spark, "t-few")
    before = len(os.listdir(os.path.join(local_path(root), "_data")))
    refresh(spark, {"T": TableBinding(_rows(spark, value=1), root, "d")}, "T", commit_mode="partialBatch")
    assert len(os.listdir(os.path.join(local_path(root), "_data"))) == before + 1
    assert _values(spark, root) == {1: 366}


def test_an_empty_table_keeps_its_columns(spark):
    root = scratch_path(spark, "t-none")
    assert read_table(spark, root) is None
    partition_tables(spark, SPEC, {"T": TableBinding(_rows(spark, 0), root, "d")}, D(2020, 3, 1))
    got = read_table(spark, root)
    assert got.columns == ["id", "d", "v", "partition_name"] and got.count() == 0
    assert [r.n_rows for r in manifest_profile(spark, root).collect()] == [0, 0, 0]
