"""Tagging, slicing, profiling, pending diff, uncovered rows, plan shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelwise.operators.assign import (
    assign_by_ranges,
    assign_partition,
    calendar_profile,
    partition_profile,
    slice_partition,
    uncovered_rows,
)
from parcelwise.operators.ranges import period_ranges
from parcelwise.operators.validate import pending_partitions
from parcelwise.sources.control import read_spec

D = dt.date
AS_OF = D(2001, 8, 1)


def _lineitem(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem.parquet")


def _ranges(spark, table, first, interval, as_of=AS_OF):
    spec = read_spec(spark, [{"table": table, "first_date": first, "partition_by": "d",
                              "interval": interval}])
    return period_ranges(spec, as_of)


def test_w3_equals_w4_and_counts_conserved(spark, sf_small):
    li = _lineitem(spark, sf_small)
    ranges = _ranges(spark, "lineitem", "19950215", "QUARTER")
    a = assign_partition(li, "lineitem", "l_shipdate", "QUARTER", "19950215", AS_OF)
    b = assign_by_ranges(li, "l_shipdate", ranges, "lineitem")
    key = ["l_orderkey", "l_linenumber", "partition_name"]
    assert a.select(key).exceptAll(b.select(key)).count() == 0
    assert b.select(key).exceptAll(a.select(key)).count() == 0
    profiled = partition_profile(a, "l_shipdate", "lineitem").agg(F.sum("n_rows")).first()[0]
    lost = uncovered_rows(li, "l_shipdate", ranges, "lineitem").count()
    assert profiled + lost == li.count()
    assert lost > 0


def test_time_of_day_on_last_day_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2020, 3, 31, 23, 59, 59)), (2, dt.datetime(2020, 4, 1, 0, 0)),
         (3, None), (4, dt.datetime(2019, 12, 31, 12, 0))], "id int, ts timestamp_ntz")
    ranges = _ranges(spark, "T", "20200101", "QUARTER", D(2020, 6, 1))
    tagged = {r.id: r.partition_name for r in
              assign_partition(df, "T", "ts", "QUARTER", "20200101", D(2020, 6, 1)).collect()}
    assert tagged == {1: "T_20200101_20200331", 2: "T_20200401_20200630", 3: None, 4: None}
    by_ranges = {r.id: r.partition_name for r in assign_by_ranges(df, "ts", ranges).collect()}
    assert by_ranges == tagged
    assert sorted(r.id for r in uncovered_rows(df, "ts", ranges).collect()) == [3, 4]
    sliced = slice_partition(df, "ts", "2020-01-01", "2020-03-31").collect()
    assert [r.id for r in sliced] == [1]


def test_irregular_and_overlapping_ranges(spark):
    df = spark.createDataFrame([(i, D(2020, 1, 1) + dt.timedelta(days=i)) for i in range(0, 400, 7)],
                               "id int, d date")
    ranges = spark.createDataFrame(
        [("T", "a", D(2020, 1, 10), D(2020, 3, 5)), ("T", "b", D(2020, 3, 1), D(2020, 9, 9)),
         ("T", "c", D(2020, 11, 2), D(2021, 1, 20))],
        "table_name string, partition_name string, range_start date, range_end date")
    got = sorted((r.id, r.partition_name) for r in
                 assign_by_ranges(df, "d", ranges, keep_unmatched=False).collect())
    want = sorted((i, n) for i, d in ((i, D(2020, 1, 1) + dt.timedelta(days=i)) for i in range(0, 400, 7))
                  for _, n, s, e in ranges.collect() if s <= d <= e)
    assert got == want
    assert any(n == "a" for _, n in got) and len({i for i, _ in got}) < len(got)  # overlap doubles


def test_profile_with_manifest_lists_empty_partitions(spark):
    df = spark.createDataFrame([(D(2020, 2, 1),), (D(2020, 2, 2),)], "d date")
    ranges = _ranges(spark, "T", "20200101", "MONTH", D(2020, 4, 15))
    tagged = assign_partition(df, "T", "d", "MONTH", "20200101", D(2020, 4, 15))
    prof = {r.partition_name: r.n_rows for r in
            partition_profile(tagged, "d", "T", manifest=ranges).collect()}
    assert prof == {"T_20200101_20200131": 0, "T_20200201_20200229": 2,
                    "T_20200301_20200331": 0, "T_20200401_20200430": 0}


def test_pending_is_name_diff(spark):
    expected = _ranges(spark, "T", "20200101", "QUARTER", D(2020, 12, 1))
    existing = spark.createDataFrame([("T", "T_20200101_20200331"), ("T", "T"), ("U", "T_20200401_20200630")],
                                     "table_name string, partition_name string")
    pend = sorted(r.partition_name for r in pending_partitions(expected, existing).collect())
    assert pend == ["T_20200401_20200630", "T_20200701_20200930", "T_20201001_20201231"]
    assert pending_partitions(expected, expected).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_interval_join_plan_has_no_nested_loop(spark, sf_small):
    li = _lineitem(spark, sf_small)
    ranges = _ranges(spark, "lineitem", "19950215", "QUARTER")
    both = ranges.unionByName(_ranges(spark, "lineitem", "19950215", "YEAR"))  # these overlap
    for df in (assign_by_ranges(li, "l_shipdate", both), uncovered_rows(li, "l_shipdate", both)):
        plan = _plan(df)
        assert "NestedLoop" not in plan
        assert "BroadcastHashJoin" in plan


def test_disjoint_ranges_need_no_join(spark, sf_small):
    li = _lineitem(spark, sf_small)
    ranges = _ranges(spark, "lineitem", "19950215", "QUARTER")
    for df in (assign_by_ranges(li, "l_shipdate", ranges), uncovered_rows(li, "l_shipdate", ranges), assign_by_ranges(li, "l_shipdate", ranges.collect())):
        plan = _plan(df)
        assert "Join" not in plan and "Exchange" not in plan


def test_range_index_equals_the_join(spark):
    """Random disjoint ranges with gaps, null and reversed bounds: the index and the join tag the same rows."""
    import random

    from parcelwise.operators import assign

    rnd = random.Random(6)
    df = spark.createDataFrame([(i, None if i % 50 == 0 else D(2019, 12, 1) + dt.timedelta(days=i)) for i in range(900)], "id int, d date")
    for _ in range(6):
        cuts = sorted(rnd.sample(range(0, 800), 2 * rnd.randint(1, 30)))
        rows = [("T", f"p,{a}|'", D(2020, 1, 1) + dt.timedelta(days=a), D(2020, 1, 1) + dt.timedelta(days=b - 1)) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        rows += [("T", "open", None, D(2020, 1, 1)), ("T", "reversed", D(2021, 1, 1), D(2020, 1, 1)), ("U", "other", D(2020, 1, 1), D(2022, 1, 1))]
        for keep in (True, False):
            got = assign_by_ranges(df, "d", rows, "T", keep_unmatched=keep)
            want = assign._bucket_join(df, "d", rows, "left" if keep else "inner", "T").select("id", "d", F.col("_pn").alias("partition_name"))
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert uncovered_rows(df, "d", rows, "T").count() == assign._bucket_join(df, "d", rows, "left_anti", "T").count()
    assert uncovered_rows(df, "d", []).count() == 900
    assert assign_by_ranges(df, "d", []).where("partition_name IS NULL").count() == 900


def test_slice_pushes_filter_and_prunes_columns(spark, sf_small):
    li = _lineitem(spark, sf_small)
    df = slice_partition(li, "l_shipdate", "1997-01-01", "1997-03-31").select("l_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "LessThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_assign_partition_is_narrow(spark, sf_small):
    li = _lineitem(spark, sf_small)
    plan = _plan(assign_partition(li, "lineitem", "l_shipdate", "YEAR", "19950101", AS_OF))
    assert "Exchange" not in plan and "Join" not in plan


def test_shuffle_path_beyond_the_broadcast_limit(spark, sf_small):
    """With Spark's broadcast limit off, the interval joins shuffle and give the same rows."""
    li = _lineitem(spark, sf_small)
    ranges = period_ranges(read_spec(spark, [{"table": "lineitem", "first_date": "19960301", "partition_by": "l_shipdate",
                                              "interval": i} for i in ("MONTH", "YEAR")]), AS_OF)  # they overlap
    run = lambda: (sorted(map(tuple, assign_by_ranges(li, "l_shipdate", ranges).groupBy("partition_name").count().collect()), key=str),
                   uncovered_rows(li, "l_shipdate", ranges).count())
    want = run()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run() == want
        plan = assign_by_ranges(li, "l_shipdate", ranges)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scattered_refresh_reads_only_selected_dates(spark, sf_small):
    from pyspark.sql import Row

    from parcelwise.plans.targets import merged_intervals, span_filter

    R = Row("range_start", "range_end")
    ranges = [R(D(1995, 1, 1), D(1995, 3, 31)), R(D(1995, 4, 1), D(1995, 6, 30)),
              R(D(2001, 7, 1), D(2001, 9, 30))]
    assert merged_intervals(ranges) == [(D(1995, 1, 1), D(1995, 6, 30)), (D(2001, 7, 1), D(2001, 9, 30))]
    li = _lineitem(spark, sf_small)
    sliced = span_filter(li, "l_shipdate", ranges)
    pushed = _plan(sliced)
    assert ("PushedFilters: [Or(And(GreaterThanOrEqual(l_shipdate,1995-01-01T00:00),"
            "LessThan(l_shipdate,1995-07-01T00:00))") in pushed
    d = F.to_date("l_shipdate")
    want = li.where(d.between(D(1995, 1, 1), D(1995, 6, 30)) | d.between(D(2001, 7, 1), D(2001, 9, 30)))
    assert sliced.count() == want.count() > 0


@pytest.mark.parametrize("interval", ["MONTH", "quarter", "YEAR"])
def test_picked_names_equal_built_names(spark, interval):
    """Names looked up by period number equal the names built per row, around every boundary and for null dates."""
    days = [None] + [D(1999, 12, 30) + dt.timedelta(days=i) for i in range(0, 900)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, d date")
    for first, last in ((D(2000, 2, 15), D(2001, 8, 1)), (D(2000, 1, 1), D(2000, 1, 1)), (D(2005, 1, 1), D(2001, 1, 1))):
        picked = assign_partition(df, "T", "d", interval, first, last)
        built = assign_partition(df, "T", "d", interval, F.lit(first), F.lit(last))
        assert sorted(map(tuple, picked.collect()), key=str) == sorted(map(tuple, built.collect()), key=str)
        one = calendar_profile(df, "T", "d", interval, first, last)
        two = partition_profile(built, "d", "T")
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_calendar_profile_pushes_dates_and_groups_numbers(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    plan = calendar_profile(li, "lineitem", "l_shipdate", "QUARTER", "19950215", D(2001, 8, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert "LessThan(l_shipdate" in plan
    assert "date_format" not in plan
