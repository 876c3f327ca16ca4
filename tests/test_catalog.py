"""Partitions of session-catalog tables as source (SHOW PARTITIONS) and sink."""

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from parcelwise.operators.selection import resolve_refresh_set
from parcelwise.operators.validate import pending_partitions
from parcelwise.plans.orchestrate import run
from parcelwise.plans.partition import TableBinding, partition_tables
from parcelwise.plans.refresh import refresh
from parcelwise.session import scratch_path
from parcelwise.sources.catalog import catalog_partitions, create_table, overwrite, partition_names, range_of

D = dt.date


def _rows(spark, days=366, value=0):
    return spark.range(days).select(F.lit(value).alias("v"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("d"))


@pytest.fixture
def made(spark):
    """A fresh external table's name; it is dropped afterwards."""
    name = f"t_{uuid.uuid4().hex[:10]}"
    create_table(spark, name, _rows(spark), scratch_path(spark, "t-catalog"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _spec(interval="QUARTER", **more):
    return [{"table": "T's", "first_date": "20200101", "partition_by": "d", "interval": interval, **more}]


def _bind(rows, name):
    return {"T's": TableBinding(rows, date_col="d", catalog_table=name)}


def _counts(spark, name):
    return {r[0]: r[1] for r in spark.table(name).groupBy("partition_name").count().collect()}


def test_create_partitions_with_empty_ones_and_retire_the_catch_all(spark, made):
    """Names with quotes and spaces round-trip; the catch-all's rows go with it."""
    binding = _bind(_rows(spark, 200), made)
    binding["T's"].target("T's").put_whole(_rows(spark, 200), "T's")
    assert partition_names(spark, made) == ["T's"]
    created = partition_tables(spark, _spec(), binding, D(2020, 12, 1))
    assert created["T's"] == ["T's_20200101_20200331", "T's_20200401_20200630", "T's_20200701_20200930", "T's_20201001_20201231"]
    assert sorted(partition_names(spark, made)) == created["T's"]
    assert _counts(spark, made) == {created["T's"][0]: 91, created["T's"][1]: 91, created["T's"][2]: 18}
    assert partition_tables(spark, _spec(), binding, D(2020, 12, 1)) == {"T's": []}
    with pytest.raises(ValueError, match="overlapping"):
        partition_tables(spark, _spec("YEAR"), binding, D(2020, 12, 1))


@pytest.mark.parametrize("mode", ["transactional", "partialBatch"])
def test_refresh_only_selected_and_empty_ones(spark, made, mode):
    partition_tables(spark, _spec("MONTH"), _bind(_rows(spark), made), D(2020, 12, 1))
    later = _rows(spark, value=1).where(F.month("d") != 3)
    names = sorted(partition_names(spark, made))
    report = refresh(spark, _bind(later, made), "T's", [{"table": "T's", "selected_partitions": [names[1], names[2], names[11]]}], mode)
    assert [(r.partition_name, r.status, r["rows"]) for r in report.collect()] == [(names[1], "Completed", 29), (names[2], "Completed", 0), (names[11], "Completed", 31)]
    got = {r[0]: (r[1], r[2]) for r in spark.table(made).groupBy("partition_name").agg(F.count("*"), F.max("v")).collect()}
    assert names[2] not in got and got[names[1]] == (29, 1) and got[names[11]] == (31, 1) and got[names[0]] == (31, 0)
    assert sorted(partition_names(spark, made)) == names  # the emptied one still exists


def test_a_failed_refresh_leaves_the_table(spark, made):
    partition_tables(spark, _spec("QUARTER"), _bind(_rows(spark), made), D(2020, 12, 1))
    bad = _rows(spark, value=1).withColumn("v", F.when(F.month("d") == 5, F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    report = refresh(spark, _bind(bad, made), "T's", raise_on_failure=False).collect()
    assert {r.status for r in report} == {"Failed"} and sum(r["rows"] for r in report) == 366
    assert spark.table(made).where("v = 1").count() == 0
    report = refresh(spark, _bind(bad, made), "T's", commit_mode="partialBatch", raise_on_failure=False).collect()
    assert sorted(r.status for r in report) == ["Completed"] * 3 + ["Failed"]
    assert spark.table(made).where("v = 1").count() == 366 - 91


def test_writers_take_turns_and_other_threads_keep_their_settings(spark, made):
    """Several refreshes of one table at once; the caller's session still overwrites statically."""
    partition_tables(spark, _spec("MONTH"), _bind(_rows(spark), made), D(2020, 12, 1))
    names = sorted(partition_names(spark, made))

    def one(i):
        return refresh(spark, _bind(_rows(spark, value=i + 1), made), "T's", [{"table": "T's", "selected_partitions": [names[i]]}], mode="selected_only").collect()
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(one, range(6)))
    got = {r[0]: r[1] for r in spark.table(made).groupBy("partition_name").agg(F.max("v")).collect()}
    assert [got[n] for n in names] == [1, 2, 3, 4, 5, 6] + [0] * 6
    assert spark.table(made).count() == 366
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(ValueError, match="dynamically"):  # it would empty the table
        overwrite(_rows(spark).withColumn("partition_name", F.lit(names[0])), made)


def test_show_partitions_feeds_pending_and_refresh_set(spark, made):
    partition_tables(spark, _spec("QUARTER"), _bind(_rows(spark), made), D(2020, 12, 1))
    found = catalog_partitions(spark, [made])
    assert {r.table_name for r in found.collect()} == {made} and found.count() == 4
    expected = found.select("table_name", "partition_name").unionByName(spark.createDataFrame([(made, "more")], found.schema))
    assert [tuple(r) for r in pending_partitions(expected, found).collect()] == [(made, "more")]
    scope = spark.createDataFrame([(made,)], "table_name string")
    assert resolve_refresh_set(scope, found).count() == 4


def test_run_on_a_catalog_table(spark, made):
    report = run(spark, _bind(_rows(spark, value=3), made), D(2020, 12, 1), partitions_config=_spec("MONTH", refresh_from="TODAY", number_of_intervals="2"))
    assert [(r.partition_name, r["rows"]) for r in report.collect()] == [("T's_20201101_20201130", 30), ("T's_20201201_20201231", 31)]


def test_ranges_by_name():
    assert range_of("T", "T_20200101_20200331")[2:4] == (D(2020, 1, 1), D(2020, 3, 31))
    for name in ("T", "U_20200101_20200331", "T_20200230_20200331", "T_2020_20200331"):
        assert range_of("T", name)[2:4] == (None, None)


def test_bindings_and_columns_are_checked(spark, made):
    rows = _rows(spark)
    for bad in (TableBinding(rows), TableBinding(rows, "/x", catalog_table=made)):
        with pytest.raises(ValueError, match="a folder or a catalog table"):
            bad.target("T")
    other = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE TABLE {other} (a INT, b STRING, c STRING) USING parquet PARTITIONED BY (b, c) LOCATION '{scratch_path(spark, 't-two')}'")
    try:
        with pytest.raises(ValueError, match="one column"):
            partition_names(spark, other)
    finally:
        spark.sql(f"DROP TABLE {other}")
