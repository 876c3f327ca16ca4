"""Spec validation, including the negative cases of the original checks."""

import pytest

from parcelwise.operators.validate import check_specs, invalid_specs
from parcelwise.sources.control import columns_catalog, read_spec


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame([("orders", "o_orderdate"), ("events", "ts")],
                                 "table_name string, column_name string")


def test_bad_rows_are_reported(spark, catalog):
    spec = read_spec(spark, [
        {"table": "orders", "first_date": "20200101", "partition_by": "o_orderdate", "interval": "quarter"},
        {"table": "orders", "first_date": "20200230", "partition_by": "o_orderdate", "interval": "QUARTER"},
        {"table": "orders", "first_date": "2020-01-01", "partition_by": "o_orderdate", "interval": "MONTH"},
        {"table": "orders", "first_date": "20200101", "partition_by": "o_shipdate", "interval": "YEAR"},
        {"table": "returns", "first_date": "20200101", "partition_by": "o_orderdate", "interval": "YEAR"},
        {"table": "events", "first_date": "20200101", "partition_by": "ts", "interval": "WEEK"}])
    got = sorted((r.table, r.partition_by, r.reason, r.value) for r in invalid_specs(spec, catalog).collect())
    assert got == sorted([
        ("orders", "o_orderdate", "invalid first_date", "20200230"),
        ("orders", "o_orderdate", "invalid first_date", "2020-01-01"),
        ("orders", "o_shipdate", "unknown table or column", "o_shipdate"),
        ("returns", "o_orderdate", "unknown table or column", "o_orderdate"),
        ("events", "ts", "invalid interval", "WEEK")])
    with pytest.raises(ValueError, match="invalid partition spec"):
        check_specs(spec, catalog)


def test_refresh_fields(spark, catalog):
    spec = read_spec(spark, [
        {"table": "orders", "first_date": "20200101", "partition_by": "o_orderdate", "interval": "QUARTER",
         "refresh_from": "TODAY", "number_of_intervals": "*"},
        {"table": "orders", "first_date": "20200101", "partition_by": "o_orderdate", "interval": "QUARTER",
         "refresh_from": "yesterday", "number_of_intervals": "0"},
        {"table": "events", "first_date": "20200101", "partition_by": "ts", "interval": "YEAR"}])
    reasons = sorted(r.reason for r in invalid_specs(spec, catalog, for_refresh=True).collect())
    assert reasons == ["invalid number_of_intervals", "invalid number_of_intervals",
                       "invalid refresh_from", "invalid refresh_from"]
    check_specs(spec, catalog)  # fine for partitioning, which does not need them


def test_json_spec_keeps_text_and_catalog_from_frames(spark):
    spec = read_spec(spark, '[{"table":"T","first_date":"20200101","partition_by":"d",'
                            '"interval":"MONTH","refresh_from":"20200101","number_of_intervals":"*"},'
                            '{"table":"T","first_date":"20200101","partition_by":"d","interval":"MONTH",'
                            '"refresh_from":"20200101","number_of_intervals":"4"}]')
    assert [r.number_of_intervals for r in spec.collect()] == ["*", "4"]
    frame = spark.createDataFrame([(1, None)], "d int, x string")
    assert invalid_specs(spec, columns_catalog(spark, {"T": frame}), for_refresh=True).count() == 0
