"""Ranges, refresh windows, selection lists."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from parcelwise.operators.ranges import overlapping_ranges, period_ranges, refresh_ranges, selection_list
from parcelwise.operators.selection import explode_selection
from parcelwise.sources.control import read_selection, read_spec, table_list

D = dt.date
MONTHS = {"MONTH": 1, "QUARTER": 3, "YEAR": 12}


def _add_months(d, n):
    y, m = divmod(d.month - 1 + n, 12)
    return D(d.year + y, m + 1, 1)


def brute_ranges(table, first, interval, as_of):
    """Plain-Python reference: calendar periods from first's to as_of's."""
    k = MONTHS[interval.upper()]
    start = lambda d: D(d.year, ((d.month - 1) // k) * k + 1, 1)
    p, last, out = start(first), start(as_of), []
    while p <= last:
        s, e = max(p, first), _add_months(p, k) - dt.timedelta(days=1)
        out.append((table, f"{table}_{s:%Y%m%d}_{e:%Y%m%d}", s, e))
        p = _add_months(p, k)
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_g1_sales_quarters(spark):
    spec = read_spec(spark, '[{"table":"Sales","first_date":"20200101","partition_by":"Order Date",'
                            '"interval":"QUARTER"}]')
    got = rows(period_ranges(spec, D(2025, 12, 27)))
    assert len(got) == 24
    assert got[0][1] == "Sales_20200101_20200331"
    assert got[-1][1] == "Sales_20251001_20251231"


def test_g2_two_tables_independent(spark):
    spec = read_spec(spark, [
        {"table": "Sales", "first_date": "20200101", "partition_by": "Delivery Date", "interval": "QUARTER"},
        {"table": "Orders", "first_date": "20250101", "partition_by": "Order Date", "interval": "MONTH"}])
    got = rows(period_ranges(spec, D(2025, 12, 27)))
    assert sum(1 for r in got if r[0] == "Sales") == 24
    orders = [r for r in got if r[0] == "Orders"]
    assert len(orders) == 12 and orders[0][1] == "Orders_20250101_20250131"


def test_g3_year_and_case_insensitive(spark):
    spec = read_spec(spark, [{"table": "Customer", "first_date": "20200101",
                              "partition_by": "Create Date", "interval": "year"}])
    got = rows(period_ranges(spec, D(2025, 12, 27)))
    assert [r[1] for r in got] == [f"Customer_{y}0101_{y}1231" for y in range(2020, 2026)]


def test_off_boundary_future_and_empty(spark):
    spec = read_spec(spark, [
        {"table": "A", "first_date": "20200215", "partition_by": "d", "interval": "QUARTER"},
        {"table": "B", "first_date": "20300101", "partition_by": "d", "interval": "MONTH"},
        {"table": "C", "first_date": "20200230", "partition_by": "d", "interval": "MONTH"},
        {"table": "E", "first_date": "20200101", "partition_by": "d", "interval": "WEEK"}])
    got = rows(period_ranges(spec, D(2020, 5, 1)))
    assert got == brute_ranges("A", D(2020, 2, 15), "QUARTER", D(2020, 5, 1))
    assert got[0][1] == "A_20200215_20200331"
    assert rows(period_ranges(read_spec(spark, "[]"), D(2020, 1, 1))) == []
    assert rows(period_ranges(read_spec(spark, ""), D(2020, 1, 1))) == []


def test_leap_day_and_last_day_of_period(spark):
    spec = read_spec(spark, [
        {"table": "L", "first_date": "20240229", "partition_by": "d", "interval": "MONTH"},
        {"table": "Q", "first_date": "20240331", "partition_by": "d", "interval": "QUARTER"}])
    got = rows(period_ranges(spec, D(2024, 4, 2)))
    assert ("L", "L_20240229_20240229", D(2024, 2, 29), D(2024, 2, 29)) in got
    assert ("Q", "Q_20240331_20240331", D(2024, 3, 31), D(2024, 3, 31)) in got
    assert ("Q", "Q_20240401_20240630", D(2024, 4, 1), D(2024, 6, 30)) in got


specs = st.lists(st.tuples(st.dates(D(1990, 1, 1), D(2030, 12, 31)),
                           st.sampled_from(sorted(MONTHS)),
                           st.dates(D(1990, 1, 1), D(2030, 12, 31))), min_size=1, max_size=6)


@settings(max_examples=8, deadline=None)
@given(specs)
def test_ranges_match_brute_force_and_tile(spark, items):
    # One spec row per item, each with its own as_of (a Column per row).
    data = [{"table": f"t{i}", "first_date": f"{fd:%Y%m%d}", "partition_by": "d", "interval": iv,
             "as_of": asof} for i, (fd, iv, asof) in enumerate(items)]
    spec = spark.createDataFrame(data, "table string, first_date string, partition_by string, "
                                       "interval string, as_of date")
    got = rows(period_ranges(spec))
    want = sorted(r for i, (fd, iv, asof) in enumerate(items) for r in brute_ranges(f"t{i}", fd, iv, asof))
    assert got == want
    # Gap-free and disjoint within each table.
    for t in {r[0] for r in got}:
        rs = [r for r in got if r[0] == t]
        for a, b in zip(rs, rs[1:]):
            assert b[2] == a[3] + dt.timedelta(days=1)
    assert overlapping_ranges(period_ranges(spec)).count() == 0


def test_g4_refresh_all_back_to_first(spark):
    spec = read_spec(spark, [{"table": "Sales", "first_date": "20200101", "partition_by": "Order Date",
                              "interval": "QUARTER", "refresh_from": "20250101",
                              "number_of_intervals": "*"}])
    got = rows(refresh_ranges(spec, D(2025, 12, 27)))
    assert got[0][1] == "Sales_20200101_20200331" and got[-1][1] == "Sales_20250101_20250331"
    assert len(got) == 21


def test_refresh_counts_back_today_and_clip(spark):
    spec = read_spec(spark, [
        {"table": "A", "first_date": "19950215", "partition_by": "d", "interval": "QUARTER",
         "refresh_from": "20010101", "number_of_intervals": "4"},
        {"table": "B", "first_date": "19950215", "partition_by": "d", "interval": "MONTH",
         "refresh_from": "TODAY", "number_of_intervals": "1"},
        {"table": "C", "first_date": "20000815", "partition_by": "d", "interval": "YEAR",
         "refresh_from": "today", "number_of_intervals": "10"},
        {"table": "D", "first_date": "20000101", "partition_by": "d", "interval": "YEAR",
         "refresh_from": "today", "number_of_intervals": "0"}])
    got = rows(refresh_ranges(spec, D(2001, 8, 1)))
    a = [r[1] for r in got if r[0] == "A"]
    assert a == ["A_20000401_20000630", "A_20000701_20000930", "A_20001001_20001231", "A_20010101_20010331"]
    assert [r[1] for r in got if r[0] == "B"] == ["B_20010801_20010831"]
    assert [r[1] for r in got if r[0] == "C"] == ["C_20000815_20001231", "C_20010101_20011231"]
    assert [r for r in got if r[0] == "D"] == []


def test_g5_selection_list_and_explode(spark):
    spec = read_spec(spark, [{"table": "Sales", "first_date": "20200101", "partition_by": "d",
                              "interval": "QUARTER", "refresh_from": "20200601",
                              "number_of_intervals": "2"}])
    sel = selection_list(refresh_ranges(spec, D(2025, 1, 1))).collect()
    assert [tuple(r) for r in sel] == [("Sales", "Sales_20200101_20200331,Sales_20200401_20200630")]
    exploded = rows(explode_selection(selection_list(refresh_ranges(spec, D(2025, 1, 1)))))
    assert exploded == [("Sales", "Sales_20200101_20200331"), ("Sales", "Sales_20200401_20200630")]


def test_selection_forms_blanks_and_duplicates(spark):
    csv = read_selection(spark, '[{"table":"Sales","selected_partitions":" a , ,b,a"}]')
    arr = read_selection(spark, '[{"table":"Sales","selected_partitions":["a","b","b"]}]')
    assert rows(explode_selection(csv)) == [("Sales", "a"), ("Sales", "b")]
    assert rows(explode_selection(arr)) == [("Sales", "a"), ("Sales", "b")]
    assert read_selection(spark, "  ") is None
    assert sorted(r.table_name for r in table_list(spark, "Sales,, Customer ,Sales").collect()) == \
        ["Customer", "Sales"]


def test_selection_json_round_trips(spark):
    from parcelwise.operators.ranges import selection_json

    spec = read_spec(spark, [
        {"table": "Sales", "first_date": "20200101", "partition_by": "d", "interval": "QUARTER",
         "refresh_from": "20200601", "number_of_intervals": "2"},
        {"table": "Orders", "first_date": "20200101", "partition_by": "d", "interval": "YEAR",
         "refresh_from": "TODAY", "number_of_intervals": "1"}])
    text = selection_json(selection_list(refresh_ranges(spec, D(2021, 3, 1)))).first()[0]
    assert text == ('[{"table":"Orders","selected_partitions":"Orders_20210101_20211231"},'
                    '{"table":"Sales","selected_partitions":"Sales_20200101_20200331,Sales_20200401_20200630"}]')
    back = rows(explode_selection(read_selection(spark, text)))
    assert back == [("Orders", "Orders_20210101_20211231"), ("Sales", "Sales_20200101_20200331"),
                    ("Sales", "Sales_20200401_20200630")]


def test_columns_catalog_from_session_catalog(spark):
    from parcelwise.sources.control import columns_catalog

    spark.createDataFrame([(1, D(2020, 1, 1))], "id int, sold_on date").createOrReplaceTempView("sales_v")
    got = sorted(tuple(r) for r in columns_catalog(spark, ["sales_v"]).collect())
    assert got == [("sales_v", "id"), ("sales_v", "sold_on")]


def test_counts_of_any_length(spark):
    """A count that reaches back to first_date or further equals ``*``; leading zeros are allowed."""
    def got(n):
        return rows(refresh_ranges(read_spec(spark, [{"table": "T", "first_date": "20200101", "partition_by": "d", "interval": "MONTH",
                                                      "refresh_from": "20210615", "number_of_intervals": n}]), D(2022, 1, 1)))
    everything = got("*")
    assert len(everything) == 18
    for n in ("18", "999999", "1000000", "2147483648", "9" * 60, "0" * 40 + "18"):
        assert got(n) == everything, n
    assert got("2") == everything[-2:] == got("0002")
    for n in ("0", "00", "-1", "1.5", "", " "):
        assert got(n) == [], n


def test_every_overlapping_pair_is_listed(spark):
    """A year with two months inside it overlaps both; ranges that only touch do not overlap."""
    given_ = [("T", "year", D(2020, 1, 1), D(2020, 12, 31)), ("T", "march", D(2020, 3, 1), D(2020, 3, 31)),
              ("T", "april", D(2020, 4, 1), D(2020, 4, 30)), ("T", "next", D(2021, 1, 1), D(2021, 1, 31)),
              ("U", "year", D(2020, 1, 1), D(2020, 12, 31)), ("T", "T", None, None)]
    df = spark.createDataFrame(given_, "table_name string, partition_name string, range_start date, range_end date")
    got = sorted((r.table_name, r.partition_name, r.next_partition) for r in overlapping_ranges(df.union(df)).collect())
    assert got == [("T", "year", "april"), ("T", "year", "march")]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 900), st.integers(0, 200)), max_size=12))
def test_overlaps_equal_brute_force(spark, spans):
    day = lambda n: D(2020, 1, 1) + dt.timedelta(days=n)
    given_ = [("T", f"r{i:02}", day(a), day(a + n)) for i, (a, n) in enumerate(spans)]
    df = spark.createDataFrame(given_, "table_name string, partition_name string, range_start date, range_end date")
    want = sorted(tuple(sorted((a[1], b[1]))) for i, a in enumerate(given_) for b in given_[:i] if a[2] <= b[3] and b[2] <= a[3])
    assert sorted(tuple(sorted((r.partition_name, r.next_partition))) for r in overlapping_ranges(df).collect()) == want
