"""Registered queries over the test tables, each with an equivalent DuckDB SQL.

Every query reads the given tables whole.  Where an operator consumes a
spec, the spec's dates come from the data (earliest / latest day of the
table), so the work grows with the tables.  Column names are aliased the
same way on both sides.

Fixed query parameters: ``FIRST_DATE`` is deliberately off a quarter
boundary and ``AS_OF`` lies inside the date range, for the queries whose feature is that rows before the
first date or after the last period are in no partition (assign, quarter profile, uncovered rows).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.periods import as_date, day_of
from .operators.assign import (
    assign_by_ranges,
    assign_partition,
    calendar_profile,
    partition_profile,
    slice_partition,
    uncovered_rows,
)
from .operators.closure import related_closure
from .operators.ranges import (
    overlapping_ranges,
    period_ranges,
    refresh_ranges,
    selection_json,
    selection_list,
)
from .operators.selection import (
    explode_selection,
    invalid_selection,
    refresh_scope,
    resolve_refresh_set,
    unavailable_tables,
    unknown_tables,
)
from .operators.validate import invalid_specs, pending_partitions
from .plans.orchestrate import run
from .plans.partition import TableBinding, manifest_profile, partition_tables, write_default_partition
from .plans.targets import FolderTarget
from .plans.refresh import refresh
from .session import drop_folder, local_frame, scratch_path
from .sources.catalog import catalog_partitions, create_table
from .sources.control import SPEC_SCHEMA, columns_catalog, read_spec, table_list
from .sources.storage import read_manifest, read_table

FIRST_DATE = "19950215"
AS_OF = dt.date(2001, 8, 1)
SLICE_START, SLICE_END = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
# Three irregular ranges over lineitem with a gap between the 2nd and 3rd.
IRREGULAR = [
    ("lineitem", "lineitem_19950310_19960704", dt.date(1995, 3, 10), dt.date(1996, 7, 4)),
    ("lineitem", "lineitem_19960705_19991231", dt.date(1996, 7, 5), dt.date(1999, 12, 31)),
    ("lineitem", "lineitem_20000601_20010228", dt.date(2000, 6, 1), dt.date(2001, 2, 28)),
]
# Orders quarters left out of the "existing" side of the pending diff.
DROPPED_QUARTERS = [dt.date(1996, 4, 1), dt.date(1998, 7, 1), dt.date(2000, 10, 1)]
# Foreign-key relationships between the test tables (table-level edges).
TABLE_EDGES = [
    ("lineitem", "orders"), ("lineitem", "part"), ("lineitem", "supplier"),
    ("orders", "customer"), ("customer", "nation"), ("supplier", "nation"),
    ("nation", "region"),
]
CATALOG_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
PROFILE_COLUMNS = ["table_name", "partition_name", "n_rows", "min_date", "max_date"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _first_last(df: DataFrame, col: str) -> DataFrame:
    """(first day as yyyyMMdd text, last day as DATE) of a table's date column."""
    return df.agg(F.date_format(F.min(col), "yyyyMMdd").alias("first_date"),
                  F.to_date(F.max(col)).alias("as_of"))


def _spec_row(df: DataFrame, table: str, col: str, interval: str,
              refresh_from=None, n=None) -> DataFrame:
    return (_first_last(df, col)
            .select(F.lit(table).alias("table"), "first_date", F.lit(col).alias("partition_by"),
                    F.lit(interval).alias("interval"),
                    (refresh_from if refresh_from is not None else F.lit(None)).cast("string")
                    .alias("refresh_from"),
                    F.lit(n).cast("string").alias("number_of_intervals"),
                    "as_of"))


def _extent_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spec rows whose first date and as_of are each table's own date extent."""
    return (_spec_row(_t(spark, sf_dir, "orders"), "orders", "o_orderdate", "QUARTER")
            .unionByName(_spec_row(_t(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate", "MONTH"))
            .unionByName(_spec_row(_t(spark, sf_dir, "events"), "events", "ts", "YEAR")))


def _extents(spark, sf_dir) -> dict[str, tuple]:
    """First and last day of orders, lineitem and events, by one job; nulls for an empty table."""
    parts = [_t(spark, sf_dir, name).agg(F.lit(name).alias("table"), F.to_date(F.min(col)).alias("first"), F.to_date(F.max(col)).alias("last"))
             for name, col in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))]
    return {r.table: (r.first, r.last) for r in parts[0].unionByName(parts[1]).unionByName(parts[2]).collect()}


def _refresh_spec(spark: SparkSession, sf_dir: str, extents: dict | None = None) -> DataFrame:
    """Refresh windows: last 4 quarters of orders up to its latest day; lineitem
    by year from FIRST_DATE up to TODAY (= its latest day); last 2 months of events."""
    extents = extents or _extents(spark, sf_dir)
    text = lambda d: f"{d:%Y%m%d}" if d else None
    (first_event, last_event), last_order, last_line = extents["events"], extents["orders"][1], extents["lineitem"][1]
    rows = [("orders", FIRST_DATE, "o_orderdate", "QUARTER", text(last_order), "4", last_order),
            ("lineitem", FIRST_DATE, "l_shipdate", "YEAR", "TODAY", "*", last_line),
            ("events", text(first_event), "ts", "MONTH", text(last_event), "2", last_event)]
    return local_frame(spark, rows, T.StructType([*SPEC_SCHEMA.fields, T.StructField("as_of", T.DateType())]))


def _extent(df: DataFrame, col: str) -> tuple[dt.date, dt.date]:
    """First and last day of a table's date column; no days (first after last) for an empty table."""
    row = df.agg(F.to_date(F.min(col)), F.to_date(F.max(col))).first()
    return (row[0], row[1]) if row[0] else (dt.date(1900, 2, 1), dt.date(1900, 1, 1))


def _whole_profile(spark, sf_dir, table, col, interval, extent: tuple | None = None):
    """Profile of all of a table's rows by calendar period."""
    df = _t(spark, sf_dir, table)
    return calendar_profile(df, table, col, interval, *(extent if extent and extent[0] else _extent(df, col)))


def _kept(spark, root, df: DataFrame) -> DataFrame:
    """A small result read from a scratch table, held by the driver so the table can go."""
    out = local_frame(spark, [tuple(r) for r in df.collect()], df.schema)
    drop_folder(spark, root)
    return out


def _orders_tagged(spark, sf_dir):
    return assign_partition(_t(spark, sf_dir, "orders"), "orders", "o_orderdate", "QUARTER",
                            FIRST_DATE, AS_OF)


def _orders_ranges(spark):
    spec = read_spec(spark, [{"table": "orders", "first_date": FIRST_DATE,
                              "partition_by": "o_orderdate", "interval": "QUARTER"}])
    return period_ranges(spec, AS_OF)


# --------------------------------------------------------------------------- queries

def q_orders_quarter_profile(spark, sf_dir):
    """Flagship: W2 -> W3 -> W6, every planned quarter with its row count."""
    return calendar_profile(_t(spark, sf_dir, "orders"), "orders", "o_orderdate", "QUARTER", FIRST_DATE, AS_OF,
                            manifest=_orders_ranges(spark))


def q_invalid_specs(spark, sf_dir):
    o, li, ev = (_t(spark, sf_dir, n) for n in ("orders", "lineitem", "events"))
    spec = (o.agg(F.lit("orders").alias("table"),
                  F.date_format(F.min("o_orderdate"), "yyyyMMdd").alias("first_date"),
                  F.lit("o_orderdate").alias("partition_by"), F.lit("QUARTER").alias("interval"),
                  F.lit("TODAY").alias("refresh_from"), F.lit("4").alias("number_of_intervals"))
            .unionByName(li.agg(F.lit("lineitem").alias("table"),
                                F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_date"),
                                F.lit("l_shipdate").alias("partition_by"),
                                F.lit("quarter").alias("interval"),
                                F.date_format(F.max("l_shipdate"), "yyyyMMdd").alias("refresh_from"),
                                F.lit("*").alias("number_of_intervals")))
            .unionByName(ev.agg(F.lit("events").alias("table"),
                                F.date_format(F.min("ts"), "yyyyMMdd").alias("first_date"),
                                F.lit("event_date").alias("partition_by"),
                                F.lit("WEEK").alias("interval"),
                                F.date_format(F.max("ts"), "yyyyMMdd").alias("refresh_from"),
                                F.lit("0").alias("number_of_intervals"))))
    columns = columns_catalog(spark, {"orders": o, "lineitem": li, "events": ev})
    return invalid_specs(spec, columns, for_refresh=True)


def q_period_ranges(spark, sf_dir):
    return period_ranges(_extent_spec(spark, sf_dir))


def q_assign_partition_orders(spark, sf_dir):
    return _orders_tagged(spark, sf_dir).select("o_orderkey", "partition_name")


def _irregular(spark):
    return spark.createDataFrame(IRREGULAR, "table_name string, partition_name string, "
                                            "range_start date, range_end date")


def q_assign_by_ranges_lineitem(spark, sf_dir):
    tagged = assign_by_ranges(_t(spark, sf_dir, "lineitem"), "l_shipdate", _irregular(spark), "lineitem")
    return tagged.select("l_orderkey", "l_linenumber", "partition_name")


def q_slice_partition_events(spark, sf_dir):
    return (slice_partition(_t(spark, sf_dir, "events"), "ts", SLICE_START, SLICE_END)
            .select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day")))


def q_partition_profile_lineitem(spark, sf_dir):
    return _whole_profile(spark, sf_dir, "lineitem", "l_shipdate", "QUARTER")


def q_pending_partitions(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    first, last = _extent(orders, "o_orderdate")
    q = F.trunc(day_of("o_orderdate"), "QUARTER")
    kept = orders.where(~q.isin([as_date(d) for d in DROPPED_QUARTERS]))
    existing = calendar_profile(kept, "orders", "o_orderdate", "QUARTER", first, last)
    return pending_partitions(period_ranges(_spec_row(orders, "orders", "o_orderdate", "QUARTER")), existing)


def q_uncovered_rows_orders(spark, sf_dir):
    return (uncovered_rows(_t(spark, sf_dir, "orders"), "o_orderdate", _orders_ranges(spark), "orders")
            .select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate")))


def q_refresh_ranges(spark, sf_dir):
    return refresh_ranges(_refresh_spec(spark, sf_dir))


def q_selection_list(spark, sf_dir):
    return selection_list(refresh_ranges(_refresh_spec(spark, sf_dir)))


def q_explode_selection(spark, sf_dir):
    return explode_selection(selection_list(refresh_ranges(_refresh_spec(spark, sf_dir))))


def _row_edges(spark, sf_dir):
    """Row-level relationship graph: customer/supplier -> nation -> region."""
    n = _t(spark, sf_dir, "nation")
    c = _t(spark, sf_dir, "customer")
    s = _t(spark, sf_dir, "supplier")
    v = lambda kind, col: F.concat(F.lit(kind + ":"), F.col(col).cast("string"))
    return (n.select(v("nation", "n_nationkey").alias("src"), v("region", "n_regionkey").alias("dst"))
            .unionByName(c.select(v("customer", "c_custkey").alias("src"),
                                  v("nation", "c_nationkey").alias("dst")))
            .unionByName(s.select(v("supplier", "s_suppkey").alias("src"),
                                  v("nation", "s_nationkey").alias("dst"))))


def q_related_closure(spark, sf_dir):
    seeds = (_t(spark, sf_dir, "region").where(F.col("r_regionkey") == 0)
             .select(F.concat(F.lit("region:"), F.col("r_regionkey").cast("string")).alias("v")))
    return related_closure(_row_edges(spark, sf_dir), seeds)


def _catalog_partitions(spark, sf_dir, extents):
    """Partition catalog derived from the data: quarters of orders, years of
    lineitem, months of events, and the catch-all partition of the others."""
    orders = _whole_profile(spark, sf_dir, "orders", "o_orderdate", "QUARTER", extents["orders"])
    lineitem = _whole_profile(spark, sf_dir, "lineitem", "l_shipdate", "YEAR", extents["lineitem"])
    events = _whole_profile(spark, sf_dir, "events", "ts", "MONTH", extents["events"])
    parts = [p.select("table_name", "partition_name") for p in (orders, lineitem, events)]
    for name in ("region", "nation", "customer", "supplier", "part"):
        # One catch-all partition per non-empty table.
        parts.append(_t(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > 0)
                     .select(F.lit(name).alias("table_name"), F.lit(name).alias("partition_name")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _refresh_set(spark, sf_dir, mode, tables=("orders", "events")):
    available = spark.createDataFrame([(t,) for t in CATALOG_TABLES], "table_name string")
    scope = refresh_scope(table_list(spark, "orders"), available, TABLE_EDGES)
    extents = _extents(spark, sf_dir)
    selection = selection_list(refresh_ranges(_refresh_spec(spark, sf_dir, extents))
                               .where(F.col("table_name").isin(*tables)))
    return resolve_refresh_set(scope, _catalog_partitions(spark, sf_dir, extents), selection, mode)


def q_refresh_set_all_unavailable(spark, sf_dir):
    """Every selected table is outside the scope: everything in scope is refreshed."""
    return _refresh_set(spark, sf_dir, "selected_only", tables=("events",))


def q_unknown_tables(spark, sf_dir):
    """Requested names (a table's values beside a real table) that are no tables."""
    requested = (_t(spark, sf_dir, "events").select(F.col("event_type").alias("table_name")).distinct()
                 .unionByName(table_list(spark, "orders")))
    return unknown_tables(requested, spark.createDataFrame([(t,) for t in CATALOG_TABLES], "table_name string"))


def _chosen(spark, sf_dir):
    return explode_selection(selection_list(refresh_ranges(_refresh_spec(spark, sf_dir))))


def q_unavailable_tables(spark, sf_dir):
    """Selected tables of which only orders has partitions."""
    return unavailable_tables(_chosen(spark, sf_dir), _whole_profile(spark, sf_dir, "orders", "o_orderdate", "QUARTER"))


def q_invalid_selection(spark, sf_dir):
    """Selected quarters of orders that do not exist in a table without the second halves of the years."""
    some = _t(spark, sf_dir, "orders").where(F.month("o_orderdate") <= 6)
    existing = calendar_profile(some, "orders", "o_orderdate", "QUARTER", *_extent(_t(spark, sf_dir, "orders"), "o_orderdate"))
    return invalid_selection(_chosen(spark, sf_dir), existing)


def q_refresh_set_documented(spark, sf_dir):
    return _refresh_set(spark, sf_dir, "documented")


def q_refresh_set_selected_only(spark, sf_dir):
    return _refresh_set(spark, sf_dir, "selected_only")


def _profile_of_target(spark, root, table, date_col):
    data = read_table(spark, root)
    return _kept(spark, root, partition_profile(data, date_col, table).select(*PROFILE_COLUMNS))


def _spec_of(df, table, date_col, interval, **more) -> tuple[list[dict], dt.date]:
    """A spec from the table's first day, and the table's last day."""
    first, last = _extent(df, date_col)
    return [{"table": table, "first_date": f"{first:%Y%m%d}", "partition_by": date_col, "interval": interval, **more}], last


def q_materialize_readback(spark, sf_dir):
    root = scratch_path(spark, "orders")
    src = _t(spark, sf_dir, "orders")
    write_default_partition(src, root, "orders")
    spec, last = _spec_of(src, "orders", "o_orderdate", "QUARTER")
    partition_tables(spark, spec, {"orders": TableBinding(src, root, "o_orderdate")}, last)
    return _profile_of_target(spark, root, "orders", "o_orderdate")


def q_rematerialize_after_empty(spark, sf_dir):
    """A run that broke off after its rows were written and before they were committed, then a run over a
    source without one year: nothing of the first run is seen."""
    root = scratch_path(spark, "orders-again")
    src = _t(spark, sf_dir, "orders")
    spec, last = _spec_of(src, "orders", "o_orderdate", "YEAR")
    FolderTarget(spark, root).stage(src, "o_orderdate", period_ranges(read_spec(spark, spec), last).collect())
    later = src.where(F.year("o_orderdate") != 1998)
    partition_tables(spark, spec, {"orders": TableBinding(later, root, "o_orderdate")}, last)
    return _profile_of_target(spark, root, "orders", "o_orderdate")


def q_manifest_empty_partitions(spark, sf_dir):
    """Months of events up to two months after its last day: recorded partitions without rows count 0."""
    root = scratch_path(spark, "events")
    src = _t(spark, sf_dir, "events")
    spec, last = _spec_of(src, "events", "ts", "MONTH")
    partition_tables(spark, spec, {"events": TableBinding(src, root, "ts")}, last.replace(day=1) + dt.timedelta(days=62))
    profile = partition_profile(read_table(spark, root), "ts", "events", manifest=read_manifest(spark, root))
    return _kept(spark, root, profile.select(*PROFILE_COLUMNS))


def _lineitem_spec(spark, sf_dir):
    return _spec_of(_t(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate", "QUARTER",
                    refresh_from="TODAY", number_of_intervals="4")


def _stale_then_refresh(spark, sf_dir, commit_mode):
    """Partition a stale copy of lineitem (open lines only), then refresh the
    last four quarters from the full table; returns (root, report)."""
    root = scratch_path(spark, f"lineitem-{commit_mode}")
    full = _t(spark, sf_dir, "lineitem")
    stale = full.where(F.col("l_linestatus") == "O")
    spec, last = _lineitem_spec(spark, sf_dir)
    partition_tables(spark, spec, {"lineitem": TableBinding(stale, root, "l_shipdate")}, last)
    selection = selection_list(refresh_ranges(read_spec(spark, spec), last))
    report = refresh(spark, {"lineitem": TableBinding(full, root, "l_shipdate")},
                     "lineitem", selection, commit_mode, max_parallelism=4)
    return root, report


def q_run_precedence(spark, sf_dir):
    """``run`` with a spec and an explicit selection: only the explicit partition (the first quarter) is
    refreshed, by the date column recorded when it was created."""
    root = scratch_path(spark, "lineitem-run")
    full = _t(spark, sf_dir, "lineitem")
    spec, last = _lineitem_spec(spark, sf_dir)
    partition_tables(spark, spec, {"lineitem": TableBinding(full.where("l_linestatus = 'O'"), root)}, last)
    first = period_ranges(read_spec(spark, spec), last).orderBy("range_start").first().partition_name
    report = run(spark, {"lineitem": TableBinding(full, root)}, last, partitions_config=spec, enable_partition=False,
                 partitions_to_refresh=[{"table": "lineitem", "selected_partitions": [first]}])
    return _kept(spark, root, report)


def q_refresh_transactional_readback(spark, sf_dir):
    root, _ = _stale_then_refresh(spark, sf_dir, "transactional")
    return _profile_of_target(spark, root, "lineitem", "l_shipdate")


def q_refresh_partial_readback(spark, sf_dir):
    root, _ = _stale_then_refresh(spark, sf_dir, "partialBatch")
    return _profile_of_target(spark, root, "lineitem", "l_shipdate")


def q_refresh_report(spark, sf_dir):
    root, report = _stale_then_refresh(spark, sf_dir, "transactional")
    return _kept(spark, root, report)


def q_related_closure_components(spark, sf_dir):
    """Same closure as ``related_closure``, by connected-component labels."""
    seeds = (_t(spark, sf_dir, "region").where(F.col("r_regionkey") == 0)
             .select(F.concat(F.lit("region:"), F.col("r_regionkey").cast("string")).alias("v")))
    return related_closure(_row_edges(spark, sf_dir), seeds, method="components")


def q_related_closure_out(spark, sf_dir):
    """Directed closure over rows: the orders of a customer, their lines' parts and suppliers, and where those are."""
    v = lambda kind, col: F.concat(F.lit(kind + ":"), F.col(col).cast("string"))
    orders, lines = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem")
    edges = (orders.select(v("customer", "o_custkey").alias("src"), v("order", "o_orderkey").alias("dst"))
             .unionByName(lines.select(v("order", "l_orderkey").alias("src"), v("supplier", "l_suppkey").alias("dst")))
             .unionByName(lines.select(v("order", "l_orderkey").alias("src"), v("part", "l_partkey").alias("dst")))
             .unionByName(_t(spark, sf_dir, "supplier").select(v("supplier", "s_suppkey").alias("src"), v("nation", "s_nationkey").alias("dst")))
             .unionByName(_t(spark, sf_dir, "nation").select(v("nation", "n_nationkey").alias("src"), v("region", "n_regionkey").alias("dst"))))
    seeds = orders.agg(F.min("o_custkey").alias("o_custkey")).select(v("customer", "o_custkey").alias("v"))
    return related_closure(edges, seeds, direction="out")


def _manifest_profile(spark, root):
    """W6 from the manifest alone, held by the driver."""
    return _kept(spark, root, manifest_profile(spark, root).select(*PROFILE_COLUMNS))


def q_manifest_profile(spark, sf_dir):
    """W6 of a materialised table from the statistics its writes counted: no row is read."""
    root = scratch_path(spark, "lineitem-stats")
    src = _t(spark, sf_dir, "lineitem")
    spec, last = _spec_of(src, "lineitem", "l_shipdate", "MONTH")
    partition_tables(spark, spec, {"lineitem": TableBinding(src, root, "l_shipdate")}, last)
    return _manifest_profile(spark, root)


def q_concurrent_manifest(spark, sf_dir):
    """Each quarter of orders is created by a writer of its own, all at once on one folder; one quarter by two of them."""
    root = scratch_path(spark, "orders-many")
    src = _t(spark, sf_dir, "orders")
    spec, last = _spec_of(src, "orders", "o_orderdate", "QUARTER")
    ranges = period_ranges(read_spec(spark, spec), last).orderBy("range_start").collect()
    work = [[r] for r in ranges] + [[ranges[0]]]
    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(lambda part: FolderTarget(spark, root).add(src, "o_orderdate", part), work))
    return _profile_of_target(spark, root, "orders", "o_orderdate")


def q_refresh_crash_readback(spark, sf_dir):
    """A refresh of all years of orders breaks off after its rows are written and before its commit: readers see the old rows."""
    root = scratch_path(spark, "orders-crash")
    src = _t(spark, sf_dir, "orders")
    spec, last = _spec_of(src, "orders", "o_orderdate", "YEAR")
    old = src.where(F.col("o_orderstatus") == "O")
    partition_tables(spark, spec, {"orders": TableBinding(old, root, "o_orderdate")}, last)
    target = FolderTarget(spark, root)
    target.stage(src, "o_orderdate", target.partitions())  # and no commit
    return _profile_of_target(spark, root, "orders", "o_orderdate")


def q_scattered_refresh_readback(spark, sf_dir):
    """Every other month of a stale lineitem is refreshed: many separate intervals in one write."""
    root = scratch_path(spark, "lineitem-scattered")
    full = _t(spark, sf_dir, "lineitem")
    spec, last = _spec_of(full, "lineitem", "l_shipdate", "MONTH")
    partition_tables(spark, spec, {"lineitem": TableBinding(full.where("l_linestatus = 'O'"), root, "l_shipdate")}, last)
    names = [p.partition_name for p in FolderTarget(spark, root).partitions() if p.range_start.month % 2 == 1]
    refresh(spark, {"lineitem": TableBinding(full, root, "l_shipdate")}, "lineitem", [{"table": "lineitem", "selected_partitions": names}])
    return _profile_of_target(spark, root, "lineitem", "l_shipdate")


def _catalog_table(spark, rows, label):
    """A fresh partitioned table of the session catalog, and its folder."""
    folder = scratch_path(spark, label)
    name = "parcelwise_" + folder.rsplit("-", 1)[1]
    create_table(spark, name, rows, folder)
    return name, folder


def q_catalog_partitions(spark, sf_dir):
    """``SHOW PARTITIONS`` of a catalog table that was partitioned by quarter up to 180 days after its last day, empty quarters
    too, and what a plan of 360 days still lacks (W7)."""
    src = _t(spark, sf_dir, "orders")
    name, folder = _catalog_table(spark, src, "catalog-orders")
    spec, last = _spec_of(src, "orders", "o_orderdate", "QUARTER")
    try:
        binding = TableBinding(src, date_col="o_orderdate", catalog_table=name)
        binding.target("orders").put_whole(src, "orders")
        partition_tables(spark, spec, {"orders": binding}, last + dt.timedelta(days=180))
        found = catalog_partitions(spark, [name]).withColumn("table_name", F.lit("orders"))
        planned = period_ranges(read_spec(spark, spec), last + dt.timedelta(days=360))
        pending = pending_partitions(planned, found).select("table_name", "partition_name")
        out = found.withColumn("state", F.lit("exists")).unionByName(pending.withColumn("state", F.lit("pending")))
        return local_frame(spark, [tuple(r) for r in out.collect()], out.schema)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_folder(spark, folder)


def q_catalog_refresh_readback(spark, sf_dir):
    """A catalog table of open orders by year; the last two years are refreshed at once and the first alone, 1998 loses its rows."""
    src = _t(spark, sf_dir, "orders")
    name, folder = _catalog_table(spark, src, "catalog-refresh")
    spec, last = _spec_of(src, "orders", "o_orderdate", "YEAR")
    bind = lambda rows: {"orders": TableBinding(rows, date_col="o_orderdate", catalog_table=name)}
    try:
        partition_tables(spark, spec, bind(src.where(F.col("o_orderstatus") == "O")), last)
        years = [p.partition_name for p in bind(src)["orders"].target("orders").partitions()]
        later = src.where(F.year("o_orderdate") != 1998)
        of = lambda ns: [{"table": "orders", "selected_partitions": ns}]
        refresh(spark, bind(later), "orders", of(sorted(years)[-2:]))
        refresh(spark, bind(later), "orders", of([sorted(years)[0], *[n for n in years if "_1998" in n]]), "partialBatch", max_parallelism=2)
        out = partition_profile(spark.table(name), "o_orderdate", "orders").select(*PROFILE_COLUMNS)
        return local_frame(spark, [tuple(r) for r in out.collect()], out.schema)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_folder(spark, folder)


def q_overlapping_ranges_orders(spark, sf_dir):
    """Quarterly and monthly ranges over the orders extent side by side (as
    after an interval change): the overlaps a writer refuses."""
    o = _t(spark, sf_dir, "orders")
    both = (_spec_row(o, "orders", "o_orderdate", "QUARTER")
            .unionByName(_spec_row(o, "orders", "o_orderdate", "MONTH")))
    return overlapping_ranges(period_ranges(both))


def q_selection_json(spark, sf_dir):
    return selection_json(selection_list(refresh_ranges(_refresh_spec(spark, sf_dir))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders_quarter_profile": q_orders_quarter_profile,
    "invalid_specs": q_invalid_specs,
    "period_ranges": q_period_ranges,
    "assign_partition_orders": q_assign_partition_orders,
    "assign_by_ranges_lineitem": q_assign_by_ranges_lineitem,
    "slice_partition_events": q_slice_partition_events,
    "partition_profile_lineitem": q_partition_profile_lineitem,
    "pending_partitions": q_pending_partitions,
    "uncovered_rows_orders": q_uncovered_rows_orders,
    "refresh_ranges": q_refresh_ranges,
    "selection_list": q_selection_list,
    "explode_selection": q_explode_selection,
    "related_closure": q_related_closure,
    "refresh_set_documented": q_refresh_set_documented,
    "refresh_set_selected_only": q_refresh_set_selected_only,
    "refresh_set_all_unavailable": q_refresh_set_all_unavailable,
    "unknown_tables": q_unknown_tables,
    "unavailable_tables": q_unavailable_tables,
    "invalid_selection": q_invalid_selection,
    "materialize_readback": q_materialize_readback,
    "rematerialize_after_empty": q_rematerialize_after_empty,
    "manifest_empty_partitions": q_manifest_empty_partitions,
    "run_precedence": q_run_precedence,
    "refresh_transactional_readback": q_refresh_transactional_readback,
    "refresh_partial_readback": q_refresh_partial_readback,
    "refresh_report": q_refresh_report,
    "related_closure_components": q_related_closure_components,
    "overlapping_ranges_orders": q_overlapping_ranges_orders,
    "related_closure_out": q_related_closure_out,
    "manifest_profile": q_manifest_profile,
    "concurrent_manifest": q_concurrent_manifest,
    "refresh_crash_readback": q_refresh_crash_readback,
    "scattered_refresh_readback": q_scattered_refresh_readback,
    "catalog_partitions": q_catalog_partitions,
    "catalog_refresh_readback": q_catalog_refresh_readback,
    "selection_json": q_selection_json,
}
