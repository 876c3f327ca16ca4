"""Create a table's date partitions (W13) and retire its catch-all partition.

Flow per table, in spec order (a failure stops the run; tables done before
it stay done): ranges from the spec (W2) -> pending = ranges that do not
exist (W7) -> write the pending partitions' rows -> one commit that adds them and drops the
catch-all partition (W13).  Re-running is safe, also after a run that broke off at any step: until the commit
nothing has changed, so the next run starts from the same state.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assign import uncovered_rows
from ..operators.ranges import overlapping_ranges, period_ranges
from ..operators.validate import check_specs, pending_partitions, raise_if_any
from ..session import local_frame
from ..sources.control import RANGES_SCHEMA, columns_catalog, read_spec
from ..sources.storage import manifest_frame
from .targets import CatalogTarget, FolderTarget

log = logging.getLogger("parcelwise.partition")


@dataclass(frozen=True)
class TableBinding:
    """Where a logical table's rows come from and where its partitions live: in a folder (``root``) or in a table of the
    session catalog (``catalog_table``)."""

    source: DataFrame
    root: str | None = None
    date_col: str | None = None
    catalog_table: str | None = None

    def target(self, table: str):
        if (self.root is None) == (self.catalog_table is None):
            raise ValueError(f"{table!r} needs a folder or a catalog table, and not both")
        spark = self.source.sparkSession
        return FolderTarget(spark, self.root) if self.root is not None else CatalogTarget(spark, self.catalog_table, table)


def ranges_frame(spark: SparkSession, partitions: list) -> DataFrame:
    """Partitions as (table_name, partition_name, range_start, range_end)."""
    return local_frame(spark, [tuple(p)[:4] for p in partitions], RANGES_SCHEMA)


def write_default_partition(source: DataFrame, root: str, table: str) -> None:
    """Store ``source`` whole as the catch-all partition named ``table``."""
    FolderTarget(source.sparkSession, root).put_whole(source, table)


def materialize_partitions(source: DataFrame, target, pending: DataFrame,
                           date_col: str, table: str | None = None,
                           rebalance: bool = True, retire: str | None = None) -> list[str]:
    """Write the rows of the ``pending`` ranges as partitions of ``target`` (a target or a folder).

    Refuses a range set that overlaps itself or the partitions that exist, with all overlapping pairs.  The source is read
    between the pending ranges' literal bounds, rows are tagged without a join (W4), and one commit adds all ranges, those
    without rows too, and drops the catch-all partition ``retire``.  Returns the created names.
    """
    spark = source.sparkSession
    target = FolderTarget(spark, target) if isinstance(target, str) else target
    if table is not None:
        pending = pending.where(F.col("table_name") == table)
    todo = pending.select(*RANGES_SCHEMA.names).collect()
    if todo:
        raise_if_any(overlapping_ranges(ranges_frame(spark, [*target.partitions(), *todo])), "overlapping ranges")
    return target.add(source, date_col, todo, retire, rebalance) if todo or retire else []


def manifest_profile(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """W6 of a table in a folder, from its manifest: (table_name, partition_name, n_rows, min_date, max_date).

    The statistics are those the writes counted, so no row is read; a partition without rows has ``n_rows`` 0.
    """
    rows = manifest_frame(spark, root)
    if table is not None:
        rows = rows.where(F.col("table_name") == table)
    return rows.select("table_name", "partition_name", "n_rows", "min_date", "max_date")


def _check_covered(source: DataFrame, date_col: str, table: str, ranges: list) -> None:
    lost = uncovered_rows(source, date_col, [r for r in ranges if r.range_start is not None])
    if not lost.isEmpty():
        raise ValueError(f"retiring the catch-all partition of {table!r} would hide rows that fall in no range")


def retire_default(spark: SparkSession, target, table: str, *, source: DataFrame | None = None,
                   date_col: str | None = None, require_covered: bool = False) -> bool:
    """Remove the catch-all partition named ``table``, if present.

    With ``require_covered`` (and ``source``/``date_col``), refuse while some
    source rows fall in no range (W8), since they would disappear from the
    partitioned table.  Returns whether a catch-all partition was removed.
    """
    target = FolderTarget(spark, target) if isinstance(target, str) else target
    held = target.partitions()
    if table not in {p.partition_name for p in held}:
        return False
    if require_covered:
        _check_covered(source, date_col, table, held)
    return target.drop([table])


def checked_spec(spark: SparkSession, spec, bindings: Mapping[str, TableBinding], columns: DataFrame | None = None,
                 for_refresh: bool = False) -> DataFrame:
    """The spec, after all its checks (W1): every table is bound, every column, date and interval is usable."""
    spec_df = read_spec(spark, spec)
    if columns is None:
        columns = columns_catalog(spark, {t: b.source for t, b in bindings.items()})
    check_specs(spec_df, columns, for_refresh)
    unbound = sorted({r.table for r in spec_df.collect()} - set(bindings))
    if unbound:
        raise ValueError(f"no source and target are given for the tables {unbound}")
    return spec_df


def partition_tables(spark: SparkSession, spec, bindings: Mapping[str, TableBinding], as_of,
                     columns: DataFrame | None = None, require_covered: bool = False) -> dict:
    """Entry point "partition": validate the spec, then create partitions table by table.

    ``bindings`` maps each table name to its source and target.  The column
    catalog defaults to the bindings' source schemas.  Returns
    {table: [created partition names]}.
    """
    spec_df = checked_spec(spark, spec, bindings, columns)
    created = {}
    for row in spec_df.collect():
        table, date_col = row["table"], row["partition_by"]
        binding = bindings[table]
        target = binding.target(table)
        expected = period_ranges(local_frame(spark, [tuple(row)], spec_df.schema), as_of)
        held = target.partitions()
        pending = pending_partitions(expected, ranges_frame(spark, held))
        retire = table if any(p.partition_name == table for p in held) else None
        try:
            if retire and require_covered:
                _check_covered(binding.source, date_col, table, [*held, *expected.collect()])
            created[table] = materialize_partitions(binding.source, target, pending, date_col, retire=retire)
            if retire:
                log.info("catch-all partition %s removed", table)
        except Exception:
            log.error("creating partitions failed for %s", table)
            raise
    return created
