"""Entry point "run": partition, then refresh, with the documented precedence.

The selection to refresh is, in order: the explicit ``partitions_to_refresh``;
else one derived from the spec (W9 -> W10: the last ``number_of_intervals``
periods back from ``refresh_from``); else none, meaning every partition of
the tables in scope.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.ranges import refresh_ranges, selection_list
from ..operators.validate import check_specs
from ..sources.control import columns_catalog, read_spec
from .partition import TableBinding, checked_spec, partition_tables
from .refresh import check_request, refresh

log = logging.getLogger("parcelwise.run")


def derived_selection(spark: SparkSession, spec, as_of, columns: DataFrame | None = None,
                      bindings: Mapping[str, TableBinding] | None = None) -> DataFrame:
    """(table, selected_partitions) from the spec's refresh window (W9 + W10)."""
    spec_df = read_spec(spark, spec)
    if columns is None and bindings is not None:
        columns = columns_catalog(spark, {t: b.source for t, b in bindings.items()})
    if columns is not None:
        check_specs(spec_df, columns, for_refresh=True)
    return selection_list(refresh_ranges(spec_df, as_of))


def _blank(value) -> bool:
    return value is None or (isinstance(value, str) and not value.strip())


def run(spark: SparkSession, bindings: Mapping[str, TableBinding], as_of, *,
        partitions_config=None, enable_partition: bool = True, enable_refresh: bool = True,
        tables_to_refresh=None, partitions_to_refresh=None,
        refresh_commit_mode: str = "transactional", refresh_max_parallelism: int = 4,
        edges=None, direction: str = "both", mode: str = "documented") -> DataFrame | None:
    """Partition (if enabled) and refresh (if enabled); returns the refresh report.

    Spec, table list, selection, refresh window and options are all checked before anything is written.
    """
    has_spec = not _blank(partitions_config)
    derive = enable_refresh and has_spec and _blank(partitions_to_refresh)
    if enable_partition and not has_spec:
        raise ValueError("a partition spec is required for partitioning")
    if has_spec:
        partitions_config = checked_spec(spark, partitions_config, bindings, for_refresh=derive)
    if enable_refresh:
        check_request(spark, bindings, tables_to_refresh, partitions_to_refresh, refresh_commit_mode,
                      refresh_max_parallelism, edges, direction, mode)
    if enable_partition:
        partition_tables(spark, partitions_config, bindings, as_of)
    if not enable_refresh:
        return None
    selection = None if _blank(partitions_to_refresh) else partitions_to_refresh
    if derive:
        selection = derived_selection(spark, partitions_config, as_of, bindings=bindings)
    elif selection is None:
        log.warning("no refresh information given: every partition in scope is refreshed")
    return refresh(spark, bindings, tables_to_refresh, selection, refresh_commit_mode,
                   refresh_max_parallelism, edges=edges, direction=direction, mode=mode)
