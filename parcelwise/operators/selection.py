"""Which partitions to refresh: explode selections (W11) and resolve them.

The refresh set is computed as joins: semi-joins keep what is available,
anti-joins find what is not.  Input that names nothing, or something that does not exist, is
reported whole and never widens the refresh set.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_frame
from ..sources.control import TABLES_SCHEMA
from .closure import related_closure
from .validate import InvalidInput, raise_if_any

log = logging.getLogger("parcelwise.selection")

KEYS = ["table_name", "partition_name"]
KEYS_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in KEYS])
MODES = ("documented", "selected_only")


def explode_selection(selection: DataFrame) -> DataFrame:
    """(table, selected_partitions) -> distinct, trimmed (table_name, partition_name).

    ``selected_partitions`` may be CSV text or ARRAY<STRING>.  Blank names
    are dropped; a name listed twice counts once.
    """
    field = selection.schema["selected_partitions"].dataType
    names = (F.col("selected_partitions") if isinstance(field, T.ArrayType)
             else F.split(F.col("selected_partitions"), ","))
    return (selection
            .select(F.trim(F.col("table")).alias("table_name"), F.explode(names).alias("_p"))
            .select("table_name", F.trim("_p").alias("partition_name"))
            .where(F.col("table_name").isNotNull() & (F.col("table_name") != "")
                   & F.col("partition_name").isNotNull() & (F.col("partition_name") != ""))
            .distinct())


def unknown_tables(tables: DataFrame, available: DataFrame) -> DataFrame:
    """Requested tables that are not in the catalog."""
    return tables.join(available.select("table_name").distinct(), "table_name", "left_anti")


def refresh_scope(tables: DataFrame | None, available: DataFrame,
                  edges=None, direction: str = "both") -> DataFrame:
    """Tables to refresh: the requested ones plus related tables, or all.

    Unknown requested tables raise ``InvalidInput`` with all of them.  Without a request every
    available table is in scope.  ``edges`` is a DataFrame (src, dst), or pairs the driver
    holds, which are then followed there.  Output: ``table_name``.
    """
    available = available.select("table_name").distinct()
    if tables is None:
        return available
    raise_if_any(unknown_tables(tables, available), "invalid table names")
    if edges is None:
        return tables.select("table_name").distinct()
    if isinstance(edges, DataFrame):
        scope = related_closure(edges, tables.select("table_name"), direction)
    else:
        seeds = [r.table_name for r in tables.select("table_name").distinct().collect()]
        scope = local_frame(tables.sparkSession, [(t,) for t in related_names(edges, seeds, direction)], TABLES_SCHEMA)
    # Related vertices that are not tables of the catalog are not refreshable.
    return scope.join(available, "table_name", "left_semi")


def related_names(edges, seeds: list[str], direction: str = "both") -> list[str]:
    """The seeds and every table reachable over a few pairs (src, dst) that the driver holds."""
    if direction not in ("both", "out"):
        raise ValueError("direction must be 'both' or 'out'")
    near: dict[str, set] = {}
    for src, dst in edges:
        near.setdefault(src, set()).add(dst)
        if direction == "both":
            near.setdefault(dst, set()).add(src)
    reached, todo = set(seeds), list(seeds)
    while todo:
        new = near.get(todo.pop(), set()) - reached
        reached |= new
        todo += new
    return sorted(reached)


def unavailable_tables(selected: DataFrame, available_partitions: DataFrame) -> DataFrame:
    """Selected tables that have no available partition (in scope)."""
    return (selected.select("table_name").distinct()
            .join(available_partitions.select("table_name"), "table_name", "left_anti"))


def invalid_selection(selected: DataFrame, available_partitions: DataFrame) -> DataFrame:
    """Selected (table, partition) pairs of available tables that do not exist."""
    of_available = selected.join(available_partitions.select("table_name"), "table_name", "left_semi")
    return of_available.join(available_partitions, KEYS, "left_anti")


def resolve_refresh_set(scope: DataFrame, partitions: DataFrame, selection: DataFrame | None = None,
                        mode: str = "documented") -> DataFrame:
    """(table_name, partition_name) to refresh.

    * no selection: every partition of every table in scope;
    * a selection that names no table, or a record without a table or a partition: ``ValueError``;
    * selected tables without available partitions: warning only; if that
      is every selected table, everything in scope is refreshed;
    * a selected partition that does not exist: ``InvalidInput`` with all of them;
    * ``mode='documented'``: selected tables refresh only their listed
      partitions, other tables in scope refresh all of theirs;
    * ``mode='selected_only'``: only the listed partitions.

    The catalog and the selection (one row per partition, the driver's own
    metadata) are each computed once; the checks and the result use those rows.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    available = (partitions.select(*KEYS).distinct()
                 .join(scope.select("table_name"), "table_name", "left_semi"))
    if selection is None:
        return available
    chosen = choose_partitions([tuple(r) for r in available.collect()], named_partitions(selection), mode)
    return local_frame(partitions.sparkSession, chosen, KEYS_SCHEMA)


def choose_partitions(available: list[tuple], selected: list[tuple], mode: str = "documented") -> list[tuple]:
    """The rule of ``resolve_refresh_set`` for (table, partition) pairs that the driver holds."""
    existing, tables = set(available), {t for t, _ in available}
    named = {t for t, _ in selected}
    if missing := sorted(named - tables):
        log.warning("%d selected tables without available partitions: %s", len(missing), missing)
    if not named & tables:
        return sorted(existing)
    bad = [{"table_name": t, "partition_name": p} for t, p in selected if t in tables and (t, p) not in existing]
    if bad:
        raise InvalidInput("invalid partitions", bad)
    picked = existing & set(selected)
    if mode == "documented":
        picked |= {k for k in existing if k[0] not in named}
    return sorted(picked)


def named_partitions(selection: DataFrame) -> list[tuple]:
    """Rows of ``explode_selection``, after a check that every record names a table and a partition."""
    field = selection.schema["selected_partitions"].dataType
    names = F.col("selected_partitions") if isinstance(field, T.ArrayType) else F.split("selected_partitions", ",")
    names = F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n.isNotNull() & (n != ""))
    rows = selection.select(F.trim("table").alias("table"), names.alias("names")).collect()
    bad = [r.table for r in rows if not r.table or not r.names]
    if bad or not rows:
        raise ValueError(f"the selection has {len(bad)} records without a table or a partition: {bad}" if bad
                         else "the selection names no table")
    return sorted({(r.table, n) for r in rows for n in r.names})
