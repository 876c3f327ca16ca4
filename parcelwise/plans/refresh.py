"""Recompute only the selected partitions (W14, W15) and report the outcome.

* ``transactional`` (W14): one write per table covers all of that table's selected partitions (up to
  ``max_parallelism`` tables at once).  The source is read between literal bounds, so Parquet skips the rest, rows are tagged
  without a join, and one commit publishes everything or nothing.
* ``partialBatch`` (W15): partitions are packed into writes by their size, at most ``max_parallelism`` running at once.  A
  partition of ``PACK_BYTES`` or more has a write of its own.  If a pack fails, its partitions are written one by one, so a failure
  is recorded for the partition it belongs to and never stops the others.

A partition that no longer has source rows is committed without a folder, like any other change.  The report's rows are what the
writes counted and the commits confirmed; the target is not read.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.selection import MODES, choose_partitions, named_partitions, refresh_scope, related_names
from ..operators.validate import InvalidInput
from ..session import local_frame
from ..sources.control import TABLES_SCHEMA, list_names, read_selection, table_list
from ..sources.storage import Partition
from .partition import TableBinding

log = logging.getLogger("parcelwise.refresh")

# The commit modes a refresh accepts.
COMMIT_MODES = ("transactional", "partialBatch")
REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("partition_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
])
# Refresh outcome states.
COMPLETED = "Completed"
FAILED = "Failed"
#: partial batch: bytes and partitions of one write at most (a single larger partition has one of its own)
PACK_BYTES, PACK_PARTITIONS = 256 << 20, 400


def _ranges_of(binding: TableBinding, table: str, names: list[str]) -> list[Partition]:
    """The named partitions as the target knows them; all of them must exist."""
    held = {p.partition_name: p for p in binding.target(table).partitions() if p.table_name == table}
    if unknown := sorted(set(names) - set(held)):
        raise ValueError(f"partitions not in the manifest of {table!r}: {unknown}")
    return [held[n] for n in dict.fromkeys(names)]


def _date_col(binding: TableBinding, table: str, ranges: list) -> str:
    """The column the ranges are dated by: the binding's, else the one recorded when they were created."""
    recorded = {r.date_col for r in ranges if r.date_col}
    if binding.date_col or len(recorded) == 1:
        return binding.date_col or recorded.pop()
    raise ValueError(f"the date column of {table!r} is neither given nor recorded with its partitions")


def refresh_transactional(binding: TableBinding, table: str, names: list[str],
                          rebalance: bool = True, ranges: list | None = None) -> dict[str, int]:
    """Recompute the selected partitions of one table, all or nothing; returns the rows of each.

    ``ranges`` (the partitions ``names`` as the target knows them) may be passed when already known.
    """
    if ranges is None:
        ranges = _ranges_of(binding, table, names)
    dated = [p for p in ranges if p.range_start is not None]
    date_col = _date_col(binding, table, dated) if dated else binding.date_col
    return binding.target(table).replace(binding.source, date_col, ranges, rebalance)[0]


def packed(partitions: list[Partition], most_bytes: int = PACK_BYTES, most: int = PACK_PARTITIONS) -> Iterator[list[Partition]]:
    """Partitions in packs of at most ``most_bytes`` and ``most``, neighbours in time together; one pass.

    A partition of unknown size, or the catch-all, is a pack of its own.
    """
    pack, held = [], 0
    for p in sorted(partitions, key=lambda p: (p.range_start is None, p.range_start, p.partition_name)):
        alone = p.n_bytes is None or p.range_start is None
        if pack and (alone or held + p.n_bytes > most_bytes or len(pack) >= most):
            yield pack
            pack, held = [], 0
        pack.append(p)
        held += most_bytes if alone else p.n_bytes
    if pack:
        yield pack


def work_list(refresh_set: list[tuple[str, str]], known_ranges: Mapping[str, list], most_bytes: int = PACK_BYTES) -> list[tuple[str, list]]:
    """(table, pack of partitions) for a refresh set; time in proportion to both."""
    wanted = set(refresh_set)
    return [(t, pack) for t, rows in known_ranges.items() for pack in packed([r for r in rows if (t, r.partition_name) in wanted], most_bytes)]


def refresh_partial_batch(bindings: Mapping[str, TableBinding], refresh_set: list[tuple[str, str]],
                          max_parallelism: int = 4, rebalance: bool = True,
                          known_ranges: Mapping[str, list] | None = None, rows: dict | None = None,
                          pack_bytes: int = PACK_BYTES) -> dict:
    """Recompute partitions that succeed or fail one by one, ``max_parallelism`` writes at a time.

    ``known_ranges`` maps a table to its selected partitions as the target knows them.  Returns {(table, partition):
    error text} for the failed ones; ``rows`` receives {(table, partition): rows} for the others.
    """
    if max_parallelism < 1:
        raise ValueError("max_parallelism must be >= 1")
    known = dict(known_ranges or {})
    by_table: dict[str, list[str]] = {}
    for table, name in refresh_set:
        by_table.setdefault(table, []).append(name)
    for table, names in by_table.items():
        if table not in known:
            known[table] = _ranges_of(bindings[table], table, names)

    def write(table: str, pack: list[Partition]) -> tuple[dict, dict]:
        binding = bindings[table]
        dated = [p for p in pack if p.range_start is not None]
        date_col = _date_col(binding, table, dated) if dated else binding.date_col
        return binding.target(table).replace(binding.source, date_col, pack, rebalance, each=True)

    failures, found = {}, {} if rows is None else rows
    with ThreadPoolExecutor(max_workers=max_parallelism) as pool:
        todo = work_list(refresh_set, known, pack_bytes)
        while todo:
            futures = [(table, pack, pool.submit(write, table, pack)) for table, pack in todo]
            todo = []
            for table, pack, fut in futures:
                exc = fut.exception()
                if exc is not None and len(pack) > 1:
                    todo += [(table, [p]) for p in pack]  # each on its own
                    continue
                if exc is None:
                    done, errors = fut.result()
                else:
                    done, errors = {}, {pack[0].partition_name: f"{type(exc).__name__}: {exc}"}
                found.update({(table, n): k for n, k in done.items()})
                for n, text in errors.items():
                    log.error("refresh of %s failed: %s", (table, n), text)
                    failures[(table, n)] = text
    return failures


def refresh_report(spark: SparkSession, bindings: Mapping[str, TableBinding], refresh_set: list[tuple[str, str]],
                   failures: Mapping | None = None, rows: Mapping | None = None) -> DataFrame:
    """(table_name, partition_name, status, rows, error) per refreshed partition.

    ``rows`` has the rows that the refresh wrote.  For partitions that it lacks (failed ones keep their old rows)
    the target's own statistics are used; only a catalog table, which has none, is read for them.
    """
    failures, rows = failures or {}, dict(rows or {})
    missing: dict[str, set] = {}
    for t, n in refresh_set:
        if (t, n) not in rows:
            missing.setdefault(t, set()).add(n)
    for table, names in missing.items():
        target = bindings[table].target(table)
        held = [p for p in target.partitions() if p.partition_name in names]
        rows.update({(table, p.partition_name): p.n_rows for p in held if p.n_rows is not None})
        unknown = [p for p in held if p.n_rows is None]
        if unknown:
            counts = target.read(unknown, bindings[table].source.schema).groupBy("partition_name").count().collect()
            rows.update({(table, r["partition_name"]): r["count"] for r in counts})
    return local_frame(spark, [(t, n, COMPLETED if failures.get((t, n)) is None else FAILED, rows.get((t, n), 0),
                                failures.get((t, n))) for t, n in sorted(set(refresh_set))], REPORT_SCHEMA)


def check_report(report: DataFrame) -> None:
    """Raise ``RefreshFailed`` with every partition that did not complete."""
    bad = [r.asDict() for r in report.collect() if r.status != COMPLETED]
    if bad:
        raise RefreshFailed(bad)


class RefreshFailed(RuntimeError):
    """Some partitions were not refreshed: ``failures`` has a row for each."""

    def __init__(self, failures: list[dict]):
        super().__init__(f"refresh failed: {len(failures)}: {failures}")
        self.failures = failures


def available_partitions(spark: SparkSession, bindings: Mapping[str, TableBinding]) -> list[Partition]:
    """Partition catalog of all bound tables, as their targets know them; no Spark job for folders."""
    return [p for t, b in bindings.items() for p in b.target(t).partitions() if p.table_name == t]


def check_request(spark: SparkSession, bindings: Mapping[str, TableBinding], tables_to_refresh=None, partitions_to_refresh=None,
                  commit_mode: str = "transactional", max_parallelism: int = 4, edges=None, direction: str = "both",
                  mode: str = "documented") -> tuple[list[str], list[tuple] | None]:
    """(tables in scope, selected partitions) of a refresh, after every check that needs no partition catalog."""
    if commit_mode not in COMMIT_MODES:
        raise ValueError(f"commit_mode must be one of {COMMIT_MODES}")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if isinstance(max_parallelism, bool) or not isinstance(max_parallelism, int) or max_parallelism < 1:
        raise ValueError("max_parallelism must be an integer >= 1")
    names = ([r[0] for r in table_list(spark, tables_to_refresh).distinct().collect()]
             if isinstance(tables_to_refresh, DataFrame) else list_names(tables_to_refresh))
    scope = list(bindings)
    if direction not in ("both", "out"):
        raise ValueError("direction must be 'both' or 'out'")
    if names is not None:
        if unknown := sorted(set(names) - set(bindings)):
            raise InvalidInput("invalid table names", [{"table_name": t} for t in unknown])
        if isinstance(edges, DataFrame):
            available = local_frame(spark, [(t,) for t in bindings], TABLES_SCHEMA)
            scope = [r.table_name for r in refresh_scope(table_list(spark, names), available, edges, direction).collect()]
        else:
            scope = [t for t in related_names(edges or [], names, direction) if t in bindings]
    selection = read_selection(spark, partitions_to_refresh)
    return scope, None if selection is None else named_partitions(selection)


def refresh(spark: SparkSession, bindings: Mapping[str, TableBinding], tables_to_refresh=None,
            partitions_to_refresh=None, commit_mode: str = "transactional",
            max_parallelism: int = 4, edges=None,
            direction: str = "both", mode: str = "documented", raise_on_failure: bool = True,
            rebalance: bool = True) -> DataFrame:
    """Entry point "refresh": scope -> refresh set (W12) -> W14 or W15 -> report.

    ``edges`` relates tables: a DataFrame (src, dst) or pairs.  Everything is checked before anything is written.
    """
    scope, selection = check_request(spark, bindings, tables_to_refresh, partitions_to_refresh, commit_mode,
                                     max_parallelism, edges, direction, mode)
    catalog = {(r.table_name, r.partition_name): r for r in available_partitions(spark, bindings)}
    available = sorted(k for k in catalog if k[0] in set(scope))
    refresh_set = available if selection is None else choose_partitions(available, selection, mode)
    known: dict[str, list] = {}
    for key in refresh_set:
        known.setdefault(key[0], []).append(catalog[key])
    for table, ranges in known.items():
        if any(r.range_start is not None for r in ranges):
            _date_col(bindings[table], table, [r for r in ranges if r.range_start is not None])
    failures: dict = {}
    rows: dict = {}
    if commit_mode == "transactional":
        # One write per table, up to max_parallelism tables at once; each table
        # publishes all of its selected partitions or none.
        with ThreadPoolExecutor(max_workers=max_parallelism) as pool:
            futures = {table: pool.submit(refresh_transactional, bindings[table], table,
                                          [r.partition_name for r in ranges], rebalance, ranges)
                       for table, ranges in known.items()}
            for table, fut in futures.items():
                exc = fut.exception()
                if exc is None:
                    rows.update({(table, n): k for n, k in fut.result().items()})
                    continue
                log.error("refresh of %s failed: %s", table, exc)
                for r in known[table]:
                    failures[(table, r.partition_name)] = f"{type(exc).__name__}: {exc}"
    else:
        failures = refresh_partial_batch(bindings, refresh_set, max_parallelism, rebalance, known, rows)
    report = refresh_report(spark, bindings, refresh_set, failures, rows)
    if raise_on_failure:
        check_report(report)  # a local frame: no job on the target
    return report
