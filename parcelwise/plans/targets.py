"""Where a table's partitions live: a folder with snapshot commits, or a table of the session catalog.

Both targets know their partitions, write the rows of ranges or of the whole source, and commit.  A write counts the
rows of every partition in its own pass (``Counted``), so nothing is read back.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import as_date, day_of
from ..operators.assign import RangeIndex, assign_by_ranges
from ..sources import catalog
from ..sources.storage import (
    PARTITION_COLUMN,
    CommitConflict,
    Partition,
    Snapshot,
    Staged,
    check_overlaps,
    commit,
    delete_folder,
    escape_partition_value,
    read_partitions,
    read_snapshot,
    scanned_stats,
    write_dir,
    write_partitions,
    written_sizes,
)

log = logging.getLogger("parcelwise.targets")

#: intervals of a pushed predicate; with more ranges the nearest ones are read as one
MOST_SPANS = 32
EPOCH = dt.date(1970, 1, 1)


def merged_intervals(ranges: list, most: int | None = None) -> list[tuple]:
    """Inclusive (start, end) day intervals covering ``ranges``, adjacent ones merged; of more than ``most`` those with the smallest gaps too."""
    merged: list[list] = []
    for start, end in sorted((r.range_start, r.range_end) for r in ranges):
        if merged and start <= merged[-1][1] + dt.timedelta(days=1):
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    if most and len(merged) > most:
        gaps = sorted(range(1, len(merged)), key=lambda i: merged[i - 1][1] - merged[i][0])[:most - 1]  # the widest
        cuts = [0, *sorted(gaps), len(merged)]
        merged = [[merged[a][0], merged[b - 1][1]] for a, b in zip(cuts, cuts[1:], strict=False)]
    return [tuple(m) for m in merged]


def span_filter(df: DataFrame, date_col: str, ranges: list) -> DataFrame:
    """Literal date predicate that lets Parquet skip what lies outside ``ranges``.

    Contiguous ranges are one interval; scattered ones an OR of at most ``MOST_SPANS`` intervals, as a balanced
    tree, so refreshing the first and the last period does not read everything in between.  With more ranges than that
    it is wider than they are: which rows count is for the range index to say.
    """
    if not ranges or any(r.range_start is None or r.range_end is None for r in ranges):
        return df
    c = F.col(date_col)
    terms = [(c >= as_date(start)) & (c < F.date_add(as_date(end), 1)) for start, end in merged_intervals(ranges, MOST_SPANS)]
    while len(terms) > 1:
        terms = [terms[i] | terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return df.where(terms[0])


def ranged_rows(source: DataFrame, date_col: str, ranges: list) -> DataFrame:
    """The source's rows in ``ranges`` with their partition's name, read between the ranges' literal bounds."""
    return assign_by_ranges(span_filter(source, date_col, ranges), date_col, ranges, keep_unmatched=False)


class Counted:
    """Rows, first and last day of every written partition, counted by the tasks that write.

    One aggregate counts the rows of each day, exactly: it tracks more values than there are days in the ranges.  The counts of days
    give those of disjoint ranges.  Where they cannot (overlapping ranges, ranges of very many days, or Spark delivered no
    metric), ``stats`` is None and the caller reads what was written.
    """

    def __init__(self, date_col: str | None, ranges: list | None = None, table: str | None = None):
        self.date_col, self.table = date_col, table
        self.index = RangeIndex.of([tuple(r)[:4] for r in ranges]) if ranges else None
        days = len([n for n in self.index.numbers if n >= 0]) if self.index else 0
        self.tracked = 1 << max(5, (2 * days).bit_length()) if 0 < days <= 250_000 else 0
        self.seen = Observation()

    def observe(self, rows: DataFrame) -> DataFrame:
        count = F.count(F.lit(1)).alias("n")
        if self.table is not None:
            day = day_of(self.date_col) if self.date_col else F.lit(None).cast("date")
            return rows.observe(self.seen, count, F.min(day).alias("first"), F.max(day).alias("last"))
        if not self.tracked:
            return rows
        number = F.date_diff(day_of(self.date_col), as_date(EPOCH))
        return rows.observe(self.seen, count, F.call_function("approx_top_k", number, F.lit(self.tracked // 2), F.lit(self.tracked)).alias("days"))

    def stats(self) -> dict | None:
        if self.table is None and not self.tracked:
            return None
        try:
            got = self.seen.get
        except Py4JJavaError:  # no task ran the observed plan
            return None
        if self.table is not None:
            return {self.table: (got["n"], got["first"], got["last"])} if "n" in got else None
        out: dict = {}
        if "days" not in got or sum(d["count"] for d in got["days"]) != got["n"]:
            return None
        for d in got["days"]:
            day = EPOCH + dt.timedelta(days=d["item"])
            name = self.index.names[self.index.numbers[(day - self.index.first).days]]
            n, lo, hi = out.get(name, (0, day, day))
            out[name] = (n + d["count"], min(lo, day), max(hi, day))
        return out


@dataclass(frozen=True)
class FolderTarget:
    """A table in a folder of its own; see ``sources.storage`` for its layout and commits."""

    spark: SparkSession
    root: str

    def partitions(self) -> list[Partition]:
        return list(read_snapshot(self.spark, self.root).partitions.values())

    def read(self, partitions, schema) -> DataFrame:
        return read_partitions(self.spark, self.root, partitions, schema)

    def stage(self, source: DataFrame, date_col: str | None, ranges: list, whole: str | None = None, rebalance: bool = True) -> Staged:
        """Write the source's rows in ``ranges``, or all of them as the partition ``whole``, for a later commit."""
        if whole is not None:
            rows, counted = source.withColumn(PARTITION_COLUMN, F.lit(whole)), Counted(date_col, table=whole)
        else:
            rows, counted = ranged_rows(source, date_col, ranges), Counted(date_col, ranges)
        write_id = write_partitions(rows, self.root, rebalance, one_name=whole is not None or len(ranges) == 1, observe=counted.observe)
        stats, by_folder = counted.stats(), written_sizes(self.spark, self.root, write_id)
        if stats is None or any(escape_partition_value(n) not in by_folder for n, (k, *_) in stats.items() if k):
            stats = scanned_stats(self.spark, self.root, write_id, source.schema, date_col)
        return Staged(write_id, stats, {n: by_folder.get(escape_partition_value(n), 0) for n in stats})

    def discard(self, staged: Staged) -> None:
        """Remove a staged write that no version names."""
        delete_folder(self.spark, write_dir(self.root, staged.write_id))

    def add(self, source: DataFrame, date_col: str, ranges: list, retire: str | None = None, rebalance: bool = True) -> list[str]:
        """Write new partitions and, in the same commit, drop the catch-all ``retire``; returns the names created.

        A name that another writer has created meanwhile stays as that writer left it, if it has the same range.
        """
        staged = self.stage(source, date_col, ranges, rebalance=rebalance) if ranges else None
        created: list[str] = []

        def change(now: Snapshot):
            mine = [staged.partition(Partition(*tuple(r)[:4], date_col)) for r in ranges]
            mine = [p for p in mine if p.partition_name not in now.partitions or now.partitions[p.partition_name][2:4] != p[2:4]]
            if clash := [p.partition_name for p in mine if p.partition_name in now.partitions]:
                raise CommitConflict("these partitions exist with other ranges", clash)
            check_overlaps(now.partitions.values(), mine)
            created[:] = [p.partition_name for p in mine]
            if not mine and retire not in now.partitions:
                return None
            return {n: p for n, p in now.partitions.items() if n != retire} | {p.partition_name: p for p in mine}

        self._publish(change, source, staged)
        if staged is not None and not created:
            self.discard(staged)
        return created

    def replace(self, source: DataFrame, date_col: str | None, old: list[Partition], rebalance: bool = True,
                each: bool = False) -> tuple[dict, dict]:
        """Recompute existing partitions: (rows of each, error of each that failed).

        One commit for all.  A partition that another writer changed or dropped meanwhile is a conflict: with ``each`` it
        fails alone, else nothing is published.
        """
        dated, whole = [p for p in old if p.range_start is not None], [p for p in old if p.range_start is None]
        parts = [(self.stage(source, date_col, dated, rebalance=rebalance), dated)] if dated else []
        try:
            parts += [(self.stage(source, date_col, [], p.partition_name, rebalance), [p]) for p in whole]
        except Exception:
            for staged, _ in parts:
                self.discard(staged)
            raise
        rows: dict = {}
        errors: dict = {}

        def change(now: Snapshot):
            lost = [p.partition_name for p in old if now.partitions.get(p.partition_name, Partition("", "", write_id="gone")).write_id != p.write_id]
            if lost and not each:
                raise CommitConflict("another writer changed these partitions meanwhile", lost)
            errors.update({n: "CommitConflict: another writer changed it meanwhile" for n in lost})
            new = {p.partition_name: staged.partition(now.partitions[p.partition_name]._replace(date_col=date_col or p.date_col))
                   for staged, mine in parts for p in mine if p.partition_name not in errors}
            rows.clear()
            rows.update({n: p.n_rows for n, p in new.items()})
            return {**now.partitions, **new} if new else None

        self._publish(change, source, *[s for s, _ in parts])
        return rows, errors

    def drop(self, names: list[str]) -> bool:
        """Remove partitions; whether one of them existed."""
        found = [False]

        def change(now: Snapshot):
            found[0] = any(n in now.partitions for n in names)
            return {n: p for n, p in now.partitions.items() if n not in names} if found[0] else None
        commit(self.spark, self.root, change)
        return found[0]

    def put_whole(self, source: DataFrame, table: str, date_col: str | None = None) -> None:
        """Store the whole source as the catch-all partition."""
        staged = self.stage(source, date_col, [], table)
        self._publish(lambda now: {**now.partitions, table: staged.partition(Partition(table, table))}, source, staged)

    def _publish(self, change, source: DataFrame, *staged) -> None:
        schema = T.StructType([f for f in source.schema.fields if f.name != PARTITION_COLUMN])
        try:
            commit(self.spark, self.root, change, schema.json())
        except (CommitConflict, ValueError):  # refused; after any other failure the version may be out
            for s in staged:
                if s is not None:
                    self.discard(s)
            raise


@dataclass(frozen=True)
class CatalogTarget:
    """A table of the session catalog, partitioned by the partition's name; its writers take turns.

    Publishing is Spark's dynamic overwrite: a failed job leaves the table as it was, but several partitions are published one after
    the other, and a partition without rows is cleared by a step of its own.  A run that breaks off there is finished by the next.
    """

    spark: SparkSession
    name: str
    table: str

    def partitions(self) -> list[Partition]:
        return [catalog.range_of(self.table, n) for n in catalog.partition_names(self.spark, self.name)]

    def read(self, partitions, schema) -> DataFrame:
        names = [p.partition_name for p in partitions]
        column = catalog.partition_column(self.spark, self.name)
        return self.spark.table(self.name).where(F.col(column).isin(names)).withColumnRenamed(column, PARTITION_COLUMN)

    def _overwrite(self, source: DataFrame, date_col: str | None, ranges: list, whole: str | None = None, rebalance: bool = True) -> dict:
        """Overwrite the partitions of ``ranges``, or ``whole`` with all rows; the rows of each name."""
        names = [whole] if whole is not None else [r.partition_name for r in ranges]
        with catalog.writing(source) as own:
            if whole is not None:
                rows, counted = own.withColumn(PARTITION_COLUMN, F.lit(whole)), Counted(date_col, table=whole)
            else:
                rows, counted = ranged_rows(own, date_col, ranges), Counted(date_col, ranges)
            if rebalance:
                rows = rows.hint("rebalance") if len(names) == 1 else rows.hint("rebalance", PARTITION_COLUMN)
            try:
                catalog.overwrite(counted.observe(rows), self.name)
            finally:
                self.spark.catalog.refreshTable(self.name)  # the caller's session may hold the old list of files
            stats = counted.stats()
        if stats is None:
            found = self.read([Partition("", n) for n in names], None).groupBy(PARTITION_COLUMN).count().collect()
            stats = {r[0]: (r[1], None, None) for r in found}
        return {n: stats.get(n, (0, None, None))[0] for n in names}

    def add(self, source: DataFrame, date_col: str, ranges: list, retire: str | None = None, rebalance: bool = True) -> list[str]:
        with catalog.table_lock(self.name):
            held = self.partitions()
            old = {p.partition_name for p in held}
            todo = [r for r in ranges if r.partition_name not in old]
            if todo:
                check_overlaps(held, [Partition(*tuple(r)[:4]) for r in todo])
                rows = self._overwrite(source, date_col, todo, rebalance=rebalance)
                empty = [n for n, k in rows.items() if not k]
                catalog.add_partitions(self.spark, self.name, empty)
                self._clear(empty)  # an external folder may hold rows of a run that broke off
            if retire in old:
                catalog.drop_partitions(self.spark, self.name, [retire])
            return [r.partition_name for r in todo]

    def replace(self, source: DataFrame, date_col: str | None, old: list[Partition], rebalance: bool = True, each: bool = False) -> tuple[dict, dict]:
        dated, whole = [p for p in old if p.range_start is not None], [p for p in old if p.range_start is None]
        rows: dict = {}
        with catalog.table_lock(self.name):
            if dated:
                rows |= self._overwrite(source, date_col, dated, rebalance=rebalance)
            for p in whole:
                rows |= self._overwrite(source, date_col, [], p.partition_name, rebalance)
            self._clear([n for n, k in rows.items() if not k])
        return rows, {}

    def _clear(self, names: list[str]) -> None:
        for n in names:
            catalog.clear_partition(self.spark, self.name, n)

    def drop(self, names: list[str]) -> bool:
        with catalog.table_lock(self.name):
            held = {p.partition_name for p in self.partitions()} & set(names)
            catalog.drop_partitions(self.spark, self.name, sorted(held))
        return bool(held)

    def put_whole(self, source: DataFrame, table: str, date_col: str | None = None) -> None:
        with catalog.table_lock(self.name):
            self._overwrite(source, date_col, [], table)
            catalog.add_partitions(self.spark, self.name, [table])
