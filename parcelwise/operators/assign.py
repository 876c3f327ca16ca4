"""Row-level operators over a fact table: tag, slice, profile, find uncovered rows.

These are the operators that touch the user's data, so each one is shaped
for scale:

* W3 (``assign_partition``) and W5 (``slice_partition``) are narrow: no
  join, no shuffle, and W5's half-open date predicate reaches the Parquet
  scan as ``PushedFilters``.
* W4 (``assign_by_ranges``) and W8 (``uncovered_rows``) look a row's day up in
  a literal array that has the number of each day's range: no join, no shuffle
  (``RangeIndex``).  Ranges that overlap, that span more than ``MOST_DAYS`` days or that are more than ``MOST_RANGES``
  are joined instead.  A plain range condition would plan as a nested-loop join (rows x ranges);
  there each range is exploded to the month buckets it covers and the
  join is an equi-join on the month bucket plus a residual range test, broadcast by
  Spark's own size limit or shuffled, where AQE splits a hot month.
* W6 (``partition_profile``) is a grouped count/min/max: partial aggregation
  map-side, so a partition holding a third of all rows costs one row per
  task in the shuffle.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import (
    INTERVAL_MONTHS,
    as_date,
    day_of,
    in_day_range,
    month_index,
    partition_name,
    period_end,
    period_start,
    python_date,
)
from ..session import local_frame
from ..sources.control import RANGES_SCHEMA

PARTITION_COLUMN = "partition_name"
#: beyond these the ranges are joined: days between the first and the last, and ranges
MOST_DAYS, MOST_RANGES = 400_000, 100_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def assign_partition(df: DataFrame, table: str, date_col, interval: str, first_date, as_of,
                     column: str = PARTITION_COLUMN) -> DataFrame:
    """Add ``partition_name`` = the calendar period of each row, by arithmetic.

    Rows dated before ``first_date``, after the end of ``as_of``'s period, or
    with a NULL date get NULL (they are in no partition; see
    :func:`uncovered_rows`).  The first period is clipped to ``first_date``,
    exactly as :func:`period_ranges` names it.  A time of day on the last
    day of a period is kept in that period.
    """
    d = day_of(date_col)
    fd = as_date(first_date)
    last_day = period_end(period_start(as_date(as_of), interval), interval)
    if isinstance(first_date, Column) or isinstance(as_of, Column):
        p = period_start(d, interval)
        name = partition_name(table, F.greatest(p, fd), period_end(p, interval))
    else:  # the names of all periods are known: pick one by the number of its period
        periods = calendar_periods(table, interval, first_date, as_of)
        name = F.get(F.lit([n for n, _, _ in periods]), _period_number(d, interval, periods)) if periods else F.lit(None).cast("string")
    return df.withColumn(column, F.when((d >= fd) & (d <= last_day), name))


def calendar_periods(table: str, interval: str, first_date, as_of) -> list[tuple]:
    """(name, first day, last day) of the periods that :func:`period_ranges` gives, from dates the driver knows."""
    k = INTERVAL_MONTHS[interval.strip().upper()]
    first, last = python_date(first_date), python_date(as_of)
    month = (first.year * 12 + first.month - 1) // k * k
    out = []
    while month <= (last.year * 12 + last.month - 1) // k * k:
        start = max(first, dt.date(month // 12, month % 12 + 1, 1))
        end = dt.date((month + k) // 12, (month + k) % 12 + 1, 1) - dt.timedelta(days=1)
        out.append((f"{table}_{start:%Y%m%d}_{end:%Y%m%d}", start, end))
        month += k
    return out


def _period_number(d, interval: str, periods: list[tuple]) -> Column:
    """Number, from 0, of the period that holds day ``d``."""
    k = INTERVAL_MONTHS[interval.strip().upper()]
    first = (periods[0][1].year * 12 + periods[0][1].month - 1) // k
    return F.floor(month_index(d) / k).cast("int") - F.lit(first)


def calendar_profile(df: DataFrame, table: str, date_col: str, interval: str, first_date, as_of,
                     manifest: DataFrame | None = None) -> DataFrame:
    """W3 and W6 in one: ``partition_profile`` of ``assign_partition``, without a name per row.

    Rows are filtered on the raw column (so Parquet skips row groups), grouped by the number of their period, and
    the few groups get their names.  Dates must be known to the driver.
    """
    periods = calendar_periods(table, interval, first_date, as_of)
    names = F.lit([n for n, _, _ in periods]) if periods else F.array().cast("array<string>")
    start, end = (periods[0][1], periods[-1][2]) if periods else (dt.date(1900, 1, 2), dt.date(1900, 1, 1))
    d = day_of(date_col)
    number = _period_number(d, interval, periods) if periods else F.lit(0)
    prof = (df.where(in_day_range(_c(date_col), start, end)).groupBy(number.alias("_number"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(d).alias("min_date"), F.max(d).alias("max_date"))
            .select(F.lit(table).alias("table_name"), F.get(names, F.col("_number")).alias(PARTITION_COLUMN),
                    "n_rows", "min_date", "max_date"))
    return prof if manifest is None else _listed(prof, manifest, table)


def _month_buckets(ranges: DataFrame) -> DataFrame:
    """One row per (range, month it touches), keyed by ``_m``."""
    return (ranges
            .where(F.col("range_start").isNotNull() & F.col("range_end").isNotNull()
                   & (F.col("range_start") <= F.col("range_end")))
            .select(F.col("partition_name").alias("_pn"),
                    F.col("range_start").alias("_rs"),
                    F.col("range_end").alias("_re"),
                    F.explode(F.sequence(month_index("range_start"),
                                         month_index("range_end"))).alias("_m")))


def _bucket_join(df: DataFrame, date_col, ranges, how: str, table: str | None) -> DataFrame:
    """Interval join by month buckets; Spark chooses the strategy by the size of the ranges."""
    if not isinstance(ranges, DataFrame):
        ranges = local_frame(df.sparkSession, [tuple(r)[:4] for r in ranges], RANGES_SCHEMA)
    if table is not None:
        ranges = ranges.where(F.col("table_name") == table)
    buckets = _month_buckets(ranges)
    d = day_of(date_col)
    keyed = df.withColumn("_d", d).withColumn("_dm", month_index(F.col("_d")))
    cond = ((keyed["_dm"] == buckets["_m"])
            & (keyed["_d"] >= buckets["_rs"]) & (keyed["_d"] <= buckets["_re"]))
    return keyed.join(buckets, cond, how)


@dataclass
class RangeIndex:
    """Disjoint inclusive day ranges by day: the number of each day's range, from the first day on (-1: none)."""

    names: list
    first: dt.date
    numbers: list

    @classmethod
    def of(cls, ranges: list) -> RangeIndex | None:
        """None where the ranges overlap or span too many days.  Rows without both bounds, or reversed, hold no day."""
        rows = sorted((r[2], r[3], r[1]) for r in ranges if r[2] is not None and r[3] is not None and r[2] <= r[3])
        if any(nxt[0] <= prev[1] for prev, nxt in zip(rows, rows[1:], strict=False)):
            return None
        if rows and (rows[-1][1] - rows[0][0]).days >= MOST_DAYS:
            return None
        numbers: list[int] = []
        for i, (start, end, _) in enumerate(rows):
            numbers += [-1] * ((start - rows[0][0]).days - len(numbers)) + [i] * ((end - start).days + 1)
        return cls([n for _, _, n in rows], rows[0][0] if rows else dt.date(1970, 1, 1), numbers)

    def number(self, date_col) -> Column:
        """Number of the range that holds the day; null where none does."""
        if not self.names:
            return F.lit(None).cast("int")
        # one text literal, which Spark folds to an array once; a literal per day would make the plan long
        numbers = F.split(F.lit(",".join(map(str, self.numbers))), ",").cast("array<int>")
        at = F.date_diff(day_of(date_col), as_date(self.first))
        return F.when((at >= 0) & (at < len(self.numbers)), F.nullif(F.get(numbers, at), F.lit(-1)))

    def name(self, date_col) -> Column:
        """Name of the range that holds the day; null where none does."""
        if not self.names:
            return F.lit(None).cast("string")
        mark = next(c for c in map(chr, range(1, 9)) if not any(c in n for n in self.names))
        return F.get(F.split(F.lit(mark.join(self.names)), mark), self.number(date_col))


def _index_of(ranges, table: str | None) -> RangeIndex | None:
    """An index of the ranges (a frame of few rows, or rows the driver holds), if they allow one."""
    if isinstance(ranges, DataFrame):
        if table is not None:
            ranges = ranges.where(F.col("table_name") == table)
        ranges = ranges.select(*RANGES_SCHEMA.names).limit(MOST_RANGES + 1).collect()
    elif table is not None:
        ranges = [r for r in ranges if r[0] == table]
    return RangeIndex.of(ranges) if len(ranges) <= MOST_RANGES else None


def assign_by_ranges(df: DataFrame, date_col, ranges: DataFrame, table: str | None = None,
                     column: str = PARTITION_COLUMN, keep_unmatched: bool = True) -> DataFrame:
    """Add ``partition_name`` from arbitrary inclusive ``ranges``.

    ``ranges`` has (table_name, partition_name, range_start, range_end), as
    a DataFrame (metadata: a row per partition) or as driver-side rows; pass ``table`` to use only that table's
    ranges.  Unmatched rows keep a NULL name (or are dropped with ``keep_unmatched=False``).  A row inside
    two overlapping ranges appears once per range.  Ranges that do not overlap need no join.
    """
    index = _index_of(ranges, table)
    if index is not None:
        tagged = df.withColumn(column, index.name(date_col))
        return tagged if keep_unmatched else tagged.where(F.col(column).isNotNull())
    joined = _bucket_join(df, date_col, ranges, "left" if keep_unmatched else "inner", table)
    return joined.withColumn(column, F.col("_pn")).drop("_d", "_dm", "_pn", "_rs", "_re", "_m")


def slice_partition(df: DataFrame, date_col, start, end) -> DataFrame:
    """Rows of one partition, ``start <= day(date_col) <= end``.

    Written half-open on the raw column (``c >= start AND c < end + 1``), so
    time-of-day values on ``end`` are kept and Parquet skips row groups.
    """
    return df.where(in_day_range(_c(date_col), start, end))


def partition_profile(df_tagged: DataFrame, date_col, table: str | None = None,
                      manifest: DataFrame | None = None,
                      column: str = PARTITION_COLUMN) -> DataFrame:
    """(table_name, partition_name, n_rows, min_date, max_date) from the rows.

    ``table`` gives the table name as a literal; without it the frame must
    carry a ``table_name`` column.  Rows in no partition are left out.
    With a ``manifest`` (a ranges / partitions frame) every listed
    partition appears, with ``n_rows = 0`` when it holds no rows.
    """
    d = day_of(date_col)
    keys = [column] if table is not None else ["table_name", column]
    prof = (df_tagged.where(F.col(column).isNotNull())
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.min(d).alias("min_date"),
                 F.max(d).alias("max_date")))
    tname = F.lit(table) if table is not None else F.col("table_name")
    prof = prof.select(tname.alias("table_name"), F.col(column).alias("partition_name"),
                       "n_rows", "min_date", "max_date")
    return prof if manifest is None else _listed(prof, manifest, table)


def _listed(prof: DataFrame, manifest: DataFrame, table: str | None) -> DataFrame:
    """The profile with a row for every partition of the manifest."""
    listed = manifest.select("table_name", "partition_name").distinct()
    if table is not None:
        listed = listed.where(F.col("table_name") == table)
    return (listed.join(prof, ["table_name", "partition_name"], "left")
            .select("table_name", "partition_name",
                    F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                    "min_date", "max_date"))


def uncovered_rows(df: DataFrame, date_col, ranges: DataFrame, table: str | None = None) -> DataFrame:
    """Rows that fall in no range (NULL dates included).

    These are the rows that would be lost from view when the catch-all
    partition is retired.
    """
    index = _index_of(ranges, table)
    if index is not None:
        return df.where(index.number(date_col).isNull())
    return (_bucket_join(df, date_col, ranges, "left_anti", table)
            .drop("_d", "_dm"))
