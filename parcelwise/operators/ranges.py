"""Calendar ranges from a spec (W2), refresh windows (W9), selection lists.

One ``explode(sequence(...))`` over the whole spec frame replaces a loop
over tables: every spec row becomes its periods in a single narrow plan.
``as_of`` is an argument (a date, text, or a Column per spec row), never
the clock, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import (
    ALL_TOKEN,
    TODAY_TOKEN,
    as_date,
    interval_months,
    month_index,
    parse_date_text,
    partition_name,
    period_start,
)

RANGE_COLUMNS = ["table_name", "partition_name", "range_start", "range_end"]


def _as_of_column(as_of) -> Column:
    if as_of is None:
        return F.col("as_of").cast("date")
    return as_date(as_of)


def _explode_periods(base: DataFrame) -> DataFrame:
    """``base`` has table_name, _fd, _k, _first, _last (period starts) -> ranges."""
    step = F.make_ym_interval(F.lit(0), F.col("_k"))
    periods = (base
               .where(F.col("_fd").isNotNull() & F.col("_k").isNotNull()
                      & F.col("_first").isNotNull() & F.col("_last").isNotNull()
                      # sequence() rejects a reversed range; such rows have no periods.
                      & (F.col("_first") <= F.col("_last")))
               .select("table_name", "_fd", "_k",
                       F.explode(F.sequence("_first", "_last", step)).alias("_p")))
    start = F.greatest(F.col("_p"), F.col("_fd"))
    end = F.date_sub(F.add_months(F.col("_p"), F.col("_k")), 1)
    return periods.select(
        "table_name",
        partition_name(F.col("table_name"), start, end).alias("partition_name"),
        start.alias("range_start"),
        end.alias("range_end"),
    )


def period_ranges(spec: DataFrame, as_of=None) -> DataFrame:
    """Every calendar period from ``first_date`` to the end of ``as_of``'s period.

    The first range is clipped to start on ``first_date`` when that is not a
    period boundary; each range ends on its period's last day (both bounds
    inclusive).  Rows with an invalid date or interval give no ranges (see
    :func:`invalid_specs`).  A spec whose ``first_date`` lies after the last
    period gives none either.  Output: table_name, partition_name,
    range_start, range_end.
    """
    fd = parse_date_text(F.col("first_date"))
    iv = F.col("interval")
    base = spec.select(
        F.col("table").alias("table_name"),
        fd.alias("_fd"),
        interval_months(iv).alias("_k"),
        period_start(fd, iv).alias("_first"),
        period_start(_as_of_column(as_of), iv).alias("_last"),
    )
    return _explode_periods(base)


def refresh_ranges(spec: DataFrame, as_of=None) -> DataFrame:
    """The periods to refresh for each spec row.

    ``refresh_from`` is ``yyyyMMdd`` or ``TODAY`` (= ``as_of``).  The period
    holding it is the last one; ``number_of_intervals`` counts back from it
    (``1`` = that period only, ``*`` = back to ``first_date``), never before
    ``first_date``.  Rows with an unusable refresh_from or count are left
    out (see ``invalid_specs(..., for_refresh=True)``).
    """
    fd = parse_date_text(F.col("first_date"))
    iv = F.col("interval")
    k = interval_months(iv)
    rf_text = F.trim(F.col("refresh_from"))
    rf = (F.when(F.upper(rf_text) == TODAY_TOKEN, _as_of_column(as_of))
          .otherwise(parse_date_text(rf_text)))
    n_text = F.trim(F.col("number_of_intervals"))
    # A count of any length: one that reaches back to first_date or further takes all periods.
    digits = F.regexp_extract(n_text, r"^0*([1-9][0-9]*)$", 1)
    last = period_start(rf, iv)
    first_all = period_start(fd, iv)
    periods = ((month_index(last) - month_index(first_all)) / k).cast("int") + 1
    n = F.when(F.length(digits) > 9, periods).otherwise(F.least(F.try_to_number(digits, F.lit("999999999")), periods))
    first = (F.when(n_text == ALL_TOKEN, first_all)
             .when(digits != "", F.greatest(first_all, F.add_months(last, ((n - 1) * -k).cast("int")))))
    base = spec.select(
        F.col("table").alias("table_name"),
        fd.alias("_fd"),
        k.alias("_k"),
        first.alias("_first"),
        last.alias("_last"),
    )
    return _explode_periods(base)


def selection_list(ranges: DataFrame) -> DataFrame:
    """``(table, selected_partitions)`` with names in date order, comma-joined.

    One row per table; the per-table list is bounded by the number of
    calendar periods, so the ordered ``collect_list`` stays small.
    """
    ordered = F.array_sort(F.collect_list(F.struct("range_start", "partition_name")))
    return (ranges.groupBy("table_name")
            .agg(F.array_join(F.transform(ordered, lambda r: r["partition_name"]), ",")
                 .alias("selected_partitions"))
            .select(F.col("table_name").alias("table"), "selected_partitions"))


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Every pair of ranges of one table that share a day: a range and the later-starting one (next_*).

    Partition diffs are by name, so changing a table's interval would leave
    old and new ranges side by side and count rows twice; writers refuse
    such range sets.  The pairs meet in the month in which the later range starts, so
    ranges far from each other are never compared.
    """
    dated = ranges.where("range_start IS NOT NULL AND range_end IS NOT NULL AND range_start <= range_end").select(*RANGE_COLUMNS).distinct()
    first = dated.withColumn("month", F.explode(F.sequence(month_index("range_start"), month_index("range_end"))))
    later = dated.select(F.col("table_name").alias("next_table"), F.col("partition_name").alias("next_partition"),
                         F.col("range_start").alias("next_start"), F.col("range_end").alias("next_end"),
                         month_index("range_start").alias("next_month"))
    order = F.struct("range_start", "range_end", "partition_name") < F.struct("next_start", "next_end", "next_partition")
    return (first.join(later, (F.col("table_name") == F.col("next_table")) & (F.col("month") == F.col("next_month"))
                       & (F.col("next_start") <= F.col("range_end")) & order)
            .select(*RANGE_COLUMNS, "next_start", "next_partition"))


def selection_json(selection: DataFrame) -> DataFrame:
    """One row, one column ``partitions_to_refresh``: the selection as JSON records.

    ``[{"table": ..., "selected_partitions": "a,b"}, ...]`` ordered by table,
    the hand-off form a refresh run accepts.  Built by Spark
    (``to_json(array_sort(collect_list(struct)))``); the list has one entry
    per table.
    """
    entries = F.array_sort(F.collect_list(F.struct("table", "selected_partitions")))
    return selection.agg(F.to_json(entries).alias("partitions_to_refresh"))
