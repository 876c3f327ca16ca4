"""Column expressions for calendar periods.

Everything here returns a ``Column`` so callers stay inside whole-stage
codegen: no Python runs per row.  An *interval* may be given either as a
Python string (one interval for the whole frame, e.g. a single table) or
as a Column (one interval per spec row).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The partition intervals a spec may name, the number of
# calendar months in each, and the text format of dates in specs and in
# partition names ("<table>_<start>_<end>").
INTERVAL_MONTHS = {"MONTH": 1, "QUARTER": 3, "YEAR": 12}
DATE_PATTERN = "yyyyMMdd"
DATE_TEXT_REGEX = r"^[0-9]{8}$"
TODAY_TOKEN = "TODAY"
ALL_TOKEN = "*"
NAME_SEPARATOR = "_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_interval(interval) -> Column:
    """Upper-cased, trimmed interval text (``'quarter '`` -> ``'QUARTER'``)."""
    if isinstance(interval, str) and interval.strip().upper() in INTERVAL_MONTHS:
        return F.lit(interval.strip().upper())
    return F.upper(F.trim(_col(interval)))


def interval_months(interval) -> Column:
    """Months per period; NULL for an unknown interval."""
    if isinstance(interval, str):
        k = INTERVAL_MONTHS.get(interval.strip().upper())
        return F.lit(k) if k is not None else F.lit(None).cast("int")
    iv = normalize_interval(interval)
    expr = None
    for name, k in INTERVAL_MONTHS.items():
        expr = (F.when(iv == name, F.lit(k)) if expr is None
                else expr.when(iv == name, F.lit(k)))
    return expr


def parse_date_text(c) -> Column:
    """``yyyyMMdd`` text to DATE; NULL when malformed or not a real day."""
    c = _col(c)
    return F.when(c.rlike(DATE_TEXT_REGEX), F.try_to_date(c, DATE_PATTERN))


def as_date(value) -> Column:
    """A DATE column from a Python date, ``yyyy-MM-dd``/``yyyyMMdd`` text or a Column."""
    return value.cast("date") if isinstance(value, Column) else F.lit(python_date(value))


def python_date(value) -> _dt.date:
    """A Python date from a date, a datetime or ``yyyy-MM-dd`` / ``yyyyMMdd`` text."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    if isinstance(value, str):
        text = value.strip()
        if len(text) == 8 and text.isdigit():
            return _dt.datetime.strptime(text, "%Y%m%d").date()
        return _dt.date.fromisoformat(text)
    raise TypeError(f"cannot use {value!r} as a date")


def day_of(c) -> Column:
    """The calendar day of a DATE / TIMESTAMP / TIMESTAMP_NTZ column."""
    return F.to_date(_col(c))


def period_start(d, interval) -> Column:
    """First day of the period holding day ``d``."""
    d = _col(d)
    if isinstance(interval, str):
        unit = interval.strip().upper()
        if unit not in INTERVAL_MONTHS:
            raise ValueError(f"unknown interval {interval!r}; expected {sorted(INTERVAL_MONTHS)}")
        return F.trunc(d, unit)
    k = interval_months(interval)
    # Periods divide the year evenly, so the period start is the year start
    # plus the whole periods elapsed before this month.
    return F.add_months(F.trunc(d, "YEAR"),
                        (F.floor((F.month(d) - 1) / k) * k).cast("int"))


def period_end(start, interval) -> Column:
    """Last day of the period that begins on ``start``."""
    return F.date_sub(F.add_months(_col(start), interval_months(interval)), 1)


def partition_name(table, range_start, range_end) -> Column:
    """``<table>_<yyyyMMdd>_<yyyyMMdd>``; ``table`` is a literal name or a Column."""
    tbl = table if isinstance(table, Column) else F.lit(table)
    return F.concat_ws(NAME_SEPARATOR, tbl,
                       F.date_format(_col(range_start), DATE_PATTERN),
                       F.date_format(_col(range_end), DATE_PATTERN))


def month_index(d) -> Column:
    """Months since 0000-01 as an INT: an equi-join key for month buckets."""
    d = _col(d)
    return F.year(d) * 12 + F.month(d) - 1


def in_day_range(c, start, end) -> Column:
    """Half-open test ``start <= c < end + 1 day`` on the raw column.

    Inclusive bounds on the *day* but written so a TIMESTAMP with time of
    day on the last day is kept, and so Parquet gets a plain range filter.
    """
    c = _col(c)
    return (c >= as_date(start)) & (c < F.date_add(as_date(end), 1))
