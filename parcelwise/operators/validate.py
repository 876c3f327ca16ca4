"""Spec checks (W1) and the pending-partition diff."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import (
    ALL_TOKEN,
    INTERVAL_MONTHS,
    TODAY_TOKEN,
    normalize_interval,
    parse_date_text,
)

INVALID_COLUMNS = ["table", "partition_by", "reason", "value"]

# The reasons a spec row is reported with.
REASON_UNKNOWN_COLUMN = "unknown table or column"
REASON_BAD_FIRST_DATE = "invalid first_date"
REASON_BAD_INTERVAL = "invalid interval"
REASON_BAD_REFRESH_FROM = "invalid refresh_from"
REASON_BAD_COUNT = "invalid number_of_intervals"


def invalid_specs(spec: DataFrame, columns: DataFrame, for_refresh: bool = False) -> DataFrame:
    """Spec rows that cannot be used, one row per (spec row, problem).

    * the (table, partition_by) pair is not in the column catalog;
    * ``first_date`` is not a real ``yyyyMMdd`` day;
    * ``interval`` is not MONTH / QUARTER / YEAR (any case);
    * with ``for_refresh``: ``refresh_from`` is neither ``yyyyMMdd`` nor
      ``TODAY``, or ``number_of_intervals`` is neither ``*`` nor an integer >= 1.

    Output: table, partition_by, reason, value (the offending text).
    """
    unknown = (spec.join(columns,
                         (spec["table"] == columns["table_name"])
                         & (spec["partition_by"] == columns["column_name"]),
                         "left_anti")
               .select("table", "partition_by", F.lit(REASON_UNKNOWN_COLUMN).alias("reason"),
                       F.col("partition_by").alias("value")))
    bad_date = (spec.where(parse_date_text(F.col("first_date")).isNull())
                .select("table", "partition_by", F.lit(REASON_BAD_FIRST_DATE).alias("reason"),
                        F.col("first_date").alias("value")))
    iv = normalize_interval(F.col("interval"))
    bad_interval = (spec.where(iv.isNull() | ~iv.isin(*INTERVAL_MONTHS))
                    .select("table", "partition_by", F.lit(REASON_BAD_INTERVAL).alias("reason"),
                            F.col("interval").alias("value")))
    out = unknown.unionByName(bad_date).unionByName(bad_interval)
    if for_refresh:
        rf = F.trim(F.col("refresh_from"))
        rf_ok = (F.upper(rf) == TODAY_TOKEN) | parse_date_text(rf).isNotNull()
        bad_rf = (spec.where(~F.coalesce(rf_ok, F.lit(False)))
                  .select("table", "partition_by", F.lit(REASON_BAD_REFRESH_FROM).alias("reason"),
                          F.col("refresh_from").alias("value")))
        n = F.trim(F.col("number_of_intervals"))
        n_ok = (n == ALL_TOKEN) | n.rlike(r"^0*[1-9][0-9]*$")
        bad_n = (spec.where(~F.coalesce(n_ok, F.lit(False)))
                 .select("table", "partition_by", F.lit(REASON_BAD_COUNT).alias("reason"),
                         F.col("number_of_intervals").alias("value")))
        out = out.unionByName(bad_rf).unionByName(bad_n)
    return out


def check_specs(spec: DataFrame, columns: DataFrame, for_refresh: bool = False) -> None:
    """Raise ``ValueError`` listing the problems if any spec row is invalid."""
    raise_if_any(invalid_specs(spec, columns, for_refresh), "invalid partition spec")


class InvalidInput(ValueError):
    """Input that names something wrong: ``problems`` has every one, ``count`` their number."""

    def __init__(self, what: str, problems: list[dict]):
        super().__init__(f"{what}: {len(problems)}: {problems}")
        self.problems, self.count = problems, len(problems)


def raise_if_any(problems: DataFrame, what: str) -> None:
    """Raise ``InvalidInput`` with all rows of ``problems`` (one per bad entry of the caller's input)."""
    rows = [r.asDict() for r in problems.collect()]
    if rows:
        raise InvalidInput(what, rows)


def pending_partitions(expected: DataFrame, existing: DataFrame) -> DataFrame:
    """Expected ranges whose (table_name, partition_name) does not exist yet.

    The diff is by name only, as names carry the range.
    """
    return expected.join(existing.select("table_name", "partition_name"),
                         ["table_name", "partition_name"], "left_anti")
