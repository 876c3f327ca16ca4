"""Column-expression helpers (calendar periods, partition names)."""

from .periods import (  # noqa: F401
    ALL_TOKEN,
    DATE_PATTERN,
    INTERVAL_MONTHS,
    TODAY_TOKEN,
    as_date,
    day_of,
    in_day_range,
    interval_months,
    month_index,
    normalize_interval,
    parse_date_text,
    partition_name,
    period_end,
    period_start,
)
