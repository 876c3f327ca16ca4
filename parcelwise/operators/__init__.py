"""DataFrame operators."""

from .assign import (  # noqa: F401
    assign_by_ranges,
    assign_partition,
    calendar_profile,
    partition_profile,
    slice_partition,
    uncovered_rows,
)
from .closure import component_labels, related_closure  # noqa: F401
from .ranges import (  # noqa: F401
    overlapping_ranges,
    period_ranges,
    refresh_ranges,
    selection_json,
    selection_list,
)
from .selection import (  # noqa: F401
    explode_selection,
    invalid_selection,
    refresh_scope,
    resolve_refresh_set,
    unavailable_tables,
    unknown_tables,
)
from .validate import InvalidInput, check_specs, invalid_specs, pending_partitions  # noqa: F401
