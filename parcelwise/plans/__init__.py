"""Entry points that write: partition (W13), refresh (W14-W16), run."""

from .orchestrate import derived_selection, run  # noqa: F401
from .partition import (  # noqa: F401
    TableBinding,
    manifest_profile,
    materialize_partitions,
    partition_tables,
    retire_default,
    write_default_partition,
)
from .refresh import (  # noqa: F401
    RefreshFailed,
    check_report,
    refresh,
    refresh_partial_batch,
    refresh_report,
    refresh_transactional,
)
from .targets import CatalogTarget, FolderTarget  # noqa: F401
