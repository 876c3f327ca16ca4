"""Control inputs (specs, selections, catalogs, edges) and target storage."""

from .control import (  # noqa: F401
    COLUMNS_SCHEMA,
    EDGES_SCHEMA,
    RANGES_SCHEMA,
    SPEC_SCHEMA,
    columns_catalog,
    edges_frame,
    read_selection,
    read_spec,
    table_list,
)
from .catalog import catalog_partitions, create_table  # noqa: F401
from .storage import CommitConflict, manifest_frame, read_manifest, read_table, vacuum  # noqa: F401
