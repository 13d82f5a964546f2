"""Landing files, catalog tables and table writers."""

from siltstone.sources.landing import has_input, normalise_columns, read_landing, snake_case, stamp_interval
from siltstone.sources.tables import (
    in_interval,
    interval_rows,
    partition_columns,
    scan,
    staged_view,
    up_to_interval,
)
from siltstone.sources.writers import (
    COMPRESSION,
    FEW_PARTITIONS,
    SIDE_COMPRESSION,
    add_missing_columns,
    clustered,
    create_table,
    drop_partitions,
    drop_table,
    finish_replacement,
    rename_columns,
    replace_partition,
    replace_partitions,
    replace_table,
    set_table_property,
    table_property,
    wanted_renames,
    widen_columns,
)
from siltstone.sources.upsert import merge_rows, remove_keys, upsert

__all__ = [
    "COMPRESSION",
    "FEW_PARTITIONS",
    "SIDE_COMPRESSION",
    "add_missing_columns",
    "clustered",
    "create_table",
    "drop_partitions",
    "drop_table",
    "finish_replacement",
    "has_input",
    "in_interval",
    "interval_rows",
    "merge_rows",
    "normalise_columns",
    "partition_columns",
    "read_landing",
    "remove_keys",
    "rename_columns",
    "replace_partition",
    "replace_partitions",
    "replace_table",
    "scan",
    "set_table_property",
    "snake_case",
    "staged_view",
    "stamp_interval",
    "table_property",
    "up_to_interval",
    "upsert",
    "wanted_renames",
    "widen_columns",
]
