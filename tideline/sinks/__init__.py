from tideline.sinks.catalog import (
    LayerTable,
    check_place,
    create_layer_table,
    forget_partitions,
    known_days,
    register_days,
    register_partitions,
    repair_partitions,
)
from tideline.sinks.parquet import empty_folder, replace_clustered_days, replace_days, replace_load
from tideline.sinks.versions import (
    clear_replaced,
    publish_days,
    restore_published,
    settle,
    write_version,
)

__all__ = [
    "LayerTable",
    "check_place",
    "clear_replaced",
    "create_layer_table",
    "empty_folder",
    "forget_partitions",
    "known_days",
    "publish_days",
    "register_days",
    "register_partitions",
    "repair_partitions",
    "replace_clustered_days",
    "replace_days",
    "replace_load",
    "restore_published",
    "settle",
    "write_version",
]
