from orderlens.sinks.warehouse import (
    ensure_tables,
    load_report,
    read_table,
    read_tables,
    refresh_table,
    refresh_tables,
    sync_catalog,
    table_counts,
)

__all__ = [
    "ensure_tables",
    "load_report",
    "read_table",
    "read_tables",
    "refresh_table",
    "refresh_tables",
    "sync_catalog",
    "table_counts",
]
