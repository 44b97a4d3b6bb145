from orderlens.sources.documents import (
    flatten_orders,
    parse_orders,
    read_orders_json,
    require_non_empty,
    with_ingestion_ts,
)
from orderlens.sources.lake import cleanup_lake, land_batch, list_batches, read_batch, read_batches, read_lake
from orderlens.sources.split_documents import read_orders_split

__all__ = [
    "cleanup_lake",
    "flatten_orders",
    "land_batch",
    "list_batches",
    "parse_orders",
    "read_batch",
    "read_batches",
    "read_lake",
    "read_orders_json",
    "read_orders_split",
    "require_non_empty",
    "with_ingestion_ts",
]
