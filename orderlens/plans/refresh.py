"""From fetched documents to refreshed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens import storage
from orderlens.operators.dedupe import dedupe_latest
from orderlens.operators.marts import build_marts, product_analytics
from orderlens.operators.quality import set_aside, sound_rows, validate_batches
from orderlens.sinks.warehouse import ensure_tables, load_report, refresh_tables
from orderlens.sources.documents import flatten_orders, read_orders_json, with_ingestion_ts
from orderlens.sources.lake import cleanup_lake, land_batch, list_batches, read_batches
from orderlens.sources.split_documents import read_orders_split


def load_tables(raw: DataFrame, warehouse: str, dedupe: bool = False, cluster: bool = False) -> None:
    """Refresh the detail table and the marts from one raw frame.

    The raw frame is never cached: at full size a cache would only move it from one disk to
    another. Each read takes the columns it needs - all for the detail table, four for the product
    mart, two for the hours. The product mart goes to the scratch folder first, and both its table
    and the department roll-up read it from there, also when an executor is lost. With ``dedupe``
    the deduplicated rows are written once and then read. With ``cluster`` every file holds a range of
    its table's key of its own.
    """
    spark = raw.sparkSession
    scratch = storage.scratch_folder(spark, "load")
    try:
        if dedupe:
            raw = storage.written(spark, dedupe_latest(raw), f"{scratch}/latest")
        products = storage.written(spark, product_analytics(raw), f"{scratch}/products")
        refresh_tables(spark, build_marts(raw, products), warehouse, cluster)
    finally:
        storage.delete(spark, scratch)


def ingest_documents(
    spark: SparkSession,
    documents: str | list[str],
    lake: str,
    ts: str | None = None,
    multi_line: bool = False,
    batch_id: str | None = None,
    rejects: str | None = None,
    split: bool = False,
) -> str:
    """Flatten fetched documents into one new lake batch; an empty fetch is an error.

    Documents that do not parse are an error too, or go to the folder ``rejects``. The rows are
    counted after they are written, so the input is parsed once. With ``split`` each file is one document, and
    large ones are cut between their orders.
    """
    if split and rejects is not None:
        raise ValueError("documents that are cut are not set aside")
    read = read_orders_split(spark, documents) if split else read_orders_json(spark, documents, multi_line, rejects)
    items = flatten_orders(read)
    return land_batch(with_ingestion_ts(items, ts), lake, batch_id, empty=False)


def check_lake(spark: SparkSession, lake: str) -> DataFrame:
    """Violations per rule of the batches now in the lake, with the values that the load would lose."""
    return validate_batches(spark, list_batches(spark, lake))


def process_lake(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    dedupe: bool = False,
    database: str | None = None,
    cluster: bool = False,
    check: bool = False,
    quarantine: str | None = None,
) -> DataFrame:
    """Load the batches now in the lake, then delete exactly those; returns rows per table.

    The tables describe these batches only. If the load fails, the lake keeps them and the tables
    stay as they were; an empty lake is such a failure, and with ``check`` a violated rule is one. A
    batch that arrives meanwhile is neither read nor deleted. With ``database`` the catalog's tables
    follow the refresh. With ``quarantine`` rows that break a rule go to that folder with their rules, and the
    others load; it costs writing and reading the rows once more, in one pass with the checks.
    """
    batches = list_batches(spark, lake)
    if not batches:
        raise FileNotFoundError(f"no batches in {lake}")
    if check:
        broken = validate_batches(spark, batches).where("violations > 0").collect()  # a row for each rule
        if broken:
            raise ValueError("; ".join(f"{r['violations']} rows break '{r['rule']}'" for r in broken))
    split = set_aside(spark, batches, quarantine) if quarantine else None
    try:
        raw = sound_rows(spark, split) if split else read_batches(spark, batches)
        load_tables(raw, warehouse, dedupe, cluster)
    finally:
        if split:
            storage.delete(spark, split)
    if database:
        ensure_tables(spark, warehouse, database)
    cleanup_lake(spark, batches)
    return load_report(spark, warehouse)


def run_refresh(
    spark: SparkSession,
    documents: str | list[str],
    lake: str,
    warehouse: str,
    ts: str | None = None,
    multi_line: bool = False,
    dedupe: bool = False,
    database: str | None = None,
    rejects: str | None = None,
    cluster: bool = False,
    check: bool = False,
    quarantine: str | None = None,
    split: bool = False,
) -> DataFrame:
    """Ingest, load and clean up in order; a failing step stops the ones after it."""
    ingest_documents(spark, documents, lake, ts, multi_line, rejects=rejects, split=split)
    return process_lake(spark, lake, warehouse, dedupe, database, cluster, check, quarantine)
