"""The warehouse: four Parquet tables that are refreshed together.

Every refresh writes new folders ``<table>/gen=<number>`` and then publishes one small manifest
file that names the folder of each table. Readers take the newest manifest, so they see all tables
of one refresh or all of the one before, and a refresh that fails halfway changes nothing. One
refresh runs at a time: it claims the next number with a file of that name, and another one that wants the same
number fails. The claim goes with the end of the refresh, also if it fails; that of a driver that died counts for
``CLAIM_HOURS``, or until the file is deleted.

Folders of earlier generations stay for queries already running: the last ``KEPT_GENERATIONS`` of
them, and all that were current within the last ``KEPT_HOURS``. Choose these hours longer than the longest
report; each generation holds the tables of one refresh.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import storage
from orderlens.functions.casts import exactly
from orderlens.functions.text import readable_quantity
from orderlens.schema import SORT_KEYS, TABLES

KEPT_GENERATIONS = 2
KEPT_HOURS = 6.0
CLAIM_HOURS = 24.0


class RefreshRunningError(RuntimeError):
    """Another refresh of the same warehouse has not ended."""


def _manifests(spark: SparkSession, root: str) -> list[str]:
    return storage.children(spark, f"{root}/generations")


def current_paths(spark: SparkSession, root: str) -> dict[str, str | list[str]]:
    """Folder of each table in the newest generation, or several of a table of increments; empty before the first one."""
    published = _manifests(spark, root)
    return json.loads(storage.read_text(spark, published[-1])) if published else {}


def _next_number(spark: SparkSession, root: str) -> int:
    published = _manifests(spark, root)
    return int(published[-1].rsplit("/", 1)[1].split("-")[0]) + 1 if published else 1


@contextmanager
def _claimed(spark: SparkSession, root: str) -> Iterator[int]:
    """The next generation's number, claimed until the block ends."""
    number = _next_number(spark, root)
    path = f"{root}/claims/{number:012d}"
    if not storage.claim(spark, path):
        if storage.modified(spark, path) > time.time() - CLAIM_HOURS * 3600:
            raise RefreshRunningError(f"refresh {number} of {root} is running; delete {path} if its driver has died")
        storage.delete(spark, path)
        if not storage.claim(spark, path):
            raise RefreshRunningError(f"refresh {number} of {root} is running")
    try:
        if _next_number(spark, root) != number:
            raise RefreshRunningError(f"refresh {number} of {root} has just ended")
        yield number
    finally:
        storage.delete(spark, path)


def _clustered(spark: SparkSession, rows: DataFrame, name: str, folder: str) -> DataFrame:
    """Range-partition the rows by the table's key, equal keys and copies spread evenly.

    The rows are written first, and their place in those files breaks ties: unlike a row number or
    a random salt it is the same when a lost task runs again, so no row is lost or doubled.
    """
    staged = storage.written(spark, rows, folder)
    place = {"_file": F.col("_metadata.file_name"), "_place": F.col("_metadata.row_index")}
    return staged.withColumns(place).repartitionByRange(*SORT_KEYS[name], *place).drop(*place)


def _folders(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else path


def refresh_tables(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    cluster: bool = False,
    present: Mapping[str, list[str]] | None = None,
) -> dict[str, str | list[str]]:
    """Replace the given tables by the given frames in one step; other tables stay as they are.

    Each file is sorted by its table's key, so that row-group statistics skip well. ``cluster``
    also gives each file its own range of keys; that shuffles the whole table, so it is for tables
    read far more often than written. An empty frame leaves an empty table. Returns the folder of
    every table. ``present`` names tables whose folders, one level below the table's, are already written. A frame whose columns are not the table's, or whose values may not fit, is an error.
    Catalog databases that follow the warehouse are pointed at the new folders.
    """
    root = root.rstrip("/")
    with _claimed(spark, root) as number:
        return _refresh(spark, frames, root, cluster, present or {}, number)


def _refresh(
    spark: SparkSession, frames: Mapping[str, DataFrame], root: str, cluster: bool, present: Mapping[str, list[str]], number: int
) -> dict[str, str | list[str]]:
    paths = current_paths(spark, root)
    label = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    scratch = storage.scratch_folder(spark, "cluster") if cluster else None

    def write(name: str) -> tuple[str, str]:
        folder = f"{root}/{name}/gen={label}"
        rows = exactly(frames[name], TABLES[name])
        if cluster:
            rows = _clustered(spark, rows, name, f"{scratch}/{name}")
        rows.sortWithinPartitions(*SORT_KEYS[name]).write.mode("overwrite").parquet(folder)
        return name, folder

    # The small tables are written while the last tasks of the large one leave executors idle.
    try:
        with ThreadPoolExecutor(max_workers=len(TABLES)) as pool:
            paths.update(pool.map(inheritable_thread_target(spark)(write), frames))
    finally:
        if scratch:
            storage.delete(spark, scratch)
    paths.update(present)
    storage.write_text(spark, f"{root}/generations/{label}.json", json.dumps(paths))
    for follower in storage.children(spark, f"{root}/followers"):
        database = follower.rsplit("/", 1)[1]
        if spark.catalog.databaseExists(database):
            sync_catalog(spark, root, database)
    _drop_old_generations(spark, root)
    return paths


def refresh_table(df: DataFrame, root: str, name: str, cluster: bool = False) -> str:
    """Replace one table by the frame and return its new folder."""
    return refresh_tables(df.sparkSession, {name: df}, root, cluster)[name]


def _drop_old_generations(spark: SparkSession, root: str) -> None:
    """Delete what is old enough, and folders that a failed refresh left behind."""
    published = _manifests(spark, root)
    # a generation was current until the next one was published
    ended = [storage.modified(spark, m) for m in published[1:]]
    old = {
        manifest
        for manifest, end in zip(published[:-KEPT_GENERATIONS], ended, strict=False)
        if end <= time.time() - KEPT_HOURS * 3600
    }
    for manifest in old:
        storage.delete(spark, manifest)
    kept = [json.loads(storage.read_text(spark, m)) for m in published if m not in old]
    used = {_folder_name(path) for manifest in kept for paths in manifest.values() for path in _folders(paths)}
    for name in TABLES:
        for path in storage.children(spark, f"{root}/{name}"):
            if _folder_name(path) not in used:
                storage.delete(spark, path)


def _folder_name(path: str) -> tuple[str, ...]:
    """Table and generation: the same folder may be spelled with or without its file system."""
    return tuple(path.rsplit("/", 2)[1:])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_tables(spark, root)[name]


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All four tables of the newest generation."""
    paths = current_paths(spark, root.rstrip("/"))
    return {
        name: spark.read.schema(schema).parquet(*_folders(paths[name])) if name in paths else spark.createDataFrame([], schema)
        for name, schema in TABLES.items()
    }


def ensure_tables(spark: SparkSession, root: str, database: str = "analytics") -> None:
    """Create the database and the four tables where they are missing; what exists stays.

    The database has a folder of its own, so that dropping it leaves the table files alone. From
    then on its tables follow every refresh of the warehouse.
    """
    root = root.rstrip("/")
    have = current_paths(spark, root)
    missing = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items() if name not in have}
    if missing:
        refresh_tables(spark, missing, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_quoted(f'{root}/catalog')}")
    sync_catalog(spark, root, database)
    follower = f"{root}/followers/{database}"
    if not storage.exists(spark, follower):
        storage.write_text(spark, follower, "")


def _quoted(path: str) -> str:
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sync_catalog(spark: SparkSession, root: str, database: str = "analytics") -> None:
    """Point the catalog's tables at the newest generation, for use from SQL; a table of increments becomes a view."""
    views = {row["viewName"] for row in spark.sql(f"SHOW VIEWS IN `{database}`").collect()}
    for name, path in current_paths(spark, root.rstrip("/")).items():
        table = f"`{database}`.`{name}`"
        if not isinstance(path, str):
            if name not in views:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            listed = ", ".join(f"`{f.name}`" for f in TABLES[name].fields)
            parts = (f"SELECT {listed} FROM parquet.`{folder}`" for folder in path)
            spark.sql(f"CREATE OR REPLACE VIEW {table} AS {' UNION ALL '.join(parts)}")
            continue
        if name in views:
            spark.sql(f"DROP VIEW {table}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[name].fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION {_quoted(path)}")
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(path)}")
        spark.catalog.refreshTable(f"{database}.{name}")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, as a number and as readable text."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(name).alias("table_name"), "total_rows")
        for name, df in tables.items()
    ]
    union = counts[0]
    for one in counts[1:]:
        union = union.unionByName(one)
    return union.withColumn("total_rows_text", readable_quantity(F.col("total_rows")))


def load_report(spark: SparkSession, root: str) -> DataFrame:
    """Rows loaded per table. Counts come from Parquet footers, no column is read."""
    return table_counts(read_tables(spark, root))
