"""The lake: a folder of order-item batches in Parquet.

A batch is one Parquet folder (or file) named ``orders_<id>.parquet``. It is written under a
hidden name and renamed when complete, so a reader, batch or stream, never sees half of one. A batch that is
landed here tells its types in a small file beside its data; of other writers' batches each file's footer does.
"""

from __future__ import annotations

import json
import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlens import storage
from orderlens.functions.casts import conform, exactly
from orderlens.schema import RAW

log = logging.getLogger(__name__)

MANIFEST = "_schema.json"  # hidden from readers of the data


def land_batch(df: DataFrame, lake: str, batch_id: str | None = None, empty: bool = True) -> str:
    """Write the frame as one new batch with the fixed lake schema and return its path.

    Without ``batch_id`` the name is the current time. Landing the same ``batch_id`` again
    replaces the batch, so a retried load does not count twice. A frame with absent or unknown
    columns, or with types whose values may not fit, is an error, and so is one without rows if
    ``empty`` is False: then nothing is landed.
    """
    spark = df.sparkSession
    fresh = batch_id is None
    name = f"orders_{datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}" if fresh else f"orders_{batch_id}"
    hidden = f"{lake}/_landing_{uuid.uuid4().hex}"
    final = f"{lake}/{name}.parquet"
    exactly(df, RAW).write.parquet(hidden)
    if not empty and spark.read.schema(RAW).parquet(hidden).isEmpty():
        storage.delete(spark, hidden)
        raise ValueError("the batch has no rows")
    storage.write_text(spark, f"{hidden}/{MANIFEST}", RAW.json())
    if not fresh:
        storage.delete(spark, final)
    storage.move(spark, hidden, final)
    return final


def list_batches(spark: SparkSession, lake: str) -> list[str]:
    return [path for path in storage.children(spark, lake) if path.endswith(".parquet")]


def _with_types(spark: SparkSession, batch: str) -> list[tuple[str, T.StructType]]:
    """A batch's folder with its types, or every file of it with its own."""
    if storage.exists(spark, f"{batch}/{MANIFEST}"):
        return [(batch, T.StructType.fromJson(json.loads(storage.read_text(spark, f"{batch}/{MANIFEST}"))))]
    entries = storage.children(spark, batch)
    # a file, a folder of files, or, read as one, anything else
    parts = entries if entries and all(e.endswith(".parquet") for e in entries) else [batch]
    return [(part, spark.read.parquet(part).schema) for part in parts]


def read_as_written(spark: SparkSession, batches: list[str]) -> list[DataFrame]:
    """Batches with the types their writers chose, one frame for each set of types.

    Writers that infer types store whole numbers as 64-bit integers, or as floats where a value is
    missing, so files of one lake, and even of one batch, differ. Batches that were landed here take no job to find that out.
    """
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    with ThreadPoolExecutor(max_workers=16) as pool:
        for found in pool.map(partial(_with_types, spark), batches):
            for path, schema in found:
                alike.setdefault(schema.json(), (schema, []))[1].append(path)
    return [spark.read.schema(schema).parquet(*paths) for schema, paths in alike.values()]


def read_batches(spark: SparkSession, batches: list[str]) -> DataFrame:
    """Exactly these batches as one frame of the lake's types; no batches give an empty frame."""
    parts = [conform(frame, RAW) for frame in read_as_written(spark, batches)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RAW)


def read_lake(spark: SparkSession, lake: str) -> DataFrame:
    """All batches now in the lake."""
    return read_batches(spark, list_batches(spark, lake))


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """One Parquet file from any writer, safe-cast to the lake schema."""
    return conform(spark.read.parquet(path), RAW)


def cleanup_lake(spark: SparkSession, batches: list[str]) -> list[str]:
    """Delete exactly these batches. Failures are logged and returned, not raised."""

    def remove(path: str) -> str | None:
        try:
            storage.delete(spark, path)
            return None
        except Exception as error:  # a batch that stays is loaded again, which the caller can see
            log.warning("could not delete %s: %s", path, error)
            return path

    with ThreadPoolExecutor(max_workers=16) as pool:
        return [path for path in pool.map(remove, batches) if path]
