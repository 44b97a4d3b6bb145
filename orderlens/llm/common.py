"""What several operators share: reading the tables, empty texts, scratch tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import storage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lowered(text: Column) -> Column:
    """A null-free text with A-Z, and nothing else, in lower case."""
    return F.translate(filled(text), UPPER, UPPER.lower())


def kept_table(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, safe from lost executors."""
    spark = df.sparkSession
    return storage.written(spark, df, storage.scratch_folder(spark, label))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def settled_table(df: DataFrame, label: str, records: int | None = None) -> DataFrame:
    """As ``kept_table``; what was shuffled to make it is deleted once it is written, not when the driver next collects garbage.

    Python functions get so many records at a time, if that is given: for rows that are long.
    """
    conf = df.sparkSession.conf
    given = {CLEANUP: "true"} | ({RECORDS: str(records)} if records else {})
    before = {name: conf.get(name) for name in given}
    try:
        for name, value in given.items():
            conf.set(name, value)
        return kept_table(df, label)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of ``kept_table`` that nothing will read any more."""
    for made in tables:
        for folder in {path.rsplit("/", 1)[0] for path in made.inputFiles()}:
            storage.delete(made.sparkSession, folder)


class Shared:
    """Plain values on all executors, and an object that is made of them once in each Python worker.

    A broadcast object would be pickled by the name of its class, which executors could only read with this package
    installed. Here the class travels by value with the function that uses it.
    """

    def __init__(self, spark: SparkSession, build: Callable, *parts):
        self._build, self._parts = build, spark.sparkContext.broadcast(parts)

    @property
    def value(self):
        held = self._parts  # the same one for all tasks of a worker
        if not hasattr(held, "_llm_built"):
            held._llm_built = self._build(*held.value)
        return held._llm_built


def release() -> None:
    """Give freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same function for ``mapInArrow``; after a partition, freed memory goes back to the system.

    Python workers wait for further tasks and would otherwise keep what their largest one needed.
    """

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return released
