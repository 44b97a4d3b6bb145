"""The scheduled refresh as a Structured Streaming job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.plans.refresh import load_tables
from orderlens.schema import RAW
from orderlens.sinks.warehouse import ensure_tables, load_report
from orderlens.sources.lake import cleanup_lake, list_batches, read_batches

ANY_AGE = "36500d"  # of files: the source would skip those much older than the newest one it has seen


def stream_refresh(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    checkpoint: str,
    cleanup: bool = True,
    database: str | None = None,
    cluster: bool = False,
) -> DataFrame:
    """Load the lake if it holds batches not loaded before, then stop; returns rows per table.

    The stream tells whether there is something new, and its checkpoint remembers what was loaded: a
    run without new batches changes nothing. As the tables are replaced, each micro-batch loads every
    batch that is then in the lake, as the batch refresh does. A run after a failure has a
    micro-batch for what the failed one had begun and one for what came later; the last of them leaves
    tables of all. Exactly the batches of the last load are deleted at the end. With ``database`` the
    catalog's tables follow the refresh.
    """
    items = (
        spark.readStream.schema(RAW)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFileAge", ANY_AGE)
        .parquet(lake)
    )
    loaded: list[str] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        present = list_batches(spark, lake)
        load_tables(read_batches(spark, present), warehouse, cluster=cluster)
        loaded[:] = present

    query = (
        items.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if database:
        ensure_tables(spark, warehouse, database)
    if cleanup:
        cleanup_lake(spark, loaded)
    return load_report(spark, warehouse)
