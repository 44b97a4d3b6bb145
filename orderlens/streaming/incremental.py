"""The refresh as increments: each micro-batch reads only its own files.

The marts are additive, so what is kept between micro-batches is their common grain (items and reorders by product,
department and hour), merged with the grain of the new rows, and a list of folders of detail rows. State ``n`` is made from
state ``n - 1`` and the files of micro-batch ``n`` alone, under new folder names, and is published last. A micro-batch that
runs again after a failure thus starts from the state before it and replaces its own: it never counts twice.

Work follows the size of the new batch and the number of groups, not the rows loaded before. Folders of detail
rows are merged ``FANOUT`` at a time, so their number, and how often a row is written again, grow with the
logarithm of the number of micro-batches.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import storage
from orderlens.functions.casts import exactly, to_raw_orders
from orderlens.operators.marts import GRAIN, mart_grain, marts_from_grain
from orderlens.schema import RAW, SORT_KEYS, TABLES
from orderlens.sinks.warehouse import load_report, refresh_tables
from orderlens.streaming.refresh import ANY_AGE

FANOUT = 16
DETAIL = "raw_orders"


@dataclass
class _State:
    """After a micro-batch: the folder of the merged grain, and folders of detail rows with how often they were merged."""

    grain: str | None = None
    rows: list[tuple[str, int]] = field(default_factory=list)


class _States:
    """The states of one stream, a small file for each of the last micro-batches."""

    def __init__(self, spark: SparkSession, root: str, stream: str):
        self.spark, self.folder = spark, f"{root}/increments/{stream}"

    def _path(self, number: int) -> str:
        return f"{self.folder}/states/{number:012d}.json"

    def _numbers(self) -> list[int]:
        files = storage.children(self.spark, f"{self.folder}/states")
        return [int(path.rsplit("/", 1)[1].removesuffix(".json")) for path in files]

    def before(self, number: int) -> _State:
        earlier = [n for n in self._numbers() if n < number]
        if not earlier:
            return _State()
        found = json.loads(storage.read_text(self.spark, self._path(earlier[-1])))
        return _State(found["grain"], [tuple(r) for r in found["rows"]])

    def publish(self, number: int, state: _State) -> None:
        storage.delete(self.spark, self._path(number))  # of an earlier attempt
        storage.write_text(self.spark, self._path(number), json.dumps(asdict(state)))

    def grain_folder(self, number: int) -> str:
        return f"{self.folder}/grain/{number:012d}-{uuid.uuid4().hex[:8]}"

    def forget(self, number: int) -> None:
        """Drop states before the last one, and grains that neither of the two refers to."""
        kept = {n for n in self._numbers() if n >= number} | set([n for n in self._numbers() if n < number][-1:])
        used = {json.loads(storage.read_text(self.spark, self._path(n)))["grain"].rsplit("/", 1)[1] for n in kept}
        for n in set(self._numbers()) - kept:
            storage.delete(self.spark, self._path(n))
        for path in storage.children(self.spark, f"{self.folder}/grain"):
            if path.rsplit("/", 1)[1] not in used:
                storage.delete(self.spark, path)


def _detail_folder(root: str) -> str:
    return f"{root}/{DETAIL}/gen={uuid.uuid4().hex}"


def _merge_rows(spark: SparkSession, root: str, rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Merge the newest ``FANOUT`` folders into one while they have been merged equally often."""
    while len(rows) >= FANOUT and len({level for _, level in rows[-FANOUT:]}) == 1:
        merged, level = _detail_folder(root), rows[-1][1]
        together = spark.read.schema(TABLES[DETAIL]).parquet(*(path for path, _ in rows[-FANOUT:]))
        together.sortWithinPartitions(*SORT_KEYS[DETAIL]).write.parquet(merged)
        rows = [*rows[:-FANOUT], (merged, level + 1)]
    return rows


def _load(batch: DataFrame, number: int, root: str, states: _States) -> None:
    spark, before = batch.sparkSession, states.before(number)
    grain = mart_grain(batch)
    if before.grain:
        earlier = spark.read.schema(grain.schema).parquet(before.grain)
        sums = (F.sum(c).alias(c) for c in ("total_orders", "reorder_count"))
        grain = grain.unionByName(earlier).groupBy(*GRAIN).agg(*sums)
    state = _State(states.grain_folder(number))
    grain = storage.written(spark, grain, state.grain)
    folder = _detail_folder(root)
    exactly(to_raw_orders(batch), TABLES[DETAIL]).sortWithinPartitions(*SORT_KEYS[DETAIL]).write.parquet(folder)
    state.rows = _merge_rows(spark, root, [*before.rows, (folder, 0)])
    refresh_tables(spark, marts_from_grain(grain), root, present={DETAIL: [path for path, _ in state.rows]})
    states.publish(number, state)
    states.forget(number)


def incremental_refresh(
    spark: SparkSession, lake: str, warehouse: str, checkpoint: str, progress: list[dict] | None = None
) -> DataFrame:
    """Add what is new in the lake to the tables, then stop; returns rows per table.

    The four tables describe everything the stream with this ``checkpoint`` has ever loaded, and are refreshed
    together after each micro-batch. Batches stay in the lake; deleting those that are loaded changes
    nothing. A warehouse is fed by one stream, or by whole refreshes, not by both. Rows are taken as they land:
    there is no deduplication across batches. Files have the lake's types, as :func:`land_batch` writes them. ``progress``
    receives Spark's report of each micro-batch.
    """
    root = warehouse.rstrip("/")
    items = (
        spark.readStream.schema(RAW)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFileAge", ANY_AGE)
        .parquet(lake)
    )

    def load(batch: DataFrame, number: int) -> None:
        # the stream's own id, as numbers start again with another checkpoint
        stream = json.loads(storage.read_text(spark, f"{checkpoint}/metadata"))["id"]
        _load(batch, number, root, _States(spark, root, stream))

    query = items.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if progress is not None:
        progress += [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    return load_report(spark, root)
