"""Shards of nearly equal size by sampled splitters.

Records are ordered by a key: a hash of the text, so that copies are neighbours, then a hash of the
id, then a random number for rows that agree in both. Keys are drawn with a probability that grows
with the record's size; their quantiles split the order into ``RANGES`` ranges a shard, none of which
has more than about twice the mean of bytes or of rows. A splitter lies before a text's copies, unless copies fill more than a range: those are
subdivided at the sampled keys themselves. Exact bytes and rows of the ranges then tell where shards
begin, and how many slots each range's predecessors take.

What the driver handles is bounded by the parameters: a sample of ``DRAWN`` keys a range on average,
and ``RANGES`` ranges a shard. Slots are counted within ranges, so no task sorts a whole shard. The keys are
written once; texts are read once and never moved.

Law ``bytes``: a shard's bytes differ from the mean by about a range, that is 2/``RANGES`` of a
shard at most, unless a single record is larger.

Defined results: a null text has size 8 and the same key as an empty one; a null id is hashed like any
other value; repeated rows are records of their own. An empty table gives an empty result. Further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import Shared, filled, kept_table

SHARDS = 24
RANGES = 256  # per shard
DRAWN = 8  # sampled keys per range
OVERHEAD = 8  # bytes a record counts besides its text
KEY = ("k1", "k2", "k3")


@dataclass
class Splitters:
    """The first key of every range but the first, ascending."""

    keys: np.ndarray  # structured k1, k2, k3

    @staticmethod
    def of(sample: np.ndarray, ranges: int) -> Splitters:
        """Quantiles of sampled keys, moved before a text's copies unless these fill several ranges."""
        sample = np.sort(sample, order=KEY)
        if not len(sample):
            return Splitters(sample)
        chosen = sample[np.arange(1, ranges) * len(sample) // ranges]
        repeated = np.append(False, chosen["k1"][1:] == chosen["k1"][:-1])
        low = np.iinfo(np.int64).min
        chosen["k2"][~repeated], chosen["k3"][~repeated] = low, low
        return Splitters(np.unique(chosen))

    def range_of(self, keys: np.ndarray) -> np.ndarray:
        """How many splitters are not above each key."""
        first, last = np.searchsorted(self.keys["k1"], keys["k1"]), np.searchsorted(self.keys["k1"], keys["k1"], "right")
        found = first.copy()
        for i in np.flatnonzero(last - first > 1):  # copies that are subdivided
            found[i] += np.searchsorted(self.keys[first[i] : last[i]], keys[i], "right")
        one = last - first == 1
        at = np.minimum(first, max(0, len(self.keys) - 1))
        if one.any():
            own = self.keys[at[one]]
            k2, k3 = keys["k2"][one], keys["k3"][one]
            found[one] += (own["k2"] < k2) | (own["k2"] == k2) & (own["k3"] <= k3)
        return found


DTYPE = np.dtype([(k, "<i8") for k in KEY])


def _keys(columns: list[np.ndarray]) -> np.ndarray:
    keys = np.empty(len(columns[0]), dtype=DTYPE)
    for name, values in zip(KEY, columns, strict=True):
        keys[name] = values
    return keys


def _placed(batches: Iterator[pa.RecordBatch], splitters) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _keys([batch.column(k).to_numpy() for k in KEY])
        ranges = pa.array(splitters.value.range_of(keys).astype(np.int32))
        yield pa.RecordBatch.from_arrays([*batch.columns, ranges], names=[*batch.schema.names, "range"])


def _first_ranges(sizes: np.ndarray, tidy: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each range: cuts nearest to equal bytes, before a text's copies if one is about as near."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    cuts = []
    starts = ends - sizes  # bytes before each range
    for shard in range(1, shards):
        away = np.abs(starts - total * shard / shards)
        best = int(np.argmin(away))
        near = np.flatnonzero(tidy & (away <= away[best] + total / shards / 100))
        cuts.append(int(near[np.argmin(away[near])]) if len(near) else best)
    return np.searchsorted(np.array(sorted(cuts)), np.arange(len(sizes)), "right")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row; slots are gapless from 0 in each shard."""
    spark = docs.sparkSession
    text = filled(F.col(text_col))
    keyed = kept_table(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).alias("k2"),
            (F.rand(7) * (1 << 62)).cast("long").alias("k3"),
        ),
        "keys",
    )
    ranges = shards * RANGES
    total, count = keyed.agg(F.coalesce(F.sum("size"), F.lit(1)), F.greatest(F.count("*"), F.lit(1))).first()
    # a record's share of the bytes and of the rows, times the number of draws: how many of them it gets
    # on average; k3 is uniform and rounds the number at random, once and for all
    share = (F.col("size") / F.lit(total) + 1 / F.lit(count)) / 2
    draws = (share * (ranges * DRAWN) + F.col("k3") / (1 << 62)).cast("int")
    drawn = keyed.select(*KEY, draws.alias("draws")).where("draws > 0").toArrow()
    times = drawn["draws"].to_numpy()
    sample = np.repeat(_keys([drawn[k].to_numpy() for k in KEY]), times)
    splitters = Splitters.of(sample, ranges)
    shared = Shared(spark, Splitters, splitters.keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema)
    placed = keyed.mapInArrow(partial(_placed, splitters=shared), f"{schema}, range int")

    found = placed.groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).toArrow()
    sizes, rows = np.zeros(ranges, dtype=np.int64), np.zeros(ranges, dtype=np.int64)
    at = found["range"].to_numpy()
    sizes[at], rows[at] = found["size"].to_numpy(), found["rows"].to_numpy()
    tidy = np.ones(ranges, dtype=bool)
    tidy[1 : 1 + len(splitters.keys)] = splitters.keys["k2"] == np.iinfo(np.int64).min
    shard = _first_ranges(sizes, tidy, shards)
    before = np.cumsum(rows) - rows
    first = np.full(shards, np.iinfo(np.int64).max)
    np.minimum.at(first, shard, before)
    plan = spark.createDataFrame(
        pa.table({"range": pa.array(np.arange(ranges, dtype=np.int32)), "shard": pa.array(shard.astype(np.int32)), "before": pa.array(before - first[shard])})
    )
    order = Window.partitionBy("range").orderBy(*KEY)
    return (
        placed.join(F.broadcast(plan), "range")  # a row for each range
        .withColumn("slot", F.col("before") + F.row_number().over(order) - 1)
        .select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
    )


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The shards with the law they keep: id, size, text_crc32, law, shard, slot, grown_shard."""
    return shard_by_bytes(docs, shards, id_col, text_col).select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
