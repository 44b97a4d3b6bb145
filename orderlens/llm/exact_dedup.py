"""Exact duplicates by progressive refinement, with DataFrame functions only.

Texts count as equal when they are identical after lower-casing A-Z. Three passes narrow the rows
down: byte lengths that occur once are settled, then hashes of the first ``PREFIX`` characters that
occur once, and only what is left gets a SHA-256 over the whole text. Which rows are left is passed
on as at most ``SLOTS`` slots, so each broadcast is bounded whatever the input; a row that
shares a slot by chance is hashed in vain and settled as a group of one. No text is shuffled to
find the copies.

Defined results: a null text counts as empty. A null id is smaller than any other. Rows that agree
in id and text are copies like any other, and exactly one of them stays. An empty table gives an
empty result. Further columns are ignored by :func:`mark_copies` and returned by :func:`keep_last`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import filled, kept_table, lowered

PREFIX = 64
SLOTS = 1 << 18


def _length(text: Column) -> Column:
    return F.octet_length(filled(text))  # the same before and after lower-casing A-Z


def _slot(text: Column) -> Column:
    prefix = F.xxhash64(lowered(F.substring(text, 1, PREFIX)))
    return F.pmod(F.xxhash64(_length(text), prefix), F.lit(SLOTS)).cast("int")


def surviving_slots(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per slot that holds a (length, prefix) shared by several rows; ``SLOTS`` at most."""
    text = F.col(f"`{text_col}`")
    lengths = docs.select(_length(text).alias("length")).groupBy("length").count().where("count > 1")
    # as slots, so that they can be broadcast and no length gathers its rows in one task
    lengths = lengths.select(F.pmod("length", F.lit(SLOTS)).alias("length_slot")).distinct()
    keyed = docs.select(
        _length(text).alias("length"),
        F.pmod(_length(text), F.lit(SLOTS)).alias("length_slot"),
        F.xxhash64(lowered(F.substring(text, 1, PREFIX))).alias("prefix"),
    ).join(F.broadcast(lengths), "length_slot", "left_semi")
    shared = keyed.groupBy("length", "prefix").count().where("count > 1")
    slot = F.pmod(F.xxhash64("length", "prefix"), F.lit(SLOTS)).cast("int")
    return shared.select(slot.alias("_llm_slot")).distinct()


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False) -> DataFrame:
    """Each row's group: id, keep_id, group_size, kept, text_sha256.

    The row with the largest id stays. ``text_sha256`` is null for texts settled before the last
    pass, unless ``hash_all`` asks for the digest of every text.
    """
    text = F.col(f"`{text_col}`")
    slots = surviving_slots(docs, text_col).withColumn("hit", F.lit(True))
    hashed = (
        docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), _slot(text).alias("_llm_slot"))
        .join(F.broadcast(slots), "_llm_slot", "left")
        .select(
            "id",
            F.when(F.col("hit") | F.lit(hash_all), F.sha2(lowered(F.col("text")), 256)).alias("text_sha256"),
            F.coalesce("hit", F.lit(False)).alias("hit"),
            # tells apart rows that agree in id and text without gathering them
            F.spark_partition_id().alias("part"),
        )
    )
    rows = kept_table(hashed, "exact-rows")
    alone = rows.where(~F.col("hit")).select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    counted = rows.where("hit").groupBy("id", "text_sha256", "part").agg(F.count("*").alias("n"))
    # written, so that the join below is on shuffled rows only and Spark can split a large group
    groups = kept_table(
        counted.groupBy("text_sha256").agg(F.max(F.struct("id", "part")).alias("top"), F.sum("n").alias("group_size")),
        "exact-groups",
    )
    stays = F.col("id").eqNullSafe(F.col("top.id")) & (F.col("part") == F.col("top.part")) & (F.col("copy") == 1)
    copies = (
        counted.join(groups, "text_sha256")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select(
            F.col("id").alias(id_col), F.col("top.id").alias("keep_id"), "group_size", stays.alias("kept"), "text_sha256"
        )
    )
    return alone.unionByName(copies)


def keep_last(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without those that have an equal text with a larger id."""
    columns = docs.columns
    slots = surviving_slots(docs, text_col)
    # a row is carried as one value, so that its columns may have any name
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))
    text, own = F.col("row").getField(text_col), F.col("row").getField(id_col)
    placed = whole.withColumn("_llm_slot", _slot(text))
    alone = placed.join(F.broadcast(slots), "_llm_slot", "left_anti")
    rest = placed.join(F.broadcast(slots), "_llm_slot", "left_semi").select("row", F.sha2(lowered(text), 256).alias("hash"), own.alias("id"))
    largest = kept_table(rest.groupBy("hash").agg(F.max("id").alias("keep")), "exact-largest")
    last = rest.join(largest, "hash").where(F.col("id").eqNullSafe(F.col("keep"))).dropDuplicates(["hash", "id"])
    kept = alone.select("row").unionByName(last.select("row"))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in columns))
