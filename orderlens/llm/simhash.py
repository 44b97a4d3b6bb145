"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles of one population count each. Two tiles are compared
only if their counts differ by at most the radius: exclusive-or and bit counts in numpy, blocks of
rows against the columns whose 16-bit quarters can still be near (differences of the quarters'
counts add up to at most the distance). A tile pair returns a spanning forest of its links, not the
links, so that a group of near copies costs as many rows as it has members. Components of the
forests are the classes.

Comparing all pairs grows with the square of the number of distinct fingerprints; the tiles only
lower its constant. Tiles hold ``TILE`` fingerprints whatever the input, and their number follows it.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked
like any other. Null ids are members that never name a class, unless the class has no other. Rows
that agree in id are separate members. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import filled, kept_table, releasing
from orderlens.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42  # of XXH64
TILE = 1 << 14
ROWS = 64  # fingerprints compared at once with a tile's columns


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one UTF-8 text; a bit is 1 if set in over half of the shingles' hashes."""
    words = text.lower().split()  # for bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        octets = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        values = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64).view(np.int64)
        columns = [batch.column("id"), batch.column("text_hash"), pa.array(values)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fp) per row."""
    text = filled(F.col(text_col))
    given = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(releasing(partial(_fingerprints, shingle=shingle)), f"id {kind}, text_hash bigint, fp bigint")


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view("<u2").reshape(-1, 4)).astype(np.int8)


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, or within one if right is None.

    left and right: unsigned 64-bit fingerprints; radius: the largest number of differing bits.
    """
    own = right is None
    a = np.sort(left) if own else left
    order = np.lexsort(_quarters(a).T)
    a = a[order]
    b = a if own else right[np.lexsort(_quarters(right).T)]
    qb = _quarters(b)
    starts = range(0, len(b), ROWS)
    low = np.array([qb[s : s + ROWS].min(axis=0) for s in starts], dtype=np.int16).reshape(-1, 4)
    high = np.array([qb[s : s + ROWS].max(axis=0) for s in starts], dtype=np.int16).reshape(-1, 4)
    both, offset = (a, 0) if own else (np.concatenate([a, b]), len(a))
    qa, label, trees = _quarters(a), np.arange(len(both)), [np.empty((2, 0), dtype=np.int64)]
    for s in range(0, len(a), ROWS):
        rows, q = a[s : s + ROWS], qa[s : s + ROWS].astype(np.int16)
        gap = np.maximum(low - q.max(axis=0), 0) + np.maximum(q.min(axis=0) - high, 0)
        near = np.flatnonzero(gap.sum(axis=1) <= radius)
        if own:
            near = near[near >= s // ROWS]
        if not len(near):
            continue
        columns = (near[:, None] * ROWS + np.arange(ROWS)).ravel()
        columns = columns[columns < len(b)]
        found = np.bitwise_count(rows[:, None] ^ b[columns][None, :]) <= radius
        for r in np.flatnonzero(found.any(axis=1)):
            i, linked = s + int(r), columns[found[r]] + offset
            classes, first = np.unique(label[linked], return_index=True)
            new = classes != label[i]
            if new.any():
                trees.append(np.stack([np.full(new.sum(), i), linked[first[new]]]))
                joined = np.zeros(len(both), dtype=bool)
                joined[classes[new]] = True
                label[joined[label]] = label[i]
    pairs = np.concatenate(trees, axis=1)
    return both[pairs[0]], both[pairs[1]]


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    fps = np.sort(frame["fp"].to_numpy()).astype("<i8")
    return pd.DataFrame({"count": [frame["count"].iloc[0]], "tile": [frame["tile"].iloc[0]], "fps": [fps.tobytes()]})


def _compare(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for left, right in zip(batch["fps"], batch["other"], strict=True):
            a = np.frombuffer(left, dtype="<u8")
            b = None if right is None else np.frombuffer(right, dtype="<u8")
            x, y = tile_links(a, b, radius)
            yield pd.DataFrame({"a": x.view("<i8"), "b": y.view("<i8")})


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that join all fingerprints of the column fp (distinct) linked within the radius."""
    counted = distinct.select("fp", F.bit_count("fp").alias("count"))
    sizes = {r["count"]: r["n"] for r in counted.groupBy("count").agg(F.count("*").alias("n")).collect()}  # 65 at most
    tiles = {c: -(-n // TILE) for c, n in sizes.items()}
    number = F.create_map(*[F.lit(int(x)) for pair in tiles.items() for x in pair]) if tiles else F.lit(None)
    n_tiles = F.coalesce(number[F.col("count")], F.lit(1)) if tiles else F.lit(1)
    packed = kept_table(
        counted.withColumn("tile", F.pmod(F.xxhash64("fp"), n_tiles).cast("int"))
        .groupBy("count", "tile")
        .applyInPandas(_pack, "count int, tile int, fps binary"),
        "tiles",
    )
    # each pair of tiles meets once: the tile with the smaller (count, tile) looks for the others
    pairs = (
        packed.select("count", "tile")
        .withColumn("count2", F.explode(F.sequence("count", F.col("count") + radius)))
        .withColumn("n2", number[F.col("count2")] if tiles else F.lit(None).cast("int"))
        .where("n2 is not null")
        .withColumn("tile2", F.explode(F.sequence(F.lit(0), F.col("n2") - 1)))
        .where("count2 > count or tile2 >= tile")
        .select("count", "tile", "count2", F.col("tile2").cast("int").alias("tile2"))
    )
    other = packed.select(F.col("count").alias("count2"), F.col("tile").alias("tile2"), F.col("fps").alias("other"))
    met = (
        pairs.join(packed, ["count", "tile"])
        .join(other, ["count2", "tile2"])
        .withColumn("other", F.when((F.col("count") == F.col("count2")) & (F.col("tile") == F.col("tile2")), None).otherwise(F.col("other")))
    )
    spread = met.repartition(F.xxhash64("count", "tile", "count2", "tile2"))
    return spread.select("fps", "other").mapInPandas(partial(_compare, radius=radius), "a bigint, b bigint")


def _classes(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int
) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, fp) per row, and (fp, root) with one root for each class."""
    marked = kept_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = marked.select("fp").distinct()
    roots = components(links(distinct, radius)).select(F.col("node").alias("fp"), "root")
    return marked, distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id that is reachable)."""
    marked, classes = _classes(docs, id_col, text_col, shingle, radius)
    first = marked.groupBy("fp").agg(F.min("id").alias("first_id"))
    classes = kept_table(classes.join(first, "fp"), "classes")
    named = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = classes.join(named, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of ``docs``, with all columns, for each class: the one with the smallest id.

    Of several rows with that id, the one with the smallest hash of its text stays, once. A row
    without id stays only if its class has no id at all.
    """
    columns = docs.columns
    marked, classes = _classes(docs, id_col, text_col, shingle, radius)
    first = (
        marked.join(classes, "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "text_hash")).alias("first"))
        .select(F.col("first.id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    )
    # a row is carried as one value, so that its columns may have any name
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))
    own = F.col("row").getField(id_col).alias("own_id"), F.xxhash64(filled(F.col("row").getField(text_col))).alias("own_hash")
    hashed = whole.select("row", *own)
    same = F.col("own_id").eqNullSafe(F.col("first_id")) & (F.col("own_hash") == F.col("first_hash"))
    kept = hashed.join(first, same).dropDuplicates(["first_id", "first_hash"])
    return kept.select(*(F.col("row").getField(c).alias(c) for c in columns))
