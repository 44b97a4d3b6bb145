"""Importance resampling towards a target: hashed n-grams of corpus and target, weights, a drawn share.

The texts of a batch are joined with a sentinel between them. One regular expression finds all words of the joined
bytes; the texts' offsets, searched for the words' places, tell each word's text, and a run of words is a feature only
where its first and last word have the same one. Checksums of runs are computed for all places at once: the checksum
of two strings in a row is linear in that of the first, so a table lookup shifts it past the second one's length.
Buckets are then counted, or their gains summed by text, with ``bincount``. Words are handled ``BLOCK`` at a time with
the last two carried over, so memory stays bounded for a text of any length.

Two passes read the corpus: the first sums the buckets' counts (``BUCKETS`` numbers a task), the second weighs each
text by the gains. Drawn are the highest sums of weight and Gumbel noise, which amounts to drawing without
replacement by importance; the noise comes from a hash of seed and id. Ranks are counted over sorted ranges: only the
ranges that can hold drawn rows are numbered, and the driver sees a row for each range.

Defined results: null and empty texts have no features and weight 0. A null id is hashed as an empty string and comes last
among ties; rows that agree in id and text are drawn as rows of their own. Too few eligible rows draw
nothing, an empty table gives an empty result, an empty target is one without features. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import filled, kept_table, releasing

BUCKETS = 10_000
LONGEST = 3  # words in a run
SEED = 42
PERCENT = 5  # of the eligible documents are drawn
LEAST_WORDS = 20
SCALE = 1000
BLOCK = 1 << 18
JOINED = 4 << 20  # bytes of text joined at once, or one text

SENTINEL = b"\x00"
# digits, a-z after lower-casing, and every byte of a character beyond ASCII
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Shift:
    """What a checksum becomes when so many zero bytes follow: linear, so four tables of 256 for each length."""

    DIRECT = 64  # longer words go by powers of two

    def __init__(self):
        one = np.array([zlib.crc32(bytes([b])) for b in range(256)], dtype=np.uint32)
        self.step = one ^ one[0]  # effect of the byte that leaves, without the complements
        shifted = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        self.direct = [shifted]
        for _ in range(self.DIRECT - 1):
            shifted = self._zero(shifted)
            self.direct.append(shifted)
        self.direct = np.stack(self.direct)
        self.powers = [self._zero(shifted)]  # of DIRECT, 2 * DIRECT, ... zero bytes

    def _zero(self, crc: np.ndarray) -> np.ndarray:
        return self.step[crc & np.uint32(255)] ^ (crc >> np.uint32(8))

    def zero(self, crc: np.ndarray) -> np.ndarray:
        """Followed by one zero byte."""
        return self._zero(crc)

    def __call__(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        low = (lengths % self.DIRECT).astype(np.int64) * 1024
        flat, out = self.direct.ravel(), np.zeros(len(crc), dtype=np.uint32)
        for k in range(4):
            out ^= flat[low + 256 * k + ((crc >> np.uint32(8 * k)) & np.uint32(255))]
        rest, power = lengths // self.DIRECT, 0
        while rest.any():
            if power == len(self.powers):
                table = self.powers[-1]
                self.powers.append(self._apply(table, table))
            odd = np.flatnonzero(rest & 1)
            out[odd] = self._apply(self.powers[power], out[odd])
            rest, power = rest >> 1, power + 1
        return out

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = np.zeros(crc.shape, dtype=np.uint32)
        for k in range(4):
            out ^= table[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
        return out


def features(texts: list[bytes], shift: Shift, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (text of each new word, text of each feature, checksum of each feature), in the order of the texts."""
    joined = SENTINEL.join(texts).lower()  # for bytes: A-Z only
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    blank = np.uint32(zlib.crc32(b" "))
    found = ((m.start(), m.end(), zlib.crc32(m[0])) for m in WORD.finditer(joined))
    carried = np.empty((0, 3), dtype=np.int64)
    while True:
        words = np.fromiter(chain.from_iterable(islice(found, BLOCK)), dtype=np.int64).reshape(-1, 3)
        if not len(words):
            return
        fresh = len(carried)  # runs that end before it are known
        words = np.concatenate([carried, words])
        owner = np.searchsorted(offsets, words[:, 0], "right") - 1
        lengths, single = words[:, 1] - words[:, 0], words[:, 2].astype(np.uint32)
        owners, sums, run = [owner[fresh:]], [single[fresh:]], single
        for n in range(1, longest):
            run = shift(shift.zero(run[:-1]) ^ blank, lengths[n:]) ^ single[n:]  # of n + 1 words
            last = np.arange(n, len(words))
            whole = (last >= fresh) & (owner[last] == owner[: len(words) - n])
            owners.append(owner[last[whole]])
            sums.append(run[whole])
        yield owner[fresh:], np.concatenate(owners), np.concatenate(sums)
        carried = words[len(words) - longest + 1 :] if longest > 1 else carried


def _joined(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Slices of the texts that are joined at once."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > JOINED:
            yield start, at
            start, size = at, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    shift, counts = Shift(), np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        for start, end in _joined(texts):
            for _, _, sums in features(texts[start:end], shift):
                counts += np.bincount(sums % np.uint32(buckets), minlength=buckets)
    bucket = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(counts[bucket])], names=["bucket", "n"])


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    found = docs.select(filled(F.col(f"`{text_col}`")).alias("text")).mapInArrow(
        releasing(partial(_counted, buckets=buckets)), "bucket int, n bigint"
    )
    counts = np.zeros(buckets, dtype=np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row for each bucket
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By how much a feature of each bucket speaks for the target, in thousandths, rounded down."""
    total, wanted, n = int(corpus.sum()), int(target.sum()), len(corpus)
    odds = (((t + 1) * (total + n)) / ((s + 1) * (wanted + n)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(SCALE * math.log(o)) for o in odds], dtype=np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], gain) -> Iterator[pa.RecordBatch]:
    shift, table = Shift(), gain.value
    buckets = np.uint32(len(table))
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        words, n_features, weight = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
        for start, end in _joined(texts):
            size = end - start
            for word_owner, owner, sums in features(texts[start:end], shift):
                words[start:end] += np.bincount(word_owner, minlength=size)
                n_features[start:end] += np.bincount(owner, minlength=size)
                # sums of whole numbers far below 2 ** 53
                weight[start:end] += np.bincount(owner, weights=table[sums % buckets], minlength=size).astype(np.int64)
        drawn = batch.column("h").to_pylist()
        noise = [math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296))) for h in drawn]
        score = weight + np.array(noise, dtype=np.int64)
        columns = [pa.array(c) for c in (words, n_features, weight, score)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "n_words", "n_features", "weight", "score"])


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) for every row; the score is the weight and Gumbel noise."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # a number for each bucket
    own = F.col(f"`{id_col}`")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(own.cast("string"), F.lit(""))), 256)
    given = docs.select(
        own.alias("id"), filled(F.col(f"`{text_col}`")).alias("text"), F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("h")
    )
    kind = given.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words bigint, n_features bigint, weight bigint, score bigint"
    return given.mapInArrow(releasing(partial(_weighed, gain=shared)), schema)


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows with their rank by score, from 1, ties by id; null for rows that are not drawn."""
    spark = weighed.sparkSession
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    ranged = weighed.withColumn("eligible", F.col("n_words") >= least_words)
    ranged = ranged.repartitionByRange(F.col("eligible").desc(), *order).withColumn("part", F.spark_partition_id())
    ranged = kept_table(ranged, "importance-ranges")
    counts = ranged.where("eligible").groupBy("part").count().orderBy("part").collect()  # a row for each range
    wanted = sum(c["count"] for c in counts) * percent // 100
    offsets, before = [], 0
    for c in counts:
        if before < wanted:
            offsets.append((c["part"], before))
        before += c["count"]
    plan = F.broadcast(spark.createDataFrame(offsets, "part int, before bigint"))
    rank = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    numbered = ranged.where("eligible").join(plan, "part").withColumn("rank", rank)
    columns = ["id", "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    rest = ranged.where("eligible").join(plan, "part", "left_anti").unionByName(ranged.where("NOT eligible"))
    return numbered.select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")).unionByName(rest.select(*columns, none))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """(id, n_features, weight, score, rank) for every row of ``docs``; drawn rows have a rank."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    # written, as finding the ranges reads the rows once before they are sorted
    weighed = kept_table(weigh(docs, gain, id_col, text_col, seed), "importance-weights")
    found = draw(weighed, percent, least_words)
    return found.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
