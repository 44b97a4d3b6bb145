"""Fill-in-middle transformation: two cuts a text, found on a wavelet matrix over character classes.

The UTF-8 bytes of a stretch of texts are mapped to eight classes: a letter inside a run, a trailing byte of a
character, the first letter of a run, and five kinds of characters that stand alone. A wavelet matrix over the
classes answers how often a class occurs before a place. A byte that starts a unit is one that is neither inside a
run nor trailing, so the units begun before a place are the place less two ranks; characters are counted in the same
way. Both cuts of all texts of a stretch are located together by bisection on these counts, nothing is split into
units, and no text is decoded.

Units are tokens ``[A-Za-z]+|[^A-Za-z]``, or single characters. Cuts, form and order come from the hash of seed and
id alone, so a rerun or a lost executor changes nothing. A stretch holds ``STRETCH`` bytes, or one text.

Defined results: a null text counts as empty and stays plain; a null id is hashed as an empty string. Rows are
independent, so ids may repeat, and an empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import filled, releasing

SEED = 1
CUT_PERCENT = 90  # of texts that are cut at all
SPM_PERCENT = 20  # of those, texts whose suffix comes first
STRETCH = 4 << 20

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))

INSIDE, TRAIL, START, BREAK, BLANK, DIGIT, SIGN, WIDE = range(8)
BITS = 3
# classes that continue a unit instead of starting one
CONTINUES = {"token": (INSIDE, TRAIL), "character": (TRAIL,)}


def _class_of_byte() -> np.ndarray:
    table = np.full(256, SIGN, dtype=np.uint8)
    for first, last, kind in ((65, 90, START), (97, 122, START), (48, 57, DIGIT), (9, 13, BLANK), (32, 32, BLANK),
                              (10, 10, BREAK), (128, 191, TRAIL), (192, 255, WIDE)):
        table[first : last + 1] = kind
    return table


class BitVector:
    """Bits in words of 64 with the ones counted before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(packed) // 8 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, end: np.ndarray) -> np.ndarray:
        """How many ones stand before each end."""
        word, bit = end >> 6, (end & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """A bit vector for each bit of the symbols, from the highest; zeros go before ones on the next level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[BitVector] = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            self.levels.append(BitVector(ones))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, end: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each end."""
        start = np.zeros(1, dtype=np.int64)
        for level, bits in enumerate(self.levels):
            if symbol >> (len(self.levels) - 1 - level) & 1:
                start, end = bits.zeros + bits.rank(start), bits.zeros + bits.rank(end)
            else:
                start, end = start - bits.rank(start), end - bits.rank(end)
        return end - start


class Classes:
    """The classes of the bytes of several texts, one behind the other."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str = "token"):
        kinds = _class_of_byte()[data]
        letter = kinds == START
        inside = letter.copy()
        inside[1:] &= letter[:-1]
        inside[offsets[:-1][offsets[:-1] < len(data)]] = False  # a text's first letter
        kinds[inside] = INSIDE
        self.matrix, self.continues = WaveletMatrix(kinds, BITS), CONTINUES[unit]

    def units(self, end: np.ndarray) -> np.ndarray:
        """How many units start before each end."""
        return end - sum(self.matrix.rank(c, end) for c in self.continues)

    def characters(self, end: np.ndarray) -> np.ndarray:
        return end - self.matrix.rank(TRAIL, end)

    def cut(self, start: np.ndarray, end: np.ndarray, units: np.ndarray) -> np.ndarray:
        """The place after so many units of each text: the last one with no more of them before it."""
        low, high, wanted = start.copy(), end.copy(), self.units(start) + units
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self.units(middle) <= wanted
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def _cut_stretch(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, unit: str, percent: tuple[int, int]) -> list[list]:
    """Columns n, form, prefix_chars, middle_chars and output of texts, given four drawn numbers for each."""
    classes, (start, end) = Classes(data, offsets, unit), (offsets[:-1], offsets[1:])
    n = classes.units(end) - classes.units(start)
    a, b = draws[0] % (n + 1), draws[1] % (n + 1)
    first, second = classes.cut(start, end, np.minimum(a, b)), classes.cut(start, end, np.maximum(a, b))
    prefix = classes.characters(first) - classes.characters(start)
    middle = classes.characters(second) - classes.characters(first)
    whole, plain, spm = data.tobytes(), draws[2] % 100 >= percent[0], draws[3] % 100 < percent[1]
    columns: list[list] = [n.tolist(), [], [], [], []]
    mark_p, mark_s, mark_m = MARKS
    for i in range(len(n)):
        s, f, t, e = int(start[i]), int(first[i]), int(second[i]), int(end[i])
        text = whole[s:e]
        if plain[i] or not text or any(m in text for m in MARKS):
            row = ("plain", None, None, text)
        else:
            head, tail = mark_p + whole[s:f], mark_s + whole[t:e]
            order = (tail, head) if spm[i] else (head, tail)
            row = ("spm" if spm[i] else "psm", int(prefix[i]), int(middle[i]), b"".join((*order, mark_m, whole[f:t])))
        for column, value in zip(columns[1:], row, strict=True):
            column.append(value)
    return columns


def _transformed(batches: Iterator[pa.RecordBatch], unit: str, percent: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        draws = np.stack([batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)])
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        at = 0
        while at < len(texts):
            # as many texts as fit a stretch, one at least
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STRETCH, "right")) - 1)
            own = offsets[at : to + 1]
            columns = _cut_stretch(data[own[0] : own[-1]], own - own[0], draws[:, at:to], unit, percent)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            arrays[4] = arrays[4].cast(pa.string())
            names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, to - at), *arrays], names=names)
            at = to


def _draw(id_col: Column, seed: int, number: int) -> Column:
    """The number-th group of eight digits of the hash of seed and id, unsigned."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, unit: str = "token",
    cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for every row; form is plain, psm or spm.

    ``n`` counts the units. A text that is empty or holds a mark stays plain, as it could not be told apart later.
    """
    own = F.col(f"`{id_col}`")
    given = docs.select(
        own.alias("id"), filled(F.col(f"`{text_col}`")).alias("text"), *(_draw(own, seed, i).alias(f"h{i}") for i in (1, 2, 3, 4))
    )
    kind = given.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    run = partial(_transformed, unit=unit, percent=(cut_percent, spm_percent))
    return given.mapInArrow(releasing(run), schema).withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text that was transformed, exactly."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)  # the marks stand where they were put, nowhere else
    psm, spm = (F.concat(*(F.get(parts, F.lit(i)) for i in order)) for order in ((1, 3, 2), (2, 3, 1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Counts, form and digests of the output and of the text restored from it, for every row."""
    found = transform(docs, id_col, text_col, **options)
    return found.select(
        F.col(f"`{id_col}`"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
