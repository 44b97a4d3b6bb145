"""Benchmark decontamination with an FM-index for each training shard.

Words of the benchmark are symbols, every other word is a break. Stretches of document words between
breaks that are shorter than the shortest window cannot hold one and are left out; what remains of a
shard's documents is indexed: suffix array, Burrows-Wheeler transform, a wavelet tree for ranks and
every ``SAMPLED``-th text position. All windows of the benchmark are searched backward together, their
occurrences are located by stepping to sampled positions, and covered words are merged per document.

A shard is at most ``SHARD`` indexed words (and one document); tasks hold one shard at a time and
documents never move. The benchmark is read in blocks of at most ``BLOCK`` windows, each of which is
broadcast and searched in a pass of its own over the documents, so that the broadcast is bounded; the
passes are chained and hand a bit for each word and the items found on to the next.

Words are compared whole, so there are no false hits. Defined results: null and empty texts have no
words; items without words have no window; items that agree in id and windows count once, items without id
count as hits but not as items. Rows are independent, so ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import Shared, filled, releasing

WINDOW = 10
SHARD = 1 << 20
SAMPLED = 8
BLOCK = 50_000

# digits, a-z after lower-casing, and every byte of a character beyond ASCII
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())  # for bytes: A-Z only


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling."""
    n = len(symbols)
    rank, step = np.unique(symbols, return_inverse=True)[1].astype(np.int64), 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        fresh = np.append(0, np.cumsum(key[order[1:]] != key[order[:-1]]))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletTree:
    """Ranks of symbols in a sequence: a bit vector with running counts for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[np.ndarray, int]] = []  # running count of ones, number of zeros
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            running = np.append(0, np.cumsum(ones, dtype=np.int32)).astype(np.int32)
            self.levels.append((running, len(symbols) - int(running[-1])))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its end."""
        start = np.zeros_like(end)
        for level, (ones, zeros) in enumerate(self.levels):
            one = (symbol >> (len(self.levels) - 1 - level)) & 1
            start = np.where(one, zeros + ones[start], start - ones[start])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        symbol, start, place = np.zeros_like(at), np.zeros_like(at), at
        for ones, zeros in self.levels:
            one = ones[place + 1] - ones[place]
            symbol = symbol << 1 | one
            start = np.where(one, zeros + ones[start], start - ones[start])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return symbol, place - start


class FMIndex:
    """Backward search and location over a sequence of symbols from 1 to ``top``."""

    def __init__(self, symbols: np.ndarray, top: int):
        text = np.append(symbols, 0)  # the end is smaller than every symbol
        self.n = len(text)
        order = suffix_array(text)
        bwt = text[order - 1]
        self.before = np.append(0, np.cumsum(np.bincount(text, minlength=top + 1)))
        self.tree = WaveletTree(bwt.astype(np.int64), max(1, int(top).bit_length()))
        marked = order % SAMPLED == 0
        self.marks = np.append(0, np.cumsum(marked))
        self.samples = order[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that start with each pattern; patterns end at the last column."""
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n, dtype=np.int64)
        for step in range(1, patterns.shape[1] + 1):
            todo = np.flatnonzero((lengths >= step) & (low < high))
            if not len(todo):
                break
            symbol = patterns[todo, -step]
            base = self.before[symbol]
            low[todo] = base + self.tree.rank(symbol, low[todo])
            high[todo] = base + self.tree.rank(symbol, high[todo])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        found, steps, open_ = np.empty(len(rows), dtype=np.int64), 0, np.arange(len(rows))
        while len(open_):
            sampled = self.marks[rows + 1] > self.marks[rows]
            found[open_[sampled]] = self.samples[self.marks[rows[sampled]]] + steps
            open_, rows = open_[~sampled], rows[~sampled]
            symbol, rank = self.tree.symbol_and_rank(rows)
            rows, steps = self.before[symbol] + rank, steps + 1
        return found


@dataclass
class Windows:
    """One block of the benchmark."""

    vocabulary: dict[bytes, int]  # word to symbol, from 1
    patterns: np.ndarray  # one distinct window a row, aligned to the right
    lengths: np.ndarray
    items: list[list[str]]  # ids of the items that have the window

    @staticmethod
    def of(found: dict[tuple[bytes, ...], set[str]]) -> Windows:
        vocabulary: dict[bytes, int] = {}
        for window in found:
            for word in window:
                vocabulary.setdefault(word, len(vocabulary) + 1)
        lengths = np.array([len(w) for w in found], dtype=np.int64)
        patterns = np.zeros((len(found), int(lengths.max(initial=0))), dtype=np.int64)
        for row, window in enumerate(found):
            patterns[row, patterns.shape[1] - len(window) :] = [vocabulary[w] for w in window]
        return Windows(vocabulary, patterns, lengths, [sorted(ids) for ids in found.values()])


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[Windows]:
    """The windows of all items, a block at a time; an item's windows share a block unless they overflow it."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), filled(F.col(text_col)).alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(row["text"])
        for start in range(max(1, len(words) - window + 1) if words else 0):
            items = found.setdefault(tuple(words[start : start + window]), set())
            if row["id"] is not None:
                items.add(row["id"])
            if len(found) >= BLOCK:
                yield Windows.of(found)
                found = {}
    if found:
        yield Windows.of(found)


def _search(shard: list[np.ndarray], windows: Windows) -> list[tuple[np.ndarray, set[str]]]:
    """Covered words, as flags, and items found, for each document of a shard (symbols, 0 for other words)."""
    lengths = np.array([len(s) for s in shard], dtype=np.int64)
    symbols = np.concatenate([np.empty(0, dtype=np.int64), *shard])
    doc = np.repeat(np.arange(len(shard)), lengths)
    shortest = int(windows.lengths.min())
    # stretches of known words of one document
    known = symbols > 0
    first = known & np.append(True, ~known[:-1] | (doc[1:] != doc[:-1]))[: len(known)]
    stretch = np.cumsum(first) - 1
    sizes = np.bincount(stretch[known], minlength=int(first.sum()))
    long = np.zeros(len(symbols), dtype=bool)
    long[known] = sizes[stretch[known]] >= shortest
    place = np.flatnonzero(long)
    cover = np.zeros(len(symbols) + 1, dtype=np.int64)
    items: list[set[str]] = [set() for _ in shard]
    if len(place):
        # a break, symbol 1, before each stretch; words move up by one
        breaks = np.flatnonzero(first[place])
        text = np.insert(symbols[place] + 1, breaks, 1)
        origin = np.insert(place, breaks, -1)
        index = FMIndex(text, len(windows.vocabulary) + 1)
        patterns = np.where(windows.patterns > 0, windows.patterns + 1, 0)
        low, high = index.search(patterns, windows.lengths)
        hit = np.flatnonzero(high > low)
        count = (high - low)[hit]
        rows = np.repeat(low[hit] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        window = np.repeat(hit, count)
        start = origin[index.locate(rows)]
        np.add.at(cover, start, 1)
        np.add.at(cover, start + windows.lengths[window], -1)
        pairs = np.unique(np.stack([doc[start], window]), axis=1)
        for d, w in pairs.T.tolist():
            items[d].update(windows.items[w])
    flags = np.split(np.cumsum(cover[:-1]) > 0, np.cumsum(lengths)[:-1]) if len(shard) else []
    return list(zip(flags, items, strict=True))


def _found(batches: Iterator[pa.RecordBatch], windows) -> Iterator[pa.RecordBatch]:
    """Adds a block's findings to the columns hit (a bit for each word) and items."""
    windows = windows.value
    symbol = windows.vocabulary.get
    for batch in batches:
        texts, hits, items = (batch.column(c) for c in ("text", "hit", "items"))
        start = 0
        while start < batch.num_rows:
            shard, size, end = [], 0, start
            while end < batch.num_rows and size < SHARD:
                words = words_of(texts[end].as_py())
                shard.append(np.fromiter((symbol(w, 0) for w in words), dtype=np.int64, count=len(words)))
                size, end = size + len(words), end + 1
            new_hits, new_items = [], []
            for i, (flags, found) in enumerate(_search(shard, windows), start):
                bits, earlier = np.packbits(flags), hits[i].as_py()
                if earlier is not None:
                    bits |= np.frombuffer(earlier, dtype=np.uint8)
                new_hits.append(bits.tobytes())
                new_items.append(sorted(found.union(items[i].as_py() or ())))
            part = batch.slice(start, end - start)
            kept = {n: part.column(n) for n in part.schema.names if n not in ("hit", "items")}
            kept |= {"hit": pa.array(new_hits, pa.binary()), "items": pa.array(new_items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict({n: kept[n] for n in part.schema.names})
            start = end


def _passes(
    docs: DataFrame, benchmark: DataFrame, finish: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
    id_col: str, text_col: str, item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """A pass over the documents for each block of the benchmark; the last one also finishes the rows.

    ``schema`` names the columns that the finished rows have after the id.
    """
    found = docs.select(
        F.col(id_col).alias("id"), filled(F.col(text_col)).alias("text"),
        F.lit(None).cast("binary").alias("hit"), F.lit(None).cast("array<string>").alias("items"),
    )
    between, search = found.schema, None
    for block in blocks(benchmark, item_col, item_text_col, window):
        if search:
            found = found.mapInArrow(releasing(search), between)
        shared = Shared(docs.sparkSession, Windows, *(getattr(block, f.name) for f in fields(block)))  # BLOCK windows at most
        search = partial(_found, windows=shared)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return finish(search(batches) if search else batches)

    return found.mapInArrow(releasing(last), T.StructType([found.schema["id"], *T.StructType.fromDDL(schema).fields]))


def find_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, text, hit, items) for every row: a bit for each word, from the highest of each byte, and item ids."""
    schema = "text string, hit binary, items array<string>"
    return _passes(docs, benchmark, lambda batches: batches, schema, id_col, text_col, **options)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[], [], [], [], []]
        hits, items = batch.column("hit").to_pylist(), batch.column("items").to_pylist()
        for text, hit, found in zip(batch.column("text").to_pylist(), hits, items, strict=True):
            n_hit = int(np.bitwise_count(np.frombuffer(hit or b"", dtype=np.uint8)).sum())
            joined = ",".join(sorted(found or ()))
            values = (len(words_of(text)), n_hit, len(found or ()), hashlib.sha256(joined.encode()).hexdigest(), n_hit > 0)
            for column, value in zip(rows, values, strict=True):
                column.append(value)
        columns = [batch.column("id"), *(pa.array(r, pa.int64()) for r in rows[:3]), pa.array(rows[3], pa.string()), pa.array(rows[4], pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Counts and a digest of the items for every row: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    schema = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    found = _passes(docs, benchmark, _digests, schema, id_col, text_col, **options)
    return found.withColumnRenamed("id", id_col)


def remove_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns and rows, with every covered word cut from the text.

    A run of covered words goes with what stands between them and the blanks after it; a text
    without hits stays as it is, a null stays null.
    """
    columns = docs.columns
    # a row is carried as one value, so that its columns may have any name
    row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row")
    whole = docs.select(row, F.col(f"`{text_col}`").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cleaned = []
            for text, hit in zip(batch.column("text").to_pylist(), batch.column("hit").to_pylist(), strict=True):
                cleaned.append(cut_words(text, hit) if hit and any(hit) else None)
            columns = [batch.column("id"), pa.array(cleaned, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cleaned"])

    kept = _passes(whole, benchmark, cut, "cleaned string", "row", "text", **options)
    values = {c: F.col("id").getField(c) for c in columns}
    values[text_col] = F.coalesce("cleaned", values[text_col])
    return kept.select(*(value.alias(c) for c, value in values.items()))


def cut_words(text: str, hit: bytes) -> str:
    data = text.encode("utf-8", "surrogatepass")
    flags = np.unpackbits(np.frombuffer(hit, dtype=np.uint8))
    out, at, run = [], 0, None
    for i, match in enumerate(WORD.finditer(data.lower())):
        if flags[i]:
            if run is None:
                out.append(data[at : match.start()])
            run = at = match.end()
        elif run is not None:
            gap = data[run : match.start()]
            at, run = run + len(gap) - len(gap.lstrip()), None
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")
