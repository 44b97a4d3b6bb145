"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pre-tokens of a batch are encoded together. Their bytes form one linked list, broken at
pre-token ends. A queue holds a bucket of list positions for each merge rank; a three-level bitmap
finds the lowest rank that has a bucket by find-first-set. All positions of a bucket merge at once,
and positions whose pair has changed meanwhile are skipped as stale. Work grows with the number of
merges, not with the square of a pre-token's length. Batches hold less than 2 ** 31 bytes.

Merging a bucket at once equals merging its leftmost pair first, except for the ranks whose new
token can start a merge of a still lower rank; for those, one position per pre-token is taken.

Texts are split at spaces between other characters, where every match of the pattern ends, and
each distinct piece of a batch is matched and encoded once.

Defined results: a null text counts as empty and has no ids. Ids may be null or repeated; rows are
independent of each other. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, fields
from functools import partial
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import Shared, filled, releasing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
NO_RANK = 1 << 18  # ranks are below: three bitmap levels of 64
PIECES = 1 << 21  # distinct pieces a task remembers before it starts afresh
LEARNED = 5 << 20  # bytes of text whose new pieces are encoded together; takes some 30 bytes for each
SLICE = 1 << 20  # characters turned into ids at once
# White space besides the blank and the line feed, by Unicode or by Python.
RARE_ASCII = [chr(c) for c in (*range(9, 10), *range(11, 14), *range(28, 32))]
RARE_SPACES = [*RARE_ASCII, *map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]


@dataclass(frozen=True)
class Merges:
    """A rank file as sorted arrays: pairs of ranks and the rank of what they merge into."""

    tokens: list[bytes]  # by rank
    single: np.ndarray  # rank of each byte
    pairs: np.ndarray  # left * NO_RANK + right, ascending
    ranks: np.ndarray  # of the merged tokens
    stepwise: frozenset[int]  # ranks that merge one position per pre-token at a time

    @staticmethod
    def read(path: str) -> Merges:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(ranks.values()) + 1)
        pairs, merged = [], []
        for token, rank in ranks.items():
            tokens[rank] = token
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left * NO_RANK + right)
                    merged.append(rank)
        order = np.argsort(np.array(pairs, dtype=np.int64))
        keys, values = np.array(pairs, dtype=np.int64)[order], np.array(merged, dtype=np.int64)[order]
        left, right = keys // NO_RANK, keys % NO_RANK
        stepwise = frozenset(left[values < left].tolist()) | frozenset(right[values < right].tolist())
        single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        return Merges(tokens, single, keys, values, stepwise)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * NO_RANK + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.ranks[at], NO_RANK)


class RankQueue:
    """Buckets of positions by rank; a bitmap of three levels knows which ranks have one."""

    def __init__(self, positions: np.ndarray, ranks: np.ndarray):
        self.top, self.middle, self.leaf = 0, [0] * 64, [0] * 4096
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        found, starts = np.unique(ranks, return_index=True)
        parts = np.split(positions, starts[1:]) if len(found) else []
        self.first = dict(zip(found.tolist(), parts, strict=True))
        self.later: dict[int, list[int]] = {}
        for rank in self.first:
            self._mark(rank)

    def _mark(self, rank: int) -> None:
        self.leaf[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << ((rank >> 6) & 63)
        self.top |= 1 << (rank >> 12)

    def _clear(self, rank: int) -> None:
        self.leaf[rank >> 6] &= ~(1 << (rank & 63))
        if not self.leaf[rank >> 6]:
            self.middle[rank >> 12] &= ~(1 << ((rank >> 6) & 63))
            if not self.middle[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        later = self.later
        for rank, position in zip(ranks.tolist(), positions.tolist(), strict=True):
            bucket = later.get(rank)
            if bucket is None:
                later[rank] = [position]
                self._mark(rank)
            else:
                bucket.append(position)

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank and its positions in ascending order, each once."""
        high = (self.top & -self.top).bit_length() - 1
        word = self.middle[high]
        middle = high << 6 | (word & -word).bit_length() - 1
        word = self.leaf[middle]
        rank = middle << 6 | (word & -word).bit_length() - 1
        self._clear(rank)
        positions, later = self.first.pop(rank, None), self.later.pop(rank, None)
        if later is None:
            return rank, positions  # in order, as it was filled
        if positions is not None:
            later.extend(positions.tolist())
        return rank, np.unique(np.array(later, dtype=np.int64))


def merge_all(data: bytes, starts: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pre-tokens of ``data``, which begin at ``starts``, and how many each has."""
    n = len(data)
    token = merges.single[np.frombuffer(data, dtype=np.uint8)]
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)  # n: no neighbour
    ends = np.append(starts[1:], n)
    after[ends - 1] = n
    before[starts] = n
    piece = np.repeat(np.arange(len(starts), dtype=np.int32), ends - starts)
    rank = np.full(n + 1, NO_RANK, dtype=np.int32)  # of the pair that starts here; NO_RANK also where a token has gone
    paired = np.flatnonzero(after[:n] < n).astype(np.int32)
    rank[paired] = merges.rank_of(token[paired], token[paired + 1])
    paired = paired[rank[paired] < NO_RANK]
    token, alive = np.append(token, np.int32(0)), np.ones(n, dtype=bool)
    queue = RankQueue(paired, rank[paired])
    while queue.top:
        r, at = queue.pop()
        at = at[rank[at] == r]
        if not len(at):
            continue
        if r in merges.stepwise and len(at) > 1:
            leftmost = np.append(True, piece[at[1:]] != piece[at[:-1]])
            if not leftmost.all():
                rest = at[~leftmost]
                queue.push(rest, np.full(len(rest), r))
                at = at[leftmost]
        right = after[at]
        chained = np.append(False, right[:-1] == at[1:])
        if chained.any():  # of overlapping pairs, every other one from the left
            index = np.arange(len(at))
            run = np.maximum.accumulate(np.where(chained, 0, index))
            at = at[(index - run) % 2 == 0]
            right = after[at]
        beyond = after[right]
        token[at] = r
        after[at] = beyond
        before[beyond] = at
        alive[right] = False
        rank[right] = NO_RANK
        left = before[at]
        changed = np.concatenate([at, left[left < n]])
        following = after[changed]
        new = np.where(following < n, merges.rank_of(token[changed], token[following]), NO_RANK)
        rank[changed] = new
        has = new < NO_RANK
        queue.push(changed[has], new[has])
    counts = np.bincount(piece[alive], minlength=len(starts))
    return token[:n][alive], counts


class Encoder:
    """Ids of texts; remembers the pieces of a batch of texts."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.matches = merges, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.whole: dict[str, int] = {}  # pieces as they are
        self.spaced: dict[str, int] = {}  # pieces after a space
        self.ids = [np.empty(0, dtype=np.int32)]
        self.counts = [np.empty(0, dtype=np.int64)]

    def split(self, text: str) -> tuple[list[str], list[str]]:
        """Pieces of the text that no match of the pattern crosses, and pieces that follow, each after a space."""
        if not text:
            return [], []
        if text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text or has_rare_space(text):
            return self.matches(text), []
        parts = text.split(" ")
        return parts[:1], parts[1:]

    def learn(self, texts: Iterable[str]) -> None:
        if len(self.whole) + len(self.spaced) > PIECES:
            self._forget()
        whole: set[str] = set()
        spaced: set[str] = set()
        for text in texts:
            head, tail = self.split(text)
            whole.update(head)
            spaced.update(tail)
        whole -= self.whole.keys()
        spaced -= self.spaced.keys()
        n, known = len(whole) + len(spaced), len(self.whole) + len(self.spaced)
        if not n:
            return
        matched = [self.matches(p) for p in whole]
        matched += map(self.matches, map(" ".__add__, spaced))
        self.whole.update(zip(whole, range(known, known + len(whole)), strict=True))
        self.spaced.update(zip(spaced, range(known + len(whole), known + n), strict=True))
        per_piece = np.fromiter(map(len, matched), dtype=np.int64, count=n)
        flat = list(chain.from_iterable(matched))
        del matched
        distinct = dict.fromkeys(flat)
        distinct.update(zip(distinct, range(len(distinct)), strict=True))
        order = np.fromiter(map(distinct.__getitem__, flat), dtype=np.int64, count=len(flat))
        data = list(map(str.encode, distinct))
        lengths = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        ids, counts = merge_all(b"".join(data), np.cumsum(lengths) - lengths, self.merges)
        ids, lengths = gather(ids, counts, order)
        sizes = np.bincount(np.repeat(np.arange(n), per_piece), weights=lengths, minlength=n).astype(np.int64)
        self.ids = [np.concatenate([*self.ids, ids.astype(np.int32)])]
        self.counts = [np.concatenate([*self.counts, sizes])]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each text has; their pieces must have been learned."""
        whole, spaced, found, sizes = self.whole.__getitem__, self.spaced.__getitem__, [], []
        for text in texts:
            head, tail = self.split(text)
            found.extend(map(whole, head))
            found.extend(map(spaced, tail))
            sizes.append(len(head) + len(tail))
        order = np.array(found, dtype=np.int64)
        ids, lengths = gather(self.ids[0], self.counts[0], order)
        owner = np.repeat(np.arange(len(texts)), sizes)
        return ids, np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)


def has_rare_space(text: str) -> bool:
    """Whether white space other than blanks and line feeds is there."""
    return any(map(text.__contains__, RARE_ASCII if text.isascii() else RARE_SPACES))


def gather(values: np.ndarray, counts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values``, of the given counts, in a new order; with their lengths."""
    starts, lengths = (np.cumsum(counts) - counts)[order], counts[order]
    shift = starts - (np.cumsum(lengths) - lengths)
    return values[np.repeat(shift, lengths) + np.arange(lengths.sum())], lengths


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose sizes add up to about the limit."""
    start = total = end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield start, end
            start, total = end, 0
    if start < end:
        yield start, end


def encoded(batches: Iterator[pa.RecordBatch], merges: Shared, pattern: str) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, ids)."""
    encoder = Encoder(merges.value, pattern)
    for batch in batches:
        for first, last in slices(pc.binary_length(batch.column("text")).to_pylist(), LEARNED):
            ids_column = batch.column("id").slice(first, last - first)
            texts = batch.column("text").slice(first, last - first).to_pylist()
            encoder.learn(texts)
            for start, end in slices(map(len, texts), SLICE):
                ids, counts = encoder.encode(texts[start:end])
                offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([ids_column.slice(start, end - start), lists], names=["id", "ids"])


def id_lists(ids: pa.Array) -> Iterator[list[int]]:
    flat, ends = ids.flatten().to_numpy().tolist(), np.cumsum(ids.value_lengths().fill_null(0).to_numpy()).tolist()
    return (flat[start:end] for start, end in zip([0, *ends], ends, strict=False))


def decoded(batches: Iterator[pa.RecordBatch], merges: Shared) -> Iterator[pa.RecordBatch]:
    """(id, ids) to (id, ids, bytes)."""
    token = merges.value.tokens.__getitem__
    for batch in batches:
        data = [b"".join(map(token, ids)) for ids in id_lists(batch.column("ids"))]
        columns = [batch.column("id"), batch.column("ids"), pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "bytes"])


def _digests(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    decimal = [str(i) for i in range(top)].__getitem__
    for batch in batches:
        rows = [], [], []
        for ids, data in zip(id_lists(batch.column("ids")), batch.column("bytes").to_pylist(), strict=True):
            rows[0].append(len(ids))
            rows[1].append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
            rows[2].append(hashlib.sha256(data).hexdigest())
        columns = [batch.column("id"), pa.array(rows[0], pa.int64()), *(pa.array(r, pa.string()) for r in rows[1:])]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _given(df: DataFrame, id_col: str, column) -> tuple[DataFrame, str]:
    given = df.select(F.col(id_col).alias("id"), column)
    return given, given.schema["id"].dataType.simpleString()


def _shared(df: DataFrame, path: str) -> Shared:
    merges = Merges.read(path)
    return Shared(df.sparkSession, Merges, *(getattr(merges, f.name) for f in fields(merges)))  # as large as the rank file


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, pattern: str = PATTERN
) -> DataFrame:
    """(id, ids array<int>) for every row."""
    given, kind = _given(docs, id_col, filled(F.col(text_col)).alias("text"))
    run: Callable = partial(encoded, merges=_shared(docs, path), pattern=pattern)
    return given.mapInArrow(releasing(run), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(ids: DataFrame, id_col: str = "doc_id", path: str = VOCABULARY) -> DataFrame:
    """(id, text) for every row of (id, ids); null ids count as none."""
    given, kind = _given(ids, id_col, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    run: Callable = partial(decoded, merges=_shared(ids, path))
    found = given.mapInArrow(releasing(run), f"id {kind}, ids array<int>, bytes binary")
    return found.select(F.col("id").alias(id_col), F.decode("bytes", "UTF-8").alias("text"))


def round_trip(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, pattern: str = PATTERN
) -> DataFrame:
    """Encodes, decodes and digests every row in one pass: id, n_tokens, ids_sha256, decoded_sha256."""
    given, kind = _given(docs, id_col, filled(F.col(text_col)).alias("text"))
    merges = _shared(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digests(decoded(encoded(batches, merges, pattern), merges), len(merges.value.tokens))

    found = given.mapInArrow(releasing(run), f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("id", id_col)
