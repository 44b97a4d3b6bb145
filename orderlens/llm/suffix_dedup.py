"""Removal of byte strings that an earlier document has, by longest-previous-factor arrays.

Every string of ``LENGTH`` bytes that starts in a document with a smaller id is removed; the first
document keeps it. The suffixes of a corpus fit no single array, so they are split by content: of the
``GRAM``-byte strings within a window of ``LENGTH`` bytes, the one with the smallest hash is its anchor.
Equal windows have equal anchors, and neighbouring windows mostly share theirs, so a run of windows
travels as one string of at most ``2 * LENGTH - GRAM`` bytes.

1. Documents are packed into batches of about ``BATCH`` bytes, written once to the scratch folder.
2. Each batch sends the hashes of its anchors to buckets. Anchors of a single document are settled; a bit
   for each of 2 ** ``BITS`` hash prefixes says which may be shared. It is broadcast, its size is fixed; a
   bit set by chance costs work, not correctness.
3. Each batch sends its distinct strings at shared anchors, with the smallest id that has each, to
   buckets. A bucket sorts the suffixes of its strings, builds common-prefix lengths, finds for every
   suffix the previous and next one of a smaller document in suffix order, and from the two the longest
   previous factor. Windows with a factor of ``LENGTH`` bytes are reported to the batches.
4. Each batch marks, merges and cuts the reported windows.

However often a string occurs, a bucket gets it once from each batch. An anchor with very many
different strings around it would still gather them in one bucket, so anchors with more than
``FREQUENT`` documents (or 1/65536 of all anchors, whichever is more: at most 65536 anchors are
broadcast) send a 96-bit digest of every window by itself, to the bucket of its own hash.

Defined results: a null text counts as empty; ids are whole numbers; a document without id keeps all its
bytes and removes none elsewhere; rows that agree in id do not remove each other's bytes. Further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.byte_bpe import gather
from orderlens.llm.common import Shared, filled, kept_table, releasing

LENGTH = 50
GRAM = 24
BATCH = 3 << 20
BITS = 28
FREQUENT = 60_000
BUCKET = 4 << 20  # bytes of text for each bucket
BUCKETS = 256  # at least
PART = 10_000  # strings in one suffix array, unless an anchor has more
CHUNK = 1 << 20

WINDOW = LENGTH - GRAM + 1  # anchors to choose from; at most so many windows share one
WIDTH = LENGTH + WINDOW - 1  # of the longest string
HASH_BITS = 58
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def _rolled(data: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hashes of all strings of a length, by doubling."""
    part = data.astype(np.uint64) + np.uint64(1)
    have, out, size = 1, None, 0
    while True:
        if length & have:
            if out is None:
                out, size = part, have
            else:
                n = len(out) - have
                out, size = out[:n] * _power(have) + part[size : size + n], size + have
        have *= 2
        if have > length:
            return out
        half = have // 2
        part = part[:-half] * _power(half) + part[half:]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


class Runs(NamedTuple):
    """Runs of windows with one anchor: start, number of windows, hash of the anchor, document."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    doc: np.ndarray


def runs(data: np.ndarray, lengths: np.ndarray) -> Runs:
    """Anchors of all windows of concatenated documents; no window crosses documents."""
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    found = []
    for at in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        piece = data[at : at + CHUNK + LENGTH - 1]
        hashes = _mixed(_rolled(piece, GRAM))
        # the low bits tell the place of the smallest; among equal strings any will do
        low = np.minimum.reduce
        v = (hashes & ~np.uint64(63)) | (np.arange(len(hashes), dtype=np.uint64) & np.uint64(63))
        have = 1
        while 2 * have <= WINDOW:
            v, have = np.minimum(v[:-have], v[have:]), 2 * have
        if have < WINDOW:
            v = low([v[: len(v) - (WINDOW - have)], v[WINDOW - have :]])
        n = min(CHUNK, len(v))
        v, here = v[:n], np.arange(n)
        place = here + ((v.astype(np.int64) - here) & 63)
        doc = owner[at : at + n]
        inside = here + at + LENGTH <= ends[doc]
        begins = inside.copy()
        begins[1:] &= (place[1:] != place[:-1]) | ~inside[:-1] | (doc[1:] != doc[:-1])
        start = np.flatnonzero(begins)
        stop = np.flatnonzero(inside & np.append(~inside[1:] | begins[1:], True))
        found.append(Runs(start + at, stop - start + 1, v[start] >> np.uint64(6), doc[start]))
    empty = np.empty(0, np.int64)
    found.append(Runs(empty, empty, np.empty(0, np.uint64), empty))
    return Runs(*(np.concatenate(c) for c in zip(*found, strict=True)))


def suffix_order(data: np.ndarray, positions: np.ndarray, cap: int) -> np.ndarray:
    """Ranks of suffixes by their first ``cap`` bytes, equal ones alike, by prefix doubling."""
    padded = np.concatenate([data, np.zeros(cap + 8, dtype=np.uint8)]).astype(np.uint64)
    word = padded[: len(data) + cap].copy()
    for step in (1, 2, 4):  # eight bytes, the first one highest
        word = (word[:-step] << np.uint64(8 * step)) | word[step:]
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    have = 8
    while have < cap:
        step = min(have, cap - have)
        key = rank[:-step] * (len(word) + 1) + rank[step:]
        rank, have = np.unique(key, return_inverse=True)[1].astype(np.int64), have + step
    return rank[positions]


def _smaller(docs: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Common prefix with the previous entry of a smaller document, 0 where it is below ``least``."""
    n = len(docs)
    at, length = np.arange(n) - 1, common.copy()
    todo = np.flatnonzero((at >= 0) & (length >= least))
    length[(at < 0) | (length < least)] = 0
    while len(todo):
        todo = todo[docs[at[todo]] >= docs[todo]]
        # all entries between one and its candidate have no smaller document, so candidates can be jumped over
        beyond, reach = at[at[todo]], np.minimum(length[todo], length[at[todo]])
        at[todo], length[todo] = beyond, np.where((beyond >= 0) & (reach >= least), reach, 0)
        todo = todo[length[todo] > 0]
    return length


def longest_previous_factors(data: np.ndarray, positions: np.ndarray, docs: np.ndarray, cap: int, least: int) -> np.ndarray:
    """For each suffix, how many of its first ``cap`` bytes start in a smaller document too; 0 if below ``least``."""
    rank = suffix_order(data, positions, cap)
    order = np.lexsort((docs, rank))
    sorted_rank, sorted_docs = rank[order], docs[order]
    common = np.zeros(len(order), dtype=np.int64)
    same = np.append(False, sorted_rank[1:] == sorted_rank[:-1])[: len(order)]
    common[same] = cap
    padded = np.concatenate([data, np.zeros(cap, dtype=np.uint8)])
    if least < cap:
        other = np.flatnonzero(~same)[1:]
        for part in np.array_split(other, -(-len(other) // 10_000) or 1):
            a = padded[positions[order[part]][:, None] + np.arange(cap)]
            b = padded[positions[order[part - 1]][:, None] + np.arange(cap)]
            common[part] = np.argmax(a != b, axis=1)
    backward = _smaller(sorted_docs, common, least)
    forward = _smaller(sorted_docs[::-1], np.append(0, common[:0:-1])[: len(order)], least)[::-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.maximum(backward, forward)
    return out


def _pack(values: np.ndarray) -> bytes:
    """Numbers, compressed by planes of bytes."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return pa.Codec("zstd", 3).compress(np.ascontiguousarray(planes), asbytes=True)


def _unpack(data: bytes, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.Codec("zstd").decompress(data, n * size, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, n).T).view(kind).ravel()


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    ids: list = []
    texts: list[bytes] = []
    size = 0

    def row() -> pa.RecordBatch:
        data = b"".join(texts)
        columns = [
            pa.array([part << 32 | number], pa.int64()), pa.array([[i or 0 for i in ids]], pa.list_(pa.int64())),
            pa.array([[i is not None for i in ids]], pa.list_(pa.bool_())),
            pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([len(data)], pa.int64()),
            pa.array([pa.Codec("zstd", 3).compress(data, asbytes=True)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=list(BATCHED))

    for batch in batches:
        for i, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            ids.append(i)
            texts.append(text)
            size += len(text)
            if size >= BATCH or len(ids) >= BATCH // 64:
                yield row()
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield row()


BATCHED = ("batch", "ids", "named", "lengths", "size", "data")
BATCHES = "batch bigint, ids array<bigint>, named array<boolean>, lengths array<bigint>, size bigint, data binary"


class Batch(NamedTuple):
    """Documents of a batch; those without id, whose number counts for nothing, have no runs."""

    number: int
    ids: np.ndarray
    named: np.ndarray
    lengths: np.ndarray
    data: np.ndarray

    @staticmethod
    def of(number: int, ids: list, named: list, lengths: list, size: int, data: bytes) -> Batch:
        raw = pa.Codec("zstd").decompress(data, size, asbytes=True)
        numbers = (np.array(x, dtype=kind) for x, kind in ((ids, np.int64), (named, bool), (lengths, np.int64)))
        return Batch(number, *numbers, np.frombuffer(raw, dtype=np.uint8))

    def runs(self) -> Runs:
        found = runs(self.data, self.lengths)
        return found if self.named.all() else Runs(*(c[self.named[found.doc]] for c in found))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    for batch in batches:
        columns = [batch.column(c) for c in BATCHED]
        for i in range(batch.num_rows):
            yield Batch.of(*(c[i].as_py() for c in columns))


def _anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Each batch's distinct anchors and how many documents have them, by bucket."""
    shift = np.uint64(HASH_BITS - (buckets.bit_length() - 1))
    for batch in _read(batches):
        found = batch.runs()
        order = np.lexsort((found.doc, found.anchor))
        anchor, doc = found.anchor[order], found.doc[order]
        fresh = np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))[: len(anchor)]
        anchor, docs = np.unique(anchor[fresh], return_counts=True)
        bucket = (anchor >> shift).astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        used = np.flatnonzero(cuts[1:] > cuts[:-1])
        rows = [
            (int(b), e - s, _pack(np.diff(anchor[s:e], prepend=np.uint64(0))), _pack(docs[s:e].astype("<u4")))
            for b, s, e in zip(used, cuts[used].tolist(), cuts[used + 1].tolist(), strict=True)
        ]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n", "anchors", "docs"])


def _shared(frame: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """A bucket's slice of the bits of shared anchors; anchors by number of documents, the most frequent first."""
    anchors = [np.cumsum(_unpack(a, n, "<u8")) for a, n in zip(frame["anchors"], frame["n"], strict=True)]
    docs = [_unpack(d, n, "<u4") for d, n in zip(frame["docs"], frame["n"], strict=True)]
    anchor, at = np.unique(np.concatenate(anchors), return_inverse=True)
    count = np.bincount(at, weights=np.concatenate(docs)).astype(np.int64)
    shared, count = anchor[count > 1], count[count > 1]
    bits = np.zeros((1 << BITS) // buckets, dtype=bool)
    bits[(shared >> np.uint64(HASH_BITS - BITS)).astype(np.int64) % len(bits)] = True
    often = np.flatnonzero(count > FREQUENT)
    return pd.DataFrame(
        {
            "bucket": [frame["bucket"].iloc[0]], "total": [sum(map(len, anchors))], "bits": [np.packbits(bits).tobytes()],
            "frequent": [shared[often].astype("<u8").tobytes()], "counts": [count[often].astype("<i8").tobytes()],
        }
    )


class SharedAnchors(NamedTuple):
    """Bits of shared anchors by hash prefix, and the frequent anchors."""

    bits: np.ndarray
    frequent: np.ndarray

    def has(self, anchor: np.ndarray) -> np.ndarray:
        at = (anchor >> np.uint64(HASH_BITS - BITS)).astype(np.int64)
        return (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


class Strings(NamedTuple):
    """Distinct strings of a batch at shared anchors, by bucket, and the runs they stand for."""

    bucket: np.ndarray
    start: np.ndarray  # of one occurrence
    count: np.ndarray  # of windows; 0 for a window that travels as digest
    first: np.ndarray  # smallest id
    digest: np.ndarray  # two hashes of the window, where it travels so
    runs: Runs
    of_run: np.ndarray  # string of each run


def strings(batch: Batch, shared: Shared, buckets: int) -> Strings:
    found = batch.runs()
    keep = shared.has(found.anchor)
    found = Runs(*(c[keep] for c in found))
    often = np.isin(found.anchor, shared.frequent)
    enough = len(batch.data) >= LENGTH
    whole = _rolled(batch.data, LENGTH) if enough else np.empty(0, np.uint64)
    second = np.zeros(len(found.start), dtype=np.uint64)
    kind = found.count
    if often.any():  # every window by itself
        counts = np.where(often, found.count, 1)
        index = np.repeat(np.arange(len(counts)), counts)
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start, single = found.start[index] + step, often[index]
        grams = _rolled(batch.data, GRAM)
        second = _mixed(grams[start] + np.uint64(3) * grams[start + LENGTH - GRAM]) & np.uint64(0xFFFFFFFF)
        anchor = np.where(single, _mixed(whole[start]) >> np.uint64(6), found.anchor[index])
        kind = np.where(single, 0, found.count[index])
        found = Runs(start, np.where(single, 1, found.count[index]), anchor, found.doc[index])
    # a string is known by the hashes of its first and last window and its length
    head, tail = whole[found.start], np.where(kind > 0, whole[found.start + found.count - 1], second)
    order = np.lexsort((batch.ids[found.doc], tail, head, kind, found.anchor))
    fresh = np.zeros(len(order), dtype=bool)
    fresh[:1] = True
    for key in (found.anchor, kind, head, tail):
        fresh[1:] |= key[order[1:]] != key[order[:-1]]
    of_run = np.empty(len(order), dtype=np.int64)
    of_run[order] = np.cumsum(fresh) - 1
    one = order[fresh]
    shift = np.uint64(HASH_BITS - (buckets.bit_length() - 1))
    bucket = (found.anchor[one] >> shift).astype(np.int64)  # ascending, like the anchors
    digest = np.stack([head[one], tail[one]], axis=1)
    return Strings(bucket, found.start[one], kind[one], batch.ids[found.doc[one]], digest, found, of_run)


def _sent(batches: Iterator[pa.RecordBatch], shared, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each batch's strings by bucket."""
    shared = shared.value
    for batch in _read(batches):
        found = strings(batch, shared, buckets)
        cuts = np.searchsorted(found.bucket, np.arange(buckets + 1))
        padded = np.concatenate([batch.data, np.zeros(WIDTH, dtype=np.uint8)])
        rows: list[tuple] = []
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            part = slice(cuts[b], cuts[b + 1])
            count = found.count[part]
            cells = np.arange(WIDTH) < np.where(count > 0, count + LENGTH - 1, 0)[:, None]
            data = padded[found.start[part][:, None] + np.arange(WIDTH)][cells].tobytes()
            packed = pa.Codec("zstd", 3).compress(data, asbytes=True)
            digest = found.digest[part][count == 0]
            hashes = digest[:, 0].tobytes() + digest[:, 1].astype("<u4").tobytes()
            rows.append((int(b), batch.number, int(cuts[b]), len(count), len(data), packed, hashes, _pack(count.astype(np.uint8)), _pack(found.first[part])))
        if rows:
            kinds = (pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 4)
            names = ["bucket", "batch", "offset", "n", "size", "data", "digests", "counts", "firsts"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _string_keys(data: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each string's first window, last window and anchor."""
    parts = []
    for at in range(0, len(start), 10_000):
        begin, windows = start[at : at + 10_000], count[at : at + 10_000]
        low = int(begin[0])
        piece = data[low : int(begin[-1] + windows[-1]) + LENGTH - 1]
        whole = _rolled(piece, LENGTH)
        grams = np.append(_mixed(_rolled(piece, GRAM)), ~np.uint64(0))
        edges = np.stack([begin - low, begin - low + windows + WINDOW - 1], axis=1).ravel()
        anchor = np.minimum.reduceat(grams, edges)[::2]
        parts.append((whole[begin - low], whole[begin - low + windows - 1], anchor))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _judged(frame: pd.DataFrame) -> pd.DataFrame:
    """For each batch's strings: the smallest id of all, and a bit for every window that a smaller one has."""
    frame = frame.sort_values("batch")
    count = np.concatenate([_unpack(c, n, "u1") for c, n in zip(frame["counts"], frame["n"], strict=True)]).astype(np.int64)
    first = np.concatenate([_unpack(f, n, "<i8") for f, n in zip(frame["firsts"], frame["n"], strict=True)])
    raw = b"".join(pa.Codec("zstd").decompress(d, s, asbytes=True) for d, s in zip(frame["data"], frame["size"], strict=True))
    data = np.frombuffer(raw, dtype=np.uint8)
    text_at = np.flatnonzero(count > 0)
    length = np.where(count > 0, count + LENGTH - 1, 0)
    start = np.cumsum(length) - length
    head, tail, anchor = (np.empty(len(count), dtype=np.uint64) for _ in range(3))
    if len(text_at):
        head[text_at], tail[text_at], anchor[text_at] = _string_keys(data, start[text_at], count[text_at])
    digests = [np.frombuffer(d, dtype=np.uint8).reshape(-1) for d in frame["digests"]]
    head[count == 0] = anchor[count == 0] = np.concatenate([d[: len(d) // 12 * 8].view("<u8") for d in digests])
    tail[count == 0] = np.concatenate([d[len(d) // 12 * 8 :].view("<u4") for d in digests])
    order = np.lexsort((first, tail, head, count, anchor))
    fresh = np.zeros(len(order), dtype=bool)
    fresh[:1] = True
    for key in (anchor, count, head, tail):
        fresh[1:] |= key[order[1:]] != key[order[:-1]]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    one = order[fresh]  # the entry of a string with the smallest id
    bits = np.zeros(len(one), dtype=np.int64)
    # suffixes of the distinct strings, unless a string is the only one at its anchor
    alike = anchor[one][1:] == anchor[one][:-1]
    several = np.flatnonzero((np.append(alike, False) | np.append(False, alike)) & (count[one] > 0))
    # in parts of whole anchors, so that memory follows the largest anchor and not the bucket
    places = anchor[one][several]
    edges = np.append(np.flatnonzero(np.append(True, places[1:] != places[:-1])), len(several))
    cuts = np.unique(edges[np.searchsorted(edges, np.append(np.arange(0, len(several), PART), len(several)))]).tolist()
    for at, end in zip(cuts, cuts[1:], strict=False):
        part = several[at:end]
        chosen = one[part]
        text, sizes = gather(data, length, chosen)
        begin, windows = np.cumsum(sizes) - sizes, count[chosen]
        owner = np.repeat(np.arange(len(chosen)), windows)
        step = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        factor = longest_previous_factors(text, begin[owner] + step, first[chosen][owner], LENGTH, LENGTH)
        np.bitwise_or.at(bits, part[owner], np.where(factor >= LENGTH, 1 << step, 0))
    smallest, bits = first[one][group], bits[group]
    told = (smallest < first) | (bits != 0)  # batches know the rest
    sizes = frame["n"].to_numpy()
    cuts = np.append(0, np.cumsum(sizes))
    rows = []
    for i, (batch, offset) in enumerate(zip(frame["batch"], frame["offset"], strict=True)):
        part = np.flatnonzero(told[cuts[i] : cuts[i + 1]])
        if len(part):
            at = part + cuts[i]
            rows.append((batch, len(part), _pack(part + offset), _pack(smallest[at]), _pack(bits[at])))
    return pd.DataFrame(rows, columns=["batch", "n", "strings", "smallest", "bits"])


class Cut(NamedTuple):
    """What a document loses: flags by byte."""

    id: int | None
    data: np.ndarray
    gone: np.ndarray


def _cuts(batch: Batch, replies: pd.DataFrame, shared: Shared, buckets: int) -> Iterator[Cut]:
    found = strings(batch, shared, buckets)
    first, bits = found.first.copy(), np.zeros(len(found.first), dtype=np.int64)
    for n, at, smallest, told in zip(replies["n"], replies["strings"], replies["smallest"], replies["bits"], strict=True):
        at = _unpack(at, n, "<i8")
        first[at], bits[at] = _unpack(smallest, n, "<i8"), _unpack(told, n, "<i8")
    own = batch.ids[found.runs.doc]
    everything = (1 << found.runs.count) - 1
    mask = np.where(own > first[found.of_run], everything, bits[found.of_run])
    change = np.zeros(len(batch.data) + 1, dtype=np.int64)
    for step in range(WINDOW):
        hit = found.runs.start[(mask >> step) & 1 > 0] + step  # each window is in one run
        change[hit] += 1
        change[hit + LENGTH] -= 1
    gone = np.cumsum(change[:-1]) > 0
    ends = np.cumsum(batch.lengths)
    for i, named, end, length in zip(batch.ids.tolist(), batch.named.tolist(), ends.tolist(), batch.lengths.tolist(), strict=True):
        yield Cut(i if named else None, batch.data[end - length : end], gone[end - length : end])


def _results(key: tuple, left: pd.DataFrame, right: pd.DataFrame, shared, buckets: int, texts: bool) -> pd.DataFrame:
    rows = []
    for values in left.itertuples(index=False):
        batch = Batch.of(*(getattr(values, c) for c in BATCHED))
        for cut in _cuts(batch, right, shared.value, buckets):
            kept = cut.data[~cut.gone].tobytes()
            spans = int(np.count_nonzero(cut.gone[1:] & ~cut.gone[:-1])) + int(cut.gone[:1].any())
            last = kept if texts else hashlib.sha256(kept).hexdigest()
            rows.append((cut.id, len(cut.data), int(cut.gone.sum()), spans, last))
    frame = pd.DataFrame(rows, columns=["id", "n_bytes", "n_removed", "n_spans", "kept"])
    return frame.astype({"id": "Int64"})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) for every row; kept is the digest of the bytes left, or these bytes."""
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("id"), filled(F.col(text_col)).alias("text"))
    packed = kept_table(
        given.mapInArrow(releasing(_batched), BATCHES), "batches"
    )
    total = packed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(BUCKETS, 1 << (total // BUCKET).bit_length())

    anchors = packed.mapInArrow(releasing(partial(_anchors, buckets=buckets)), "bucket int, n bigint, anchors binary, docs binary")
    slices = anchors.groupBy("bucket").applyInPandas(
        partial(_shared, buckets=buckets), "bucket int, total bigint, bits binary, frequent binary, counts binary"
    )
    bits = np.zeros((buckets, (1 << BITS) // buckets // 8), dtype=np.uint8)
    often, counts, seen = [np.empty(0, "<u8")], [np.empty(0, "<i8")], 0
    for row in slices.collect():  # 2 ** BITS bits, and 16 bytes for a frequent anchor
        bits[row["bucket"]] = np.frombuffer(row["bits"], dtype=np.uint8)
        often.append(np.frombuffer(row["frequent"], dtype="<u8"))
        counts.append(np.frombuffer(row["counts"], dtype="<i8"))
        seen += row["total"]
    frequent = np.concatenate(often)[np.concatenate(counts) > max(FREQUENT, seen >> 16)]
    shared = Shared(spark, SharedAnchors, bits.ravel(), frequent)

    sent = packed.mapInArrow(
        releasing(partial(_sent, shared=shared, buckets=buckets)),
        "bucket int, batch bigint, offset bigint, n bigint, size bigint, data binary, digests binary, counts binary, firsts binary",
    )
    replies = sent.groupBy("bucket").applyInPandas(_judged, "batch bigint, n bigint, strings binary, smallest binary, bits binary")
    last = "binary" if texts else "string"

    def results(key, left, right):
        return _results(key, left, right, shared, buckets, texts)

    found = packed.groupBy("batch").cogroup(replies.groupBy("batch")).applyInPandas(
        results, f"id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept {last}"
    )
    return found.withColumnRenamed("id", id_col)
