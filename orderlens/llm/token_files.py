"""Token ids in files of independent blocks, coded by a static range asymmetric numeral system.

Three steps. Texts are turned into ids once and written to the scratch folder. From all of them a
table of frequencies is counted, which every block shares. Then documents are range-partitioned and
sorted by id, and each partition writes blocks.

A file folder is a Parquet table with a row for each block: ``part`` (partitions are in id order),
``block`` (its number there), ``before`` (ids of the part before it), ``n_tokens`` and ``data``; and a
folder ``frequencies`` with one row. ``data`` is, little-endian:

- the letters ``TIDB``, then unsigned 32-bit numbers: version, number of ids, lanes, steps between
  checkpoints, bytes of the document table, number of words, checksum of all that follows
- the document table: an Arrow stream with the columns id and n_tokens
- the checkpoints, last one first: before every so many steps, the word position (64 bits), the
  checksum of the ids up to the next checkpoint (64 bits) and the state of each lane (64 bits)
- the words (32 bits) that states have shed

Ids are dealt to the lanes in turn, so a step handles one id of every lane. Decoding can start at any
checkpoint, and every stretch between two of them is checked.

Blocks hold whole documents and at least ``BLOCK`` ids, unless they are a part's last. Texts are split
at spaces, which no token crosses, and each distinct piece of a batch is encoded once.

Defined results: a null text counts as empty; every document ends with the end id, so it has one id at
least. Null ids come first; documents that agree in id stand in the order of their number of ids and
checksums. Further columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import storage
from orderlens.llm.byte_bpe import gather
from orderlens.llm.common import Shared, filled, releasing

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 1
SCALE = 20  # frequencies add up to 2 ** SCALE
LOW = 1 << 31  # states stay from here to 2 ** 63
BLOCK = 1 << 19
LANES = 1024
STEPS = 128  # between checkpoints
KNOWN = 1 << 19  # words that a Python worker remembers
MAGIC, VERSION = b"TIDB", 1
HEAD = "<4s7I"
HEAD_SIZE = struct.calcsize(HEAD)

# Pieces that need no normalisation but lower case: printable ASCII and the Latin letters up to U+017F.
PLAIN = regex.compile("[!-~¡-¬®-ſ]+")
SIMPLE = "^[A-Za-zÀ-ÖØ-öø-įı-ſ]+[.,]?$"  # İ becomes two characters


class Tokenizer:
    """Ids of texts by the tokenizers library; its model is asked once for each distinct word.

    Only the path is pickled. A broadcast tokenizer is loaded, and remembers words, once in each Python worker.
    """

    def __init__(self, path: str):
        self.path, self.library = path, None

    def __getstate__(self) -> dict:
        return {"path": self.path, "library": None}

    def load(self) -> Tokenizer:
        if self.library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
            self.library = tokenizers.Tokenizer.from_file(self.path)
            with open(self.path, encoding="utf-8") as file:
                steps = json.load(file)["pre_tokenizer"]["pretokenizers"]
            self.words = regex.compile(steps[0]["pattern"]["Regex"]).findall
            # the alphabet of byte-level models: printable bytes stand for themselves, others follow from U+0100
            printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
            others = [b for b in range(256) if b not in printable]
            self.alphabet = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}
            self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
            self.model = self.library.model  # each look at it makes an object
            self.known: dict[str, tuple[int, ...]] = {}
        return self

    def word(self, word: str) -> tuple[int, ...]:
        ids = self.known.get(word)
        if ids is None:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
            ids = self.known[word] = tuple([t.id for t in self.model.tokenize(spelled)])
        return ids

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a text without blanks."""
        if not PLAIN.fullmatch(piece) or "<|" in piece and any(s in piece for s in self.special):
            return tuple(self.library.encode(piece, add_special_tokens=False).ids)
        piece = piece.lower()
        if piece.isalpha():
            return self.word(piece)
        if piece[-1] in ".," and piece[:-1].isalpha():
            return self.word(piece[:-1]) + self.word(piece[-1])
        return tuple(chain.from_iterable(map(self.word, self.words(piece))))

    def pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without blanks and last the end id, one after another, and how many each has.

        Most are a word of Latin letters, maybe with a full stop or comma; those are told, lowered and cut all at once.
        """
        simple = pc.match_substring_regex(pieces, SIMPLE)
        lowered = pc.utf8_lower(pieces.filter(simple))
        words = pc.ascii_rtrim(lowered, ".,").dictionary_encode()
        found = [self.known.get(w) or self.word(w) for w in words.dictionary.to_pylist()]
        marks = len(found)
        found += [(), self.word("."), self.word(","), (END,)]
        others = marks + 4 + np.arange(len(pieces) - len(lowered))
        found += [self.piece(p) if p else () for p in pieces.filter(pc.invert(simple)).to_pylist()]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(counts.sum()))
        # of each piece its word, or itself, and the mark after it
        simple = np.append(simple.to_numpy(zero_copy_only=False), False)
        order = np.full((len(pieces) + 1, 2), marks)
        order[simple, 0], order[~simple, 0] = words.indices.to_numpy(), np.append(others, marks + 3)
        for i, mark in enumerate(".,", 1):
            order[simple, 1] += i * pc.ends_with(lowered, mark).to_numpy(zero_copy_only=False)
        return gather(flat, counts, order.ravel())[0], counts[order].sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and how many each text has."""
        if len(self.load().known) > KNOWN:
            self.known.clear()
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")  # blanks of any kind are one to it
        pieces = lists.flatten().dictionary_encode()
        flat, counts = self.pieces(pieces.dictionary)
        sizes = lists.value_lengths().to_numpy()
        ends = np.cumsum(sizes)
        order = np.insert(pieces.indices.to_numpy(), ends, len(counts) - 1)
        total = np.diff(np.cumsum(counts[order])[ends + np.arange(len(ends))], prepend=0)
        parts = [gather(flat, counts, order[i : i + (1 << 20)])[0] for i in range(0, len(order), 1 << 20)]
        return np.concatenate([np.empty(0, np.uint32), *parts]), total


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def _tokenized(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Packed ids of the documents, and at the end of the partition one row with the count of each id."""
    tokenizer, used = shared.value, np.zeros(0, dtype=np.int64)
    names = ["id", "n_tokens", "crc", "width", "ids", "kind"]
    pack = pa.Codec("zstd").compress
    for batch in batches:
        ids, counts = tokenizer.encode(batch.column("text"))
        used = _added(used, ids)
        width = 2 if ids.max(initial=0) < 1 << 16 else 4
        ends = np.cumsum(counts)
        each = [ids[e - c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        # high bytes first: they repeat
        packed = [pack(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes(), asbytes=True) for x in each]
        n = len(each)
        columns = [
            batch.column("id"), pa.array(counts), pa.array([checksum(x) for x in each], pa.int64()),
            pa.array(np.full(n, width, dtype=np.int32)), pa.array(packed, pa.binary()), pa.array(["documents"] * n),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)
        kind = batch.column("id").type
    if len(used):
        packed = pack(used.astype("<i8").tobytes(), asbytes=True)
        row = ([None], kind), ([len(used)], pa.int64()), ([None], pa.int64()), ([8], pa.int32()), ([packed], pa.binary()), (["counts"], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(*c) for c in row], names=names)


def _added(counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    found = np.bincount(ids, minlength=len(counts))
    found[: len(counts)] += counts
    return found


def _unpack(data: bytes, n: int, width: int) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(data, n * width)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint32)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    columns = (batch.column(c).to_pylist() for c in ("n_tokens", "width", "ids"))
    for i, (n, width, data) in enumerate(zip(*columns, strict=True)):
        yield i, _unpack(data, n, width)


def tokenize(docs: DataFrame, id_col: str, text_col: str, folder: str, path: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """Write the ids of every row to a folder; (id, n_tokens, crc, width, ids) of them, and counts by partition."""
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("id"), filled(F.col(text_col)).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    columns = f"id {kind}, n_tokens bigint, crc bigint, width int, ids binary"
    shared = Shared(spark, Tokenizer, path)
    found = given.mapInArrow(releasing(partial(_tokenized, shared=shared)), f"{columns}, kind string")
    found.write.partitionBy("kind").mode("overwrite").parquet(folder)
    everything = spark.read.schema(f"{columns}, kind string").parquet(folder)
    return everything.where("kind = 'documents'").drop("kind"), everything.where("kind = 'counts'").drop("kind")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for n, data in zip(batch.column("n_tokens").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            found = np.frombuffer(pa.Codec("zstd").decompress(data, n * 8, asbytes=True), dtype="<i8").copy()
            longer, shorter = (found, total) if n > len(total) else (total, found)
            longer[: len(shorter)] += shorter
            total = longer
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token", "n"])


def frequencies(counts: DataFrame) -> np.ndarray:
    """A frequency for each id of the vocabulary, adding up to 2 ** SCALE; none that occurs has zero."""
    counted = counts.select("n_tokens", "ids").mapInArrow(_counted, "token bigint, n bigint")
    rows = counted.groupBy("token").agg(F.sum("n").alias("n")).toArrow()  # the vocabulary at most
    total = np.zeros(int(max(rows["token"].to_pylist(), default=END)) + 1, dtype=np.int64)
    total[rows["token"].to_numpy()] = rows["n"].to_numpy()
    if not total.any():
        total[END] = 1
    scaled = np.where(total > 0, np.maximum(1, np.floor(total / total.sum() * (1 << SCALE))), 0).astype(np.int64)
    excess = int(scaled.sum()) - (1 << SCALE)
    for i in np.argsort(-scaled, kind="stable"):  # the most frequent ids take the difference
        change = min(excess, int(scaled[i]) - 1) if excess > 0 else excess
        scaled[i] -= change
        excess -= change
        if not excess:
            break
    return scaled.astype(np.uint32)


def encode_block(ids: np.ndarray, documents: bytes, frequency: np.ndarray) -> bytes:
    """One block of ids with the serialised table of its documents."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 64))
    start = np.append(0, np.cumsum(frequency.astype(np.uint64)))[:-1].astype(np.uint64)
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, dtype=np.uint64)
    words, checkpoints, at = [], [], 0  # both from the last to the first
    shift = np.uint64(63 - SCALE)
    for step in range(steps - 1, -1, -1):
        symbols = ids[step * lanes : (step + 1) * lanes]
        active = state[: len(symbols)]
        f, c = frequency[symbols].astype(np.uint64), start[symbols]
        full = np.flatnonzero(active >= (f << shift))
        if len(full):
            words.append((active[full[::-1]] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            at += len(full)
            active[full] >>= np.uint64(32)
        quotient = active // f
        active[:] = (quotient << np.uint64(SCALE)) + (active - quotient * f) + c
        if step % STEPS == 0:
            stretch = ids[step * lanes : (step + STEPS) * lanes]
            checkpoints.append(struct.pack("<QQ", at, checksum(stretch)) + state.astype("<u8").tobytes())
    stream = np.concatenate([np.empty(0, "<u4"), *words])[::-1]
    body = documents + b"".join(checkpoints) + np.ascontiguousarray(stream).tobytes()
    return struct.pack(HEAD, MAGIC, VERSION, n, lanes, STEPS, len(documents), len(stream), zlib.crc32(body)) + body


class Decoder:
    """Reads blocks that were written with a table of frequencies."""

    def __init__(self, frequency: np.ndarray):
        self.frequency = frequency.astype(np.uint64)
        self.start = (np.cumsum(self.frequency) - self.frequency).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency)

    def stretch(self, state: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        """The next n ids from the states of a checkpoint and the words that follow it."""
        lanes, out, at = len(state), np.empty(n, dtype=np.uint32), 0
        mask, state = np.uint64((1 << SCALE) - 1), state.copy()
        for begin in range(0, n, lanes):
            active = state[: min(lanes, n - begin)]
            slot = active & mask
            symbols = self.symbol[slot]
            out[begin : begin + len(active)] = symbols
            active[:] = self.frequency[symbols] * (active >> np.uint64(SCALE)) + slot - self.start[symbols]
            low = np.flatnonzero(active < LOW)
            if len(low):
                active[low] = (active[low] << np.uint64(32)) | words[at : at + len(low)]
                at += len(low)
        return out

    def open(self, block: bytes) -> tuple[bytes, list[tuple[int, int, int]], int, int]:
        """Table of documents; checkpoints as (offset of states, word position, checksum); words' offset; ids."""
        magic, version, n, lanes, steps, size, n_words, crc = struct.unpack_from(HEAD, block)
        if magic != MAGIC or version != VERSION or zlib.crc32(memoryview(block)[HEAD_SIZE :]) != crc:
            raise ValueError("not a block of token ids, or a damaged one")
        at = HEAD_SIZE + size
        marks = []
        for _ in range(-(-n // (lanes * steps))):
            position, check = struct.unpack_from("<QQ", block, at)
            marks.append((at + 16, n_words - position, check))
            at += 16 + 8 * lanes
        return block[HEAD_SIZE : HEAD_SIZE + size], marks[::-1], at, n

    def decode(self, block: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids between two checkpoints, by default all of the block."""
        _, marks, at, n = self.open(block)
        lanes, steps = struct.unpack_from(HEAD, block)[3:5]
        words = np.frombuffer(block, dtype="<u4", offset=at).astype(np.uint64)
        out = [np.empty(0, np.uint32)]
        for number in range(len(marks))[first:last]:
            offset, position, check = marks[number]
            state = np.frombuffer(block, dtype="<u8", count=lanes, offset=offset)
            ids = self.stretch(state, words[position:], min(lanes * steps, n - number * lanes * steps))
            if checksum(ids) != check:
                raise ValueError("a stretch of token ids is damaged")
            out.append(ids)
        return np.concatenate(out)


def _blocks(batches: Iterator[pa.RecordBatch], frequency) -> Iterator[pa.RecordBatch]:
    frequency = frequency.value
    part, number, before = TaskContext.get().partitionId(), 0, 0
    held, ids, counts, size = [], [], [], 0

    def block() -> pa.RecordBatch:
        table = pa.table({"id": pa.concat_arrays(held), "n_tokens": pa.array(counts, pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        data = encode_block(np.concatenate(ids), sink.getvalue().to_pybytes(), frequency)
        columns = [[part], [number], [before], [size], [data]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        names = ["part", "block", "before", "n_tokens", "data"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        column = batch.column("id")
        for i, found in _rows(batch):
            held.append(column.slice(i, 1))
            ids.append(found)
            counts.append(len(found))
            size += len(found)
            if size >= BLOCK:
                yield block()
                number, before, held, ids, counts, size = number + 1, before + size, [], [], [], 0
    if size:
        yield block()


def write(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZER, parts: int | None = None
) -> None:
    """Write the token ids of all documents, in ascending order of their ids, as block files."""
    spark = docs.sparkSession
    tokens, counts = tokenize(docs, id_col, text_col, storage.scratch_folder(spark, "tokens"), path)
    frequency = frequencies(counts)
    table = spark.createDataFrame([(SCALE, frequency.astype("<u4").tobytes())], "scale int, frequencies binary")
    table.coalesce(1).write.mode("overwrite").parquet(f"{folder}/frequencies")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["id", "n_tokens", "crc"]
    ordered = tokens.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    shared = spark.sparkContext.broadcast(frequency)  # a number for each id of the vocabulary
    ordered.select("id", "n_tokens", "width", "ids").mapInArrow(
        releasing(partial(_blocks, frequency=shared)), "part int, block int, before bigint, n_tokens bigint, data binary"
    ).write.mode("overwrite").parquet(f"{folder}/blocks")


def _documents(batches: Iterator[pa.RecordBatch], frequency, digest: bool) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(frequency.value)
    for batch in batches:
        parts, befores = batch.column("part"), batch.column("before").to_pylist()
        for i, block in enumerate(batch.column("data")):
            block = block.as_py()
            table = pa.ipc.open_stream(decoder.open(block)[0]).read_all().combine_chunks()
            counts = table["n_tokens"].to_numpy()
            starts, ids = np.cumsum(counts) - counts, decoder.decode(block)
            each = [ids[s : s + c] for s, c in zip(starts.tolist(), counts.tolist(), strict=True)]
            column = table["id"].combine_chunks() if isinstance(table["id"], pa.ChunkedArray) else table["id"]
            if digest:
                last, kind = [checksum(x) for x in each], pa.int64()
            else:
                last, kind = [x.astype(np.int32) for x in each], pa.list_(pa.int32())
            columns = [column, pa.array([parts[i].as_py()] * len(counts), pa.int32()), pa.array(starts + befores[i]), pa.array(counts), pa.array(last, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "part", "start", "n_tokens", "ids"])


def read(spark: SparkSession, folder: str, id_type: str = "bigint", digest: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids) for every document of a folder of block files; start counts all ids before.

    With ``digest``, ids is their checksum instead, so that they do not leave the tasks.
    """
    table = spark.read.parquet(f"{folder}/frequencies").first()
    shared = spark.sparkContext.broadcast(np.frombuffer(table["frequencies"], dtype="<u4"))
    blocks = spark.read.parquet(f"{folder}/blocks")
    # a row for each part; their number is set when writing
    sizes = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    offsets, total = [], 0
    for part in sorted(sizes):
        offsets.append((part, total))
        total += sizes[part]
    kind = "bigint" if digest else "array<int>"
    found = blocks.select("part", "before", "data").mapInArrow(
        releasing(partial(_documents, frequency=shared, digest=digest)), f"id {id_type}, part int, start bigint, n_tokens bigint, ids {kind}"
    )
    offset = spark.createDataFrame(offsets, "part int, offset bigint")
    return found.join(F.broadcast(offset), "part").select(
        "id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids"
    )


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZER) -> DataFrame:
    """Writes block files to the scratch folder and reads them back: id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = storage.scratch_folder(spark, "token-files")
    write(docs, folder, id_col, text_col, path)
    kind = docs.schema[id_col].dataType.simpleString()
    return read(spark, folder, kind, digest=True).select(
        F.col("id").alias(id_col), "start", "n_tokens", F.col("ids").alias("ids_crc32")
    )
