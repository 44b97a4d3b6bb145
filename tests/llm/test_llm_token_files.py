import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from conftest import rows
from llm_corpus import TEXTS, no_documents, odd_documents

from orderlens.llm import token_files as module
from orderlens.llm.token_files import END, TOKENIZER, Decoder, Tokenizer, encode_block, frequencies, read, round_trip, tokenize, write


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(TOKENIZER)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, END]


def test_same_ids_as_the_library(library):
    random.seed(3)
    texts = ["", " ", "a  b", "it's I'LL don't 'sx", "<|endoftext|>x <|startoftext|>", "Σας ΣΑΣ ß İ ﬁ", "日本 語　x", "1234 ½ ²³", "\xad soft x̸y"]
    texts += ["".join(random.choice("abAB 'st\n\t.1\x1c\x85 éßÉñ—lİĳ́") for _ in range(random.randrange(1, 120))) for _ in range(500)]
    texts += [t for _, t in TEXTS if t is not None]
    ids, counts = Tokenizer(TOKENIZER).encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == ids_of(library, text), text[:60]
        at += n


def test_words_of_letters_are_told_at_once(library, monkeypatch):
    """Only pieces with anything but letters, and maybe a mark at their end, are looked at one by one."""
    seen = []
    one_by_one = Tokenizer.piece
    monkeypatch.setattr(Tokenizer, "piece", lambda self, piece: seen.append(piece) or one_by_one(self, piece))
    texts = ["Word word. WORD, wOrD.", "Éric ÀÖØÞ. œŒŽſ, ŁÓDŹ", "", "İx don't a.b a.. ., . , x\u0301 ªx <|endoftext|>. 日本, word", " word "]
    ids, counts = Tokenizer(TOKENIZER).encode(pa.array(texts))
    assert ids.tolist() == [i for text in texts for i in ids_of(library, text)]
    assert counts.tolist() == [len(ids_of(library, text)) for text in texts]
    assert sorted(seen) == sorted(["İx", "don't", "a.b", "a..", ".,", ".", ",", "x\u0301", "ªx", "<|endoftext|>.", "日本,"])
    letters = [chr(c) for c in range(1, 0x3000) if not chr(c).isspace()]
    ids, _ = Tokenizer(TOKENIZER).encode(pa.array([f"a{c}b {c}. {c}," for c in letters]))
    assert ids.tolist() == [i for c in letters for i in ids_of(library, f"a{c}b {c}. {c},")]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 200_000])
def test_blocks_round_trip_from_any_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 5000).astype(np.uint32)
    counts = np.bincount(ids, minlength=5001) + 1
    frequency = np.maximum(1, counts * (1 << 20) // counts.sum())
    frequency[0] -= frequency.sum() - (1 << 20)
    if frequency[0] < 1:
        frequency[np.argmax(frequency)] += frequency[0] - 1
        frequency[0] = 1
    block = encode_block(ids, b"table", frequency.astype(np.uint32))
    decoder = Decoder(frequency.astype(np.uint32))
    assert decoder.open(block)[0] == b"table"
    assert (decoder.decode(block) == ids).all()
    if n == 200_000:
        marks = len(decoder.open(block)[1])
        assert marks > 1
        assert (np.concatenate([decoder.decode(block, i, i + 1) for i in range(marks)]) == ids).all()
        assert len(block) < 1.05 * n * 8.7 / 8  # about the entropy
        damaged = bytearray(block)
        damaged[-7] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            decoder.decode(bytes(damaged))


def test_frequencies_cover_every_id(spark, tmp_path):
    table = frequencies(tokenize(odd_documents(spark), "doc_id", "text", str(tmp_path / "tokens"))[1])
    assert int(table.sum()) == 1 << module.SCALE
    assert table[END] > 0


@pytest.mark.parametrize("block", [1 << 19, 40])
def test_odd_documents(spark, library, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK", block)
    ids = [ids_of(library, t) for _, t in TEXTS]
    crc = [zlib.crc32(np.array(x, dtype="<u4").tobytes()) for x in ids]
    ordered = sorted(zip(TEXTS, ids, crc, strict=True), key=lambda r: ((r[0][0] is not None, r[0][0] or 0), len(r[1]), r[2]))
    want, start = Counter(), 0
    for (i, _), x, c in ordered:
        want[(i, start, len(x), c)] += 1
        start += len(x)
    assert Counter(rows(round_trip(odd_documents(spark)))) == want


def test_read_gives_the_ids(spark, library, tmp_path):
    write(odd_documents(spark), str(tmp_path / "files"))
    found = rows(read(spark, str(tmp_path / "files")))
    assert Counter((r[0], tuple(r[3])) for r in found) == Counter((i, tuple(ids_of(library, t))) for i, t in TEXTS)


def test_no_documents(spark):
    assert rows(round_trip(no_documents(spark))) == []
