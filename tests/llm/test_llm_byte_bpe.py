import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import rows
from llm_corpus import TEXTS, no_documents, odd_documents

from orderlens.llm.byte_bpe import VOCABULARY, Encoder, Merges, RankQueue, decode, encode, round_trip


@pytest.fixture(scope="module")
def merges():
    return Merges.read(VOCABULARY)


@pytest.fixture(scope="module")
def library(merges):
    ranks = {t: i for i, t in enumerate(merges.tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts():
    random.seed(4)
    odd = ["", " ", "a" * 3000, "ab" * 2000 + " " * 300 + "x", "  a  b", "it's we'll  I'd", "<|endoftext|> hi", "　 wide\xa0nb"]
    mixed = ["".join(random.choice("abAB 'st\n\t.1\x1c\x85 é—l") for _ in range(random.randrange(1, 200))) for _ in range(400)]
    return odd + mixed + ["".join(random.choice("thereinonat") for _ in range(n)) for n in range(1, 300, 7)]


def test_same_ids_as_the_library(merges, library):
    encoder, texts = Encoder(merges, public_tokenizers.PATTERN), random_texts()
    encoder.learn(texts[::2])
    encoder.learn(texts)
    ids, counts = encoder.encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == library.encode_ordinary(text), text[:60]
        at += n


def test_queue_pops_the_lowest_rank_and_each_position_once():
    queue = RankQueue(np.array([5, 1, 9]), np.array([4100, 70, 4100]))
    queue.push(np.array([3, 9]), np.array([2, 4100]))
    popped = []
    while queue.top:
        rank, positions = queue.pop()
        popped.append((rank, positions.tolist()))
    assert popped == [(2, [3]), (70, [1]), (4100, [5, 9])]


def test_odd_documents(spark, library):
    want = Counter()
    for i, text in TEXTS:
        ids = library.encode_ordinary(text or "")
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert Counter(rows(round_trip(odd_documents(spark)))) == want


def test_encode_and_decode(spark, library):
    found = encode(odd_documents(spark))
    assert Counter((i, tuple(ids)) for i, ids in rows(found)) == Counter((i, tuple(library.encode_ordinary(t or ""))) for i, t in TEXTS)
    assert Counter(rows(decode(found))) == Counter((i, t or "") for i, t in TEXTS)


def test_no_documents(spark):
    assert rows(round_trip(no_documents(spark))) == []
    assert rows(encode(no_documents(spark))) == []
