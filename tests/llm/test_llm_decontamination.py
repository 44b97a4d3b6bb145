import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from llm_corpus import TEXTS, hits, no_documents, odd_documents, words

from orderlens.llm import decontamination as module
from orderlens.llm.decontamination import FMIndex, contamination, cut_words, remove_hits, suffix_array

ITEMS = [
    (1, "quick brown fox jumps over the lazy dog and then IT sleeps"),
    (2, "lazy dog"),
    (3, "-- !"),
    (4, None),
    (None, "of it"),
    (10, "ab" * 3000),
    (11, "shared3 " + " ".join(f"shared{i}" for i in range(4, 15))),
    (11, "shared3 " + " ".join(f"shared{i}" for i in range(4, 15))),
    (12, "word5 of a very long text word6 of a very long text word7"),
    (13, "école straße"),
]


def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def expected(docs):
    out = Counter()
    for i, text in docs:
        flags, items = hits(text, ITEMS)
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out[(i, len(flags), sum(flags), len(items), digest, any(flags))] += 1
    return out


@pytest.mark.parametrize(("block", "shard"), [(50_000, 1 << 20), (3, 50)])
def test_odd_documents(spark, monkeypatch, block, shard):
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "SHARD", shard)
    assert Counter(rows(contamination(odd_documents(spark), benchmark(spark)))) == expected(TEXTS)


def test_random_documents(spark):
    random.seed(6)
    text = lambda n: " ".join(random.choice("a b c".split()) for _ in range(n))
    docs = [(i, text(random.randrange(60))) for i in range(80)]
    items = [(i, text(random.randrange(1, 14))) for i in range(30, 50)]
    found = rows(contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")))
    for i, _, n_hit, n_items, _, _ in found:
        flags, ids = hits(docs[i][1], items)
        assert (n_hit, n_items) == (sum(flags), len(ids))


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 4, 500)
    index = FMIndex(text, 3)
    assert (suffix_array(np.append(text, 0)) == sorted(range(501), key=lambda i: [*text[i:].tolist(), 0])).all()
    patterns = rng.integers(1, 4, (40, 5))
    lengths = rng.integers(1, 6, 40)
    low, high = index.search(patterns, lengths)
    for pattern, n, a, b in zip(patterns, lengths, low, high, strict=True):
        want = [i for i in range(500 - n + 1) if (text[i : i + n] == pattern[5 - n :]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_cut_words(spark):
    docs = odd_documents(spark)
    cleaned = remove_hits(docs, benchmark(spark))
    assert cleaned.columns == docs.columns
    found = Counter(rows(cleaned.select("doc_id", "text", "id", "hit")))
    want = Counter()
    for i, text in TEXTS:
        flags, _ = hits(text, ITEMS)
        if any(flags):
            text = cut_words(text, np.packbits(flags).tobytes())
            assert words(text) == [w for w, f in zip(words(dict(TEXTS)[i] if i else TEXTS[10][1]), flags, strict=True) if not f]
        want[(i, text, "x", "h")] += 1
    assert found == want
    assert cut_words("A b, c d. E", bytes([0b01100000])) == "A d. E"


def test_nothing(spark):
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert rows(contamination(no_documents(spark), benchmark(spark))) == []
    assert {r[2] for r in rows(contamination(odd_documents(spark), nothing))} == {0}
    assert Counter(rows(remove_hits(odd_documents(spark), nothing).select("doc_id", "text"))) == Counter(TEXTS)
