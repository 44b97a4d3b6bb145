import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from llm_corpus import TEXTS, no_documents, odd_documents

from orderlens.llm import suffix_dedup as module
from orderlens.llm.suffix_dedup import longest_previous_factors, remove_repeats, suffix_order


def brute(docs, length=50):
    first = {}
    for i, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - length + 1) if i is not None else ():
            key = data[p : p + length]
            first[key] = min(i, first.get(key, i))
    out = Counter()
    for i, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for p in range(len(data) - length + 1) if i is not None else ():
            if first[data[p : p + length]] < i:
                gone[p : p + length] = True
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        out[(i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


SHORT = [(i, t) for i, t in TEXTS if t is None or len(t) < 50_000]


@pytest.mark.parametrize(("batch", "frequent"), [(2 << 20, 20_000), (300, 20_000), (300, 2)])
def test_odd_documents(spark, monkeypatch, batch, frequent):
    monkeypatch.setattr(module, "BATCH", batch)
    monkeypatch.setattr(module, "FREQUENT", frequent)
    docs = odd_documents(spark).where("text is null or length(text) < 50000")
    assert Counter(rows(remove_repeats(docs))) == brute(SHORT)


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 1 << 16)
    docs = [(i, t) for i, t in TEXTS if i in (5, 6)]
    assert Counter(rows(remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")))) == brute(docs)


def test_random_passages(spark, monkeypatch):
    monkeypatch.setattr(module, "BATCH", 2000)
    random.seed(8)
    pool = ["".join(random.choice("ab") for _ in range(random.randrange(20, 120))) for _ in range(12)]
    docs = [(random.randrange(30), "".join(random.choices(pool, k=random.randrange(6)))) for _ in range(60)]
    found = rows(remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")))
    assert Counter(found) == brute(docs)


def test_texts_that_are_left(spark):
    docs = [(1, "x" * 30 + "y" * 60), (2, "keep " + "y" * 60 + " too")]
    found = rows(remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"), texts=True))
    assert {r[0]: bytes(r[4]).decode() for r in found} == {1: docs[0][1], 2: "keep  too"}


def test_longest_previous_factors():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 120).astype(np.uint8)
    docs, cap = np.repeat(np.arange(6), 20)[rng.permutation(120)], 12
    raw = data.tobytes()
    got = longest_previous_factors(data, np.arange(120), docs, cap, 1)
    common = lambda i, j: next((k for k in range(cap) if max(i, j) + k >= 120 or raw[i + k] != raw[j + k]), cap)
    inner = np.arange(120 - cap)  # further on, what is behind the end counts as bytes
    least = [max([0, *(common(i, j) for j in inner if docs[j] < docs[i])]) for i in inner]
    whole = [max([0, *(common(i, j) for j in range(120) if docs[j] < docs[i])]) for i in inner]
    assert (got[inner] >= least).all() and (got[inner] <= np.maximum(whole, least)).all()
    order = np.lexsort((np.arange(120 - cap), suffix_order(data, inner, cap)))
    cut = [raw[i : i + cap] for i in order]
    assert cut == sorted(cut)


def test_no_documents(spark):
    assert rows(remove_repeats(no_documents(spark))) == []
