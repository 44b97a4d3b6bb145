import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from llm_corpus import TEXTS, grouped, linked, no_documents, odd_documents, simhash, simhash_classes, smallest

from orderlens.llm import simhash as module
from orderlens.llm.components import components
from orderlens.llm.simhash import fingerprint, keep_first, links, near_duplicates, tile_links


@pytest.mark.parametrize("text", [t for _, t in TEXTS if t is not None and len(t) < 10_000])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == simhash(text)


def test_classes_of_odd_documents(spark):
    values, classes = simhash_classes([t for _, t in TEXTS])
    members = grouped(classes, [i for i, _ in TEXTS])
    want = Counter((i, f"{v:016x}", smallest(members[c])) for (i, _), v, c in zip(TEXTS, values, classes, strict=True))
    assert Counter(rows(near_duplicates(odd_documents(spark)))) == want


def test_one_row_of_each_class_stays(spark):
    docs = odd_documents(spark, 2)
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    _, classes = simhash_classes([t for _, t in TEXTS])
    members = grouped(classes, [i for i, _ in TEXTS])
    assert Counter(r[0] for r in rows(kept.select("doc_id"))) == Counter(smallest(ids) for ids in members.values())


def near_fingerprints(n, seed):
    """Random fingerprints around a few centres, so that distances of 0 to 10 occur."""
    random.seed(seed)
    centres = [random.getrandbits(64) for _ in range(n // 12)]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        value = random.choice(centres)
        for _ in range(random.randrange(8)):
            value ^= 1 << random.randrange(64)
        out.add(value)
    return sorted(out)


def classes_of(values, pairs):
    number = {v: i for i, v in enumerate(values)}
    found = linked(len(values), [(number[a], number[b]) for a, b in pairs])
    return found


def brute(values, radius=4):
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= radius]


def test_tiles_find_the_same_classes():
    values = near_fingerprints(600, 1)
    left, right = np.array(values[::2], dtype=np.uint64), np.array(values[1::2], dtype=np.uint64)
    found = []
    for a, b in ((left, None), (right, None), (left, right)):
        found += zip(*(x.tolist() for x in tile_links(a, b, 4)), strict=True)
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert classes_of(values, found) == classes_of(values, brute(values))


def test_links_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(module, "TILE", 16)
    values = near_fingerprints(500, 2)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in rows(links(df))]
    assert classes_of(values, found) == classes_of(values, brute(values))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random.seed(seed)
    n = 60
    pairs = [(random.randrange(n), random.randrange(n)) for _ in range(45)] + [(59, k) for k in range(50, 59)]
    want = linked(n, pairs)
    found = dict(rows(components(spark.createDataFrame(pairs, "a bigint, b bigint"))))
    alone = {i for i in range(n) if all(i not in p or p[0] == p[1] for p in pairs)}
    assert found == {i: want[i] for i in range(n) if i not in alone}


def test_nothing(spark):
    assert rows(near_duplicates(no_documents(spark))) == []
    assert rows(keep_first(no_documents(spark))) == []
    assert rows(components(spark.createDataFrame([], "a bigint, b bigint"))) == []
