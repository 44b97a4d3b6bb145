import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from llm_corpus import TEXTS, no_documents, odd_documents, words
from pyspark.sql import functions as F

from orderlens.llm import importance
from orderlens.llm.importance import Shift, bucket_counts, draw, features, gains, resample

SCHEMA = "doc_id bigint, text string"


def runs(text):
    own = words(text)
    return [" ".join(own[i : i + n]).encode() for n in (1, 2, 3) for i in range(len(own) - n + 1)]


def bucket(run):
    return zlib.crc32(run) % 10_000


def brute(docs, target):
    s, t = Counter(bucket(r) for _, x in docs for r in runs(x)), Counter(bucket(r) for x in target for r in runs(x))
    total, wanted = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (total + 10_000) / ((s[b] + 1) * (wanted + 10_000))))

    found = []
    for i, text in docs:
        own = runs(text)
        weight = sum(gain(bucket(r)) for r in own)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(text))])
    eligible = sorted((f for f in found if f[5] >= 20), key=lambda f: (-f[3], f[0] is None, f[0] or 0))
    for rank, f in enumerate(eligible[: 5 * len(eligible) // 100], 1):
        f[4] = rank
    return Counter(tuple(f[:5]) for f in found)


def corpus(n=900):
    random.seed(5)
    vocabulary = ["ta", "ri", "né", "x1", "O", "selmun", "日本", "q" * 70, "z" * 300, "42"]
    docs = [(i, random.choice([" ", ", ", "-\n"]).join(random.choices(vocabulary, k=random.choice([0, 1, 2, 3, 19, 20, 21, 90])))) for i in range(n)]
    return docs, [" ".join(random.choices(vocabulary[:4], k=30)) for _ in range(20)]


@pytest.mark.parametrize(("block", "joined"), [(1, 1), (7, 500), (1 << 18, 4 << 20)])
def test_against_brute_force(spark, monkeypatch, block, joined):
    monkeypatch.setattr(importance, "BLOCK", block)
    monkeypatch.setattr(importance, "JOINED", joined)
    docs, target = corpus(900 if block > 1 else 150)
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = rows(resample(df, goal))
    assert Counter(found) == brute(docs, target)
    assert block == 1 or sorted(r[4] for r in found if r[4]) == list(range(1, 1 + 5 * sum(len(words(t)) >= 20 for _, t in docs) // 100))


def test_odd_documents(spark):
    docs = odd_documents(spark, 12).withColumn("score", F.lit("x")).withColumn("n_words", F.lit(1)).withColumn("a.b", F.lit(0))
    goal = spark.createDataFrame([("the lazy dog, and then it sleeps",), (None,), ("",)], "text string").withColumn("id", F.lit(1))
    assert Counter(rows(resample(docs, goal))) == brute(TEXTS * 12, ["the lazy dog, and then it sleeps", None, ""])
    nothing = goal.where("false")
    assert Counter(rows(resample(docs, nothing))) == brute(TEXTS * 12, [])


def test_checksums_of_runs():
    random.seed(1)
    texts = [" ".join("ab"[: random.randrange(1, 3)] * random.choice([1, 2, 31, 32, 33, 64, 65, 700]) for _ in range(random.randrange(9))).encode() for _ in range(50)]
    found = Counter()
    for _, owner, sums in features(texts, Shift()):
        found.update(zip(owner.tolist(), sums.tolist(), strict=True))
    assert found == Counter((i, zlib.crc32(r)) for i, t in enumerate(texts) for r in runs(t.decode()))


def test_shift():
    shift, tail = Shift(), b"tail"
    for length in (0, 1, 4, 63, 64, 65, 128, 1000, 100_000):
        crc = np.array([zlib.crc32(b"head")], dtype=np.uint32)
        joined = shift(crc, np.array([length + 4]))[0] ^ zlib.crc32(b"\x01" * length + tail)
        assert joined == zlib.crc32(b"head" + b"\x01" * length + tail)


def test_ranks(spark):
    """Ties go to the smaller id, null last; the share is rounded down; short documents are not drawn."""
    data = [(i, 20, 1, 0, s) for i, s in [(5, 7), (3, 7), (None, 7), (1, 9), (2, -4)]] + [(9, 19, 1, 0, 99)]
    df = spark.createDataFrame(data, "id bigint, n_words bigint, n_features bigint, weight bigint, score bigint").repartition(6)
    ranks = lambda percent: {r["id"]: r["rank"] for r in draw(df, percent).collect()}
    assert ranks(100) == {1: 1, 3: 2, 5: 3, None: 4, 2: 5, 9: None}
    assert ranks(50) == {1: 1, 3: 2, 5: None, None: None, 2: None, 9: None}
    assert set(ranks(19).values()) == {None}


def test_gains():
    assert gains(np.array([3, 0]), np.array([0, 1])).tolist() == [math.floor(1000 * math.log(5 / 12)), math.floor(1000 * math.log(10 / 3))]


def test_no_documents(spark):
    empty = no_documents(spark)
    assert rows(resample(empty, empty)) == []
    assert bucket_counts(empty).sum() == 0
