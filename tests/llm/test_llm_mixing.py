import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import rows
from llm_corpus import TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

from orderlens.llm import mixing
from orderlens.llm.mixing import mixed, shares, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, source string"


def size_of(text):
    return len(WORD.findall(text or ""))


def brute_targets(sizes, weights=(3, 1, 2), budget=1.5, epochs=2):
    """Resharing as it is told: cut at the limits, share the excess by weight, again until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {s: 0.0 for s in order}, set(order)
    excess = budget * sum(sizes.values())
    while open_ and excess > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += excess * weight[s] / total
        excess = 0.0
        for s in list(open_):
            if target[s] >= epochs * sizes[s]:
                excess += target[s] - epochs * sizes[s]
                target[s] = float(epochs * sizes[s])
                open_.discard(s)
    return target


def brute(docs, **options):
    """taken by (id, size, source), sorted, as lists of equal rows."""
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += size_of(text)
    target = brute_targets(sizes, **options)
    key = lambda d: hashlib.sha256(f"42:{'' if d[0] is None else d[0]}".encode()).hexdigest()
    taken = Counter()
    for source in sizes:
        own = sorted((d for d in docs if d[2] == source), key=lambda d: (key(d), d[0] is not None, d[0] or 0, size_of(d[1])))
        budget, total, before = math.floor(target[source] + 1e-7), sizes[source], 0
        for i, text, _ in own:
            n = size_of(text)
            got = budget // total * n + min(n, max(0, budget % total - before)) if total else 0
            taken[(i, n, total, round(target[source], 4), got)] += 1
            before += n
    return taken


def corpus(n=700, seed=2):
    random.seed(seed)
    sources = ["s9", "s10", "", "é", "Z", None, "empty"]
    docs = []
    for i in range(n):
        source = random.choice(sources) if random.random() < 0.6 else "hot"
        words = 0 if source == "empty" else random.choice([0, 1, 5, 40, 200])
        docs.append((i, " \n".join(["w,1"] * words) if words else random.choice(["", None, " \t\n"]), source))
    return docs


def found(df):
    return Counter((i, n, total, round(target, 4), got) for i, n, total, target, got in rows(df))


@pytest.mark.parametrize("rows_in_range", [1, 10, 1 << 17])
def test_against_brute_force(spark, monkeypatch, rows_in_range):
    monkeypatch.setattr(mixing, "RANGE", rows_in_range)
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA)
    result = found(shares(df))
    assert result == brute(docs) == found(shares(df.repartition(7)))
    by_source = defaultdict(int)
    for (_, _, total, target, got), n in result.items():
        by_source[(total, target)] += got * n
    assert all(abs(got - target) < 1 for (_, target), got in by_source.items())
    assert all(got <= 2 * n for (_, n, _, _, got) in result)


def test_repeated_and_odd_rows(spark):
    docs = [(i, t, None if i in (3, 4) else f"s{(i or 0) % 3}") for i, t in TEXTS * 3] + [(77, "a b c", "s1")] * 500
    df = spark.createDataFrame(docs, SCHEMA).withColumn("size", F.lit("x")).withColumn("a.b", F.lit(1)).withColumn("cut", F.lit(0))
    assert found(shares(df)) == brute(docs)
    one_source = odd_documents(spark).withColumn("source", F.lit(None).cast("string"))
    assert found(shares(one_source)) == brute([(i, t, None) for i, t in TEXTS])


def test_rest_that_ends_between_rows(spark):
    """One source, half of its words again: nothing, or one whole row, lies at the cut."""
    for n in (1, 2, 4, 10):
        docs = [(i, "two words", "s") for i in range(n)]
        result = rows(shares(spark.createDataFrame(docs, SCHEMA)))
        assert sum(r[4] for r in result) == 3 * n and {r[3] for r in result} == {3.0 * n}


def test_targets(spark):
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 0, None: 5}, {"x": 0}, {"a": 7}, {f"s{i}": i * i for i in range(40)}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        result = {r["source"]: r["target"] for r in targets(df).collect()}
        assert result == pytest.approx(brute_targets(sizes))
    wide = spark.createDataFrame([("a", 10), ("b", 90)], "source string, source_size bigint")
    assert {r["source"]: r["target"] for r in targets(wide, weights=(1, 9), budget=0.5).collect()} == pytest.approx({"a": 5, "b": 45})


def test_mixed_texts(spark):
    docs = corpus(200) + [(900, "same  one two\nthree", "hot"), (900, "same  one two\nthree", "hot"), (900, "other words of it", "hot")]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("a.b", F.lit("k")).withColumn("takes", F.lit(1))
    mix = mixed(df)
    assert mix.columns == df.columns
    taken, texts = Counter(), {(i, t or "") for i, t, _ in docs}
    for i, text, _, kept, one in rows(mix):
        assert (kept, one) == ("k", 1) and size_of(text)
        assert any(i == j and t.startswith(text) for j, t in texts)
        taken[i] += size_of(text)
    wanted = Counter()
    for i, _, _, _, got in rows(shares(df)):
        wanted[i] += got
    assert +taken == +wanted


def test_plan_has_no_python_and_no_whole_table_window(spark):
    plan = shares(spark.createDataFrame(corpus(50), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_no_documents(spark):
    empty = no_documents(spark).withColumn("source", F.lit("s"))
    assert rows(shares(empty)) == [] and rows(mixed(empty)) == []
