import hashlib
from collections import Counter

from conftest import rows
from llm_corpus import TEXTS, grouped, lower, no_documents, odd_documents, smallest

from orderlens.llm.exact_dedup import keep_last, mark_copies


def largest(ids):
    return max((i for i in ids if i is not None), default=None)


def test_copies_of_odd_documents(spark):
    docs = TEXTS * 3
    groups = grouped([lower(t) for _, t in docs], [i for i, _ in docs])
    want = Counter()
    for text, ids in groups.items():
        digest, keep = hashlib.sha256(text.encode()).hexdigest(), largest(ids)
        want.update((i, keep, len(ids), digest) for i in ids)
    found = rows(mark_copies(odd_documents(spark, 3), hash_all=True).select("doc_id", "keep_id", "group_size", "text_sha256", "kept"))
    assert Counter(r[:4] for r in found) == want
    kept = [r for r in found if r[4]]
    assert Counter(r[3] for r in kept) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert all(r[0] == r[1] for r in kept)


def test_digest_only_where_needed(spark):
    alone = [r for r in rows(mark_copies(odd_documents(spark)).select("doc_id", "group_size", "text_sha256")) if r[1] == 1]
    assert alone
    assert any(r[2] is None for r in alone)


def test_keep_last(spark):
    docs = odd_documents(spark, 2)
    kept = keep_last(docs)
    assert kept.columns == docs.columns
    found = rows(kept.select("doc_id", "text"))
    groups = grouped([lower(t) for _, t in TEXTS], [i for i, _ in TEXTS])
    assert Counter((i, lower(t)) for i, t in found) == Counter({(largest(ids), t): 1 for t, ids in groups.items()})


def test_only_the_same_text_groups(spark):
    # equal lengths, equal beginnings, equal beginnings and lengths
    texts = ["x" * 100, "y" * 100, "x" * 101, "x" * 99 + "z", "É" + "a" * 70, "é" + "a" * 70]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r[2] for r in rows(mark_copies(df))} == {1}


def test_no_documents(spark):
    assert rows(mark_copies(no_documents(spark))) == []
    assert rows(keep_last(no_documents(spark))) == []
    assert smallest([None]) is None
