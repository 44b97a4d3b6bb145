"""The pipeline and its queries on the smallest tables, against brute force or DuckDB."""

import hashlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import rows
from llm_corpus import PASSAGE, TEXTS, grouped, hits, lower, simhash_classes

import corpus_pipeline
from orderlens.llm import toxicity
from orderlens.llm.byte_bpe import VOCABULARY, Merges
from orderlens.llm.decontamination import cut_words
from orderlens.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rejected = {r[0] for r in rows(toxicity.score(docs, model)) if r[3]}
    left = [(i, t) for i, t in rows(docs.select("doc_id", "text")) if i not in rejected]
    texts = dict(left)
    left = sorted(max(ids) for ids in grouped([lower(t) for _, t in left], [i for i, _ in left]).values())
    _, classes = simhash_classes([texts[i] for i in left])
    left = [min(ids) for ids in grouped(classes, left).values()]
    items = rows(spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text"))
    tokens = Merges.read(VOCABULARY).tokens
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    want = set()
    for i in left:
        flags, _ = hits(texts[i], items)
        text = cut_words(texts[i], np.packbits(flags).tobytes()) if any(flags) else texts[i]
        ids = library.encode_ordinary(text)
        want.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    found = rows(corpus_pipeline.run(spark, SF))
    assert len(found) == len(want) and set(found) == want


ODD = "_llm_slot bigint, _llm_id string, _llm_row int, _llm_own int, `a.b` string, row string, hash string, hit string"


@pytest.fixture
def odd_folder(spark, tmp_path):
    """Odd documents under odd columns, without n_chars; labels that belong to none, items with null."""
    docs = spark.createDataFrame([(i, t, 7, "k", 1, 2, "dot", "r", "h", None) for i, t in TEXTS * 2], f"doc_id bigint, text string, {ODD}")

    def write(rows_left=True):
        docs.where(str(rows_left)).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        items = [(1, PASSAGE), (2, "jumps over the lazy dog, and then it sleeps for a"), (None, "one"), (3, None)]
        spark.createDataFrame(items, "item_id bigint, text string").write.mode("overwrite").parquet(f"{tmp_path}/benchmark.parquet")
        spark.createDataFrame([(None, 1), (4, None), (99, 1)], "doc_id bigint, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)

    return write


def test_pipeline_of_odd_documents(spark, odd_folder):
    folder = odd_folder()
    groups = grouped([lower(t) for _, t in TEXTS], [i for i, _ in TEXTS])
    left = [(max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items()]
    _, classes = simhash_classes([t for _, t in left])
    left = [min(own, key=lambda d: (d[0] is None, d[0] or 0)) for own in grouped(classes, left).values()]
    found = rows(corpus_pipeline.run(spark, folder))
    assert sorted((r[0] is None, r[0] or 0) for r in found) == sorted((i is None, i or 0) for i, _ in left)
    lengths = {r[0]: r[1] for r in found}
    assert lengths[9] < 20 and lengths[7] == 0  # without the passage, and without the word that is an item


def test_stages_of_odd_and_no_documents(spark, odd_folder):
    for some in (True, False):
        folder = odd_folder(some)
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, folder)
            assert after.dtypes == docs.dtypes
            found = {tuple(r[c] for c in range(2, 10)) for r in rows(after)}
            assert found == ({(7, "k", 1, 2, "dot", "r", "h", None)} if some else set())
        assert some or rows(corpus_pipeline.run(spark, folder)) == []


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.dtypes == docs.dtypes
        assert after.count() <= docs.count()


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE_SQL])
def test_query_matches_duckdb(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, SF)
    assert set(df.columns) == set(columns)
    assert sorted(rows(df.select(*columns)), key=repr) == sorted(result.fetchall(), key=repr)


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_tokenizers_are_not_copied():
    assert not list(Path(corpus_pipeline.__file__).parent.rglob("*bpe_*k.*"))
