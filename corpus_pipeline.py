"""From raw documents to token ids: five stages over the documents of a folder, each written and read again.

Every stage takes rows with null or repeated ids, null, empty and very long texts, and further columns under any name;
all but the last return the columns they got. An empty table stays empty through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import byte_bpe, decontamination, exact_dedup, simhash, toxicity
from orderlens.llm.common import kept_table, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones among them does not reject.

    A text that is null, empty or without words stays, and all do where labels of one class are missing.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest id; null counts as empty, a null id as smallest."""
    return exact_dedup.keep_last(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest id; texts without words have fingerprint zero."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that stand in a window of the benchmark; n_chars, if there, counts what is left.

    A null text stays null and its n_chars becomes null.
    """
    cleaned = decontamination.remove_hits(docs, table(spark, sf_dir, "benchmark"))
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each document's token ids and of the text they decode to; a null text has no ids."""
    return byte_bpe.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_and_decode),
]

# SQL has no form for the model, the fingerprints or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
