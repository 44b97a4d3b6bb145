"""The numbered operators as queries over the given tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm.byte_bpe import round_trip
from orderlens.llm.chain_dedup import linked_classes, repeated_passages
from orderlens.llm.common import UPPER, table
from orderlens.llm.decontamination import contamination
from orderlens.llm.exact_dedup import mark_copies
from orderlens.llm import fill_in_middle, importance, mixing, token_files, toxicity
from orderlens.llm.html_extract import extract
from orderlens.llm.sharding import assign
from orderlens.llm.simhash import near_duplicates
from orderlens.llm.suffix_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("kept", "kept_sha256")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"), hash_all=True)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op6_chain_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_classes(repeated_passages(table(spark, sf_dir, "documents")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.round_trip(table(spark, sf_dir, "documents"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_token_files": op5_token_files,
    "op6_chain_dedup": op6_chain_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_html_extraction": op9_html_extraction,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_mixing": op12_source_mixing,
    "op13_importance_resampling": op13_importance_resampling,
}

LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op7_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
        b AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS gram
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                FROM (SELECT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0)),
        grams AS (
          SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
          FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT n FROM b)
          WHERE i + n - 1 <= len(w)),
        hits AS (SELECT g.r, g.i, g.n, b.item_id FROM grams g JOIN b USING (n, gram)),
        covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
        found AS (
          SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)""",
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op11_fill_in_middle": """
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                 sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
          FROM documents),
        drawn AS (
          SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
                 CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS o
          FROM d),
        cut AS (
          SELECT doc_id, text, n,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain'
                      WHEN o < 20 THEN 'spm' ELSE 'psm' END AS form,
                 array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
                 array_to_string(u[greatest(a, b) + 1:], '') AS s
          FROM drawn)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM cut""",
    "op12_source_mixing": r"""
        WITH d AS (
          SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                 sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
          FROM documents),
        sources AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
          FROM d GROUP BY source),
        weighed AS (
          SELECT source, source_size, CAST(source_size * 2 AS DOUBLE) AS most,
                 CASE (place - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
          FROM sources),
        -- sources in the order in which they reach their limits
        filled AS (
          SELECT *, 1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS budget_left,
                 sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
          FROM weighed
          WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        level AS (SELECT max(CAST(budget_left AS DOUBLE) / weight_left) AS level FROM filled WHERE most * weight_left > budget_left * weight),
        targets AS (
          SELECT source, source_size, least(most, coalesce(level, 0) * weight) AS target FROM weighed, level),
        running AS (
          SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
                 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CAST(CASE WHEN source_size = 0 THEN 0
                    ELSE budget // source_size * size + least(size, greatest(0, budget % source_size - before)) END AS BIGINT) AS taken
        FROM running""",
}
