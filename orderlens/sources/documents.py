"""Nested order documents: read, parse, flatten, stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.casts import safe_int_variant
from orderlens.schema import DOCUMENT, ORDER, PRODUCT_IN_ORDER, RAW

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_orders_json(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, rejects: str | None = None
) -> DataFrame:
    """One row per document, one document per line; lines of blanks are skipped.

    With ``multi_line`` each file is one document, as a poll of the orders service returns it, and
    files are the unit of parallelism; a document is one response, so it fits in one task. A file
    that holds more than one document is an error.

    Whatever does not parse is an error, also a single element of the wrong kind. With ``rejects``
    such documents are written there as text instead, see :func:`parse_orders`.
    """
    return parse_orders(spark.read.text(path, wholetext=multi_line), "value", rejects)


def parse_orders(df: DataFrame, col: str, rejects: str | None = None) -> DataFrame:
    """One row per document of a text column; NULL and blank texts are none.

    A text must be one JSON object, and everything in it that the schema names must have its shape;
    anything else fails the job. With ``rejects`` the texts that do not parse are written whole to
    that folder first, and only the others are returned: nothing of a rejected document is loaded, so
    that it can be repaired and loaded again without counting twice.
    """
    texts = df.where(F.trim(F.regexp_replace(col, r"\s+", " ")) != "").select(F.col(col).alias("text"))
    # as the only element of a list, so that a second document behind the first does not pass unseen; a text that closes
    # the list itself does not fit into an object, where nothing but the syntax is looked at
    listed, kind = F.concat(F.lit("["), "text", F.lit("]")), T.ArrayType(DOCUMENT)
    boxed, syntax = F.concat(F.lit('{"document":'), "text", F.lit("}")), T.StructType([T.StructField("_none", T.StringType())])
    if rejects is not None:
        marked = T.StructType([*DOCUMENT.fields, T.StructField("_broken", T.StringType())])
        parsed = F.from_json("text", marked, {"columnNameOfCorruptRecord": "_broken"})
        whole = F.from_json(listed, kind)
        marked = T.StructType([*syntax.fields, T.StructField("_broken", T.StringType())])
        box = F.from_json(boxed, marked, {"columnNameOfCorruptRecord": "_broken"})
        sound = parsed["_broken"].isNull() & box["_broken"].isNull() & (F.size(whole) == 1) & whole[0].isNotNull()
        sound = F.coalesce(sound, F.lit(False))
        texts.where(~sound).write.mode("append").text(rejects)
        # a list of one document or none instead of a filter, below which the text would be parsed once more
        document = T.ArrayType(T.StructType([DOCUMENT["orders"]]))
        kept = texts.select(F.when(sound, F.array(F.struct(whole[0]["orders"].alias("orders")))).alias("documents"))
        return kept.select(F.inline(F.coalesce("documents", F.array().cast(document))))
    strict = {"mode": "FAILFAST"}
    documents = texts.select(F.from_json(listed, kind, strict).alias("documents"), F.from_json(boxed, syntax, strict).alias("box"))
    one = (F.size("documents") == 1) & F.col("documents")[0].isNotNull() & F.col("box").isNotNull()
    checked = F.when(one, F.col("documents")[0]).otherwise(
        F.raise_error(F.lit("a text is not exactly one document")).cast(DOCUMENT)
    )
    return documents.select(checked.alias("document")).select("document.orders")


def flatten_orders(documents: DataFrame) -> DataFrame:
    """One row per (order, product); orders without products yield no row.

    Order fields are cast once per order, before its products are spread. A missing list is
    replaced by an empty one: on the bare column Spark would infer a filter and evaluate it below
    the parsing of text, which parses every document twice.
    """
    kinds = {f.name: f.dataType for f in RAW.fields}

    def field(parent: str, f: T.StructField) -> Column:
        value = F.col(f"{parent}.{f.name}")
        if isinstance(f.dataType, T.VariantType):
            value = safe_int_variant(value, kinds[f.name].simpleString())
        return value.alias(f.name)

    order_fields = [f for f in ORDER.fields if f.name in kinds]
    listed = F.coalesce("orders", F.array().cast(DOCUMENT["orders"].dataType))
    orders = documents.select(F.explode(listed).alias("o")).select(
        *(field("o", f) for f in order_fields), "o.products"
    )
    items = orders.select(*(f.name for f in order_fields), F.explode("products").alias("p"))
    return items.select(*(f.name for f in order_fields), *(field("p", f) for f in PRODUCT_IN_ORDER.fields))


def with_ingestion_ts(df: DataFrame, ts: str | None = None) -> DataFrame:
    """Add the ingestion time as text, one value per batch; ``ts`` replaces the clock."""
    stamp = F.lit(ts) if ts is not None else F.date_format(F.current_timestamp(), TIMESTAMP_FORMAT)
    return df.withColumn("ingestion_timestamp", stamp)


def require_non_empty(df: DataFrame) -> DataFrame:
    """The frame itself, or an error when it has no rows. Stops at the first row it finds."""
    if df.isEmpty():
        raise ValueError("the batch has no rows")
    return df
