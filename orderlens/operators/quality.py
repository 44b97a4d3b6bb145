"""Checks of the detail rows against the warehouse column types: counts by rule, and faulty rows set aside."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import storage
from orderlens.functions.casts import conform, safe_int_variant
from orderlens.operators.profiling import one_row_to_rows
from orderlens.schema import NULLABLE, RAW, UNSIGNED_BITS
from orderlens.sources.lake import read_as_written, read_batches

SCHEME = "^[^:/]+:/*"  # of a path
FAULTS = T.StructType().add("broken", T.ArrayType(T.StringType())).add("written", T.StringType())
PLACES = T.StructType().add("sound", T.BooleanType()).add("batch", T.StringType())


def _rules() -> list[tuple[str, Column]]:
    """(rule name, violation condition); the condition is never NULL."""
    rules = []
    for name in RAW.fieldNames():
        if name not in NULLABLE:
            rules.append((f"{name} not null", F.col(name).isNull()))
        if name in UNSIGNED_BITS:
            bits = UNSIGNED_BITS[name]
            outside = ~F.col(name).between(0, 2**bits - 1)
            rules.append((f"{name} fits uint{bits}", F.coalesce(outside, F.lit(False))))
    return rules


def _losses(given: DataFrame, schema: T.StructType) -> list[tuple[str, Column]]:
    """(rule name, condition that a value is there and the lake's type has none for it); never NULL."""
    have = {f.name: f.dataType for f in given.schema.fields}
    lost = []
    for f in schema.fields:
        if f.name in have and have[f.name] != f.dataType:
            value, kind = F.col(f.name), f.dataType.simpleString()
            variant = isinstance(have[f.name], T.VariantType)
            there = value.isNotNull() & ~F.is_variant_null(value) if variant else value.isNotNull()
            if isinstance(have[f.name], (T.FloatType, T.DoubleType)):
                there &= ~F.isnan(value)  # how some writers store a missing number
            kept = safe_int_variant(value, kind) if variant else value.try_cast(f.dataType)
            lost.append((f"{f.name} survives the cast", F.coalesce(there & kept.isNull(), F.lit(False))))
    return lost


def _names(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules whose condition holds, in their order."""
    named = F.array(*(F.when(broken, F.lit(name)) for name, broken in rules)).cast("array<string>")
    return F.array_compact(named)


def cast_losses(given: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """Values that are there but become NULL in the lake's types: ``rule``, ``violations``, in one pass.

    ``given`` has the types of its writer; variants are JSON values. Columns it lacks lose nothing.
    """
    lost = _losses(given, schema)
    if not lost:
        return given.sparkSession.createDataFrame([], "rule string, violations bigint")
    counts = given.agg(*(F.count_if(broken).alias(f"r{i}") for i, (_, broken) in enumerate(lost)))
    return one_row_to_rows(
        counts, [{"rule": F.lit(name), "violations": F.col(f"r{i}")} for i, (name, _) in enumerate(lost)]
    )


def broken_rules(given: DataFrame, *kept: str) -> DataFrame:
    """The rows in the lake's types, with the rules that each breaks and, if any, the row as its writer had it.

    ``broken`` lists rule names, values lost in the cast first; ``written`` is the whole row as JSON, NULL for a row
    that breaks none. Columns that the lake does not know are in ``written`` only, but for text columns named in
    ``kept``, which stay and are not part of it.
    """
    own = [F.col(f"`{c}`") for c in given.columns if c not in kept]
    found = given.withColumns({"_lost": _names(_losses(given, RAW)), "_given": F.struct(*own)})
    text = T.StringType()
    extra = [("_lost", T.ArrayType(text)), ("_given", found.schema["_given"].dataType), *((c, text) for c in kept)]
    typed = conform(found, T.StructType([*RAW.fields, *(T.StructField(*e) for e in extra)]))
    judged = typed.withColumn("broken", F.concat("_lost", _names(_rules())))
    # only rows that break a rule become text
    written = F.when(F.size("broken") > 0, F.to_json("_given", {"ignoreNullFields": "false"})).alias("written")
    return judged.select(*RAW.fieldNames(), *kept, "broken", written)


def _batch_name(batches: list[str]) -> Column:
    """Of each row, the name of the batch, an entry of the lake's folder, whose file holds it."""
    steps = {len(re.sub(SCHEME, "", b).split("/")) for b in batches}
    if len(steps) != 1:
        raise ValueError("the batches are not of one lake")
    return F.element_at(F.split(F.regexp_replace(storage.file_path(), SCHEME, ""), "/"), steps.pop())


def set_aside(spark: SparkSession, batches: list[str], quarantine: str) -> str:
    """Split lake batches in one pass: rows that break a rule go to ``quarantine``, the others to the folder returned.

    The folder ``batch=<name>`` in ``quarantine`` has a batch's faulty rows in the lake's types, each with its rules and
    as its writer had it, see :func:`broken_rules`. Splitting a batch again replaces them, so a retried load
    sets nothing aside twice. :func:`sound_rows` reads the folder returned, which the caller deletes.
    """
    split = f"{quarantine}/_split_{uuid.uuid4().hex}"
    parts = [broken_rules(f.withColumn("batch", _batch_name(batches)), "batch") for f in read_as_written(spark, batches)]
    sound = F.size("broken") == 0
    judged = reduce(DataFrame.unionByName, parts).withColumn("sound", sound)
    judged.withColumn("batch", F.when(~sound, F.col("batch"))).write.partitionBy("sound", "batch").parquet(split)
    found = {path.rsplit("/", 1)[-1]: path for path in storage.children(spark, f"{split}/sound=false")}
    for name in {f"batch={b.rsplit('/', 1)[-1]}" for b in batches} | set(found):
        storage.delete(spark, f"{quarantine}/{name}")
        if name in found:
            storage.move(spark, found[name], f"{quarantine}/{name}")
    return split


def sound_rows(spark: SparkSession, split: str) -> DataFrame:
    """The rows of a split that break no rule."""
    schema = T.StructType([*RAW.fields, *PLACES.fields])
    return spark.read.schema(schema).parquet(split).where("sound").select(*RAW.fieldNames())


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """All rows set aside: the lake's columns, ``broken``, ``written``, ``batch``."""
    schema = T.StructType([*RAW.fields, *FAULTS.fields, PLACES["batch"]])
    folders = storage.children(spark, quarantine)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", quarantine).parquet(*folders)


def validate_batches(spark: SparkSession, batches: list[str]) -> DataFrame:
    """Violations of lake batches before they are loaded: values lost in the cast, then the rules."""
    lost = [cast_losses(frame) for frame in read_as_written(spark, batches)]
    whole = reduce(DataFrame.unionByName, [*lost, validate_raw(read_batches(spark, batches))])
    return whole.groupBy("rule").agg(F.sum("violations").alias("violations"))


def validate_raw(raw: DataFrame) -> DataFrame:
    """Violations per rule, all rules in one pass: ``rule``, ``violations``."""
    rules = _rules()
    counts = raw.agg(*(F.count_if(broken).alias(f"r{i}") for i, (_, broken) in enumerate(rules)))
    return one_row_to_rows(
        counts, [{"rule": F.lit(name), "violations": F.col(f"r{i}")} for i, (name, _) in enumerate(rules)]
    )
