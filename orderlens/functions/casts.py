"""Casts that never fail a job: bad input becomes NULL or an empty string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.schema import RAW


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_int(col: Column | str, type: str = "bigint") -> Column:
    """Integer value of a number or of integer text; fractions truncate toward zero.

    NULL, NaN, infinities, other text and values outside ``type`` give NULL.
    """
    return _column(col).try_cast(type)


def safe_int_variant(col: Column | str, type: str = "bigint") -> Column:
    """:func:`safe_int` for a JSON value kept as a variant."""
    return F.try_variant_get(_column(col), "$", type)


def safe_str(col: Column | str, floating: bool = False) -> Column:
    """Text of the value, or '' where it is NULL (for ``floating`` input also where it is NaN)."""
    value = _column(col)
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(F.isnan(value), F.lit("")).otherwise(text) if floating else text


def to_raw_orders(df: DataFrame) -> DataFrame:
    """The 13 detail columns in table order, integers and strings made safe."""

    def safe(f: T.StructField) -> Column:
        is_text = isinstance(f.dataType, T.StringType)
        return safe_str(f.name) if is_text else safe_int(f.name, f.dataType.simpleString())

    return df.select(*(safe(f).alias(f.name) for f in RAW.fields))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns with its types; a column the frame lacks becomes NULL.

    For files of other writers only: a value that does not fit becomes NULL too.
    """
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        )
    )


def _widens(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    if given == wanted or isinstance(given, T.NullType):
        return True
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    return given in whole and wanted in whole[whole.index(given) :] or (
        isinstance(wanted, T.DoubleType) and given in [*whole[:3], T.FloatType()]
    )


def exactly(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``schema``'s columns with its types; an error unless the frame has just these and all values fit."""
    given, wanted = {f.name: f.dataType for f in df.schema.fields}, {f.name: f.dataType for f in schema.fields}
    absent, extra = sorted(wanted.keys() - given.keys()), sorted(given.keys() - wanted.keys())
    if absent or extra or len(given) != len(df.columns):
        raise ValueError(f"columns do not match: absent {absent}, not expected {extra}")
    narrow = [f"{c} {given[c].simpleString()}" for c in wanted if not _widens(given[c], wanted[c])]
    if narrow:
        raise TypeError(f"values may not fit: {', '.join(narrow)}")
    return df.select(*(F.col(c).cast(kind).alias(c) for c, kind in wanted.items()))
