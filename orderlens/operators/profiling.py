"""First look at a table: head, columns, sample, summary statistics."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import storage
from orderlens.functions.ratios import settle

QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 10_000  # of the sketch: its rank error is at most the number of rows divided by this
KEPT = 1 << 16  # values around a percentile that are counted one by one, at most


def one_row_to_rows(row: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one output row per dictionary of column expressions."""
    return row.select(F.inline(F.array(*(F.struct(*(c.alias(n) for n, c in r.items())) for r in rows))))


def preview(df: DataFrame, n: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows: by ``keys`` if given, else whatever the first tasks read."""
    return (df.orderBy(*keys) if keys else df).limit(n)


def profile_columns(df: DataFrame) -> DataFrame:
    """Each column's type and number of non-null values, in one pass."""
    counts = df.agg(*(F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)))
    return one_row_to_rows(
        counts,
        [
            {
                "column_name": F.lit(f.name),
                "data_type": F.lit(f.dataType.simpleString()),
                "non_null_count": F.col(f"c{i}"),
            }
            for i, f in enumerate(df.schema.fields)
        ],
    )


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 5, seed: int = 42) -> DataFrame:
    """``n`` random rows, the same ones for the same seed on any cluster layout.

    Rows are ordered by a digest of seed and ``keys``; each task keeps only its ``n`` smallest.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
    return df.orderBy(digest, *df.columns).limit(n)


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _is_whole(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType)


def _value_type(df: DataFrame, columns: Sequence[str]) -> str:
    """Of order statistics: exact decimals where all columns are integers, else doubles."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return "decimal(38,6)" if all(_is_whole(kinds[c]) for c in columns) else "double"


def _present(df: DataFrame, column: str) -> Column:
    """A column's value; NaN counts as missing, and numbers other than whole ones as doubles."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    return value if _is_whole(kind) else value.cast("double")


@dataclass(frozen=True)
class _Gap:
    """The values between two others (None: without an end), with the number of values below and in it."""

    low: object
    high: object
    under: int
    inside: int

    def within(self, value: Column) -> Column:
        ends = [value > F.lit(self.low)] * (self.low is not None) + [value < F.lit(self.high)] * (self.high is not None)
        return reduce(and_, ends, value.isNotNull())

    def holds(self, *ranks: int) -> bool:
        return any(self.under <= r < self.under + self.inside for r in ranks)


def _cuts(df: DataFrame, totals: dict[str, int], fractions: Sequence[float]) -> tuple[dict[str, list], dict[str, list[_Gap]]]:
    """Values that cut each column, and the gaps between them that are counted by value.

    A sketch, whose rank error is bounded, gives a value just below and one just above each wanted place. In the gap
    between them are at most ``6 / ACCURACY`` of the values. While that may be more than ``KEPT``, the
    cuts are counted exactly and a sketch of the gap gives nearer ones. Hot values become cuts themselves.
    """
    cuts: dict[str, set] = {c: set() for c in totals}
    kept: dict[str, list[_Gap]] = {c: [] for c in totals}
    todo = {(c, _Gap(None, None, 0, n)): list(fractions) for c, n in totals.items()}
    while todo:
        tasks = list(todo.items())
        sketches = []
        for i, ((c, gap), own) in enumerate(tasks):
            inside = [(f * (totals[c] - 1) - gap.under) / max(1, gap.inside - 1) for f in own]
            near = [min(1.0, max(0.0, f + side * 2 / ACCURACY)) for f in inside for side in (-1, 1)]
            value = _present(df, c)
            sketches.append(F.percentile_approx(F.when(gap.within(value), value), near, ACCURACY).alias(f"s{i}"))
        row = df.agg(*sketches).first()
        found, todo = [], {}
        for i, ((c, gap), own) in enumerate(tasks):
            ends = list(zip(row[f"s{i}"][::2], row[f"s{i}"][1::2], strict=True))
            cuts[c].update(v for pair in ends for v in pair)
            if gap.inside * 6 / ACCURACY <= KEPT:
                kept[c] += [_Gap(*pair, 0, 0) for pair in ends]
            else:
                found += [(c, f, *pair) for f, pair in zip(own, ends, strict=True) if pair[0] != pair[1]]
        if not found:
            break
        row = df.agg(*(
            F.count_if(test).alias(f"{label}{i}")
            for i, (c, _, low, high) in enumerate(found)
            for label, test in (("upto", _present(df, c) <= F.lit(low)), ("below", _present(df, c) < F.lit(high)))
        )).first()
        for i, (c, f, low, high) in enumerate(found):
            gap, place = _Gap(low, high, row[f"upto{i}"], row[f"below{i}"] - row[f"upto{i}"]), f * (totals[c] - 1)
            if not gap.holds(math.floor(place), math.ceil(place)):
                continue  # both are cuts
            if gap.inside <= KEPT:
                kept[c].append(gap)
            else:
                todo.setdefault((c, gap), []).append(f)
    return {c: sorted(own) for c, own in cuts.items()}, kept


def _statistics(df: DataFrame, columns: Sequence[str], *more: tuple[str, Callable[[Column], Column]]) -> dict[str, dict]:
    """Number of values, smallest and largest of each column, and further aggregates, in one pass."""
    wanted = [("n", F.count), ("low", F.min), ("high", F.max), *more]
    if not columns:
        return {}
    row = df.agg(*(stat(_present(df, c)).alias(f"{name}{i}") for i, c in enumerate(columns) for name, stat in wanted)).first()
    return {c: {name: row[f"{name}{i}"] for name, _ in wanted} for i, c in enumerate(columns)}


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float] = QUARTILES
) -> DataFrame:
    """Interpolated percentiles of each column: ``column_name``, ``fraction``, ``value``; null and NaN are left out.

    The built-in exact percentile keeps every distinct value of a column in one buffer, which an
    id column of a large table does not survive, and sorting all values shuffles the table. Here sketches find
    cuts around each wanted position, between which few values lie. The last pass counts each column's values, reduced on the map
    side: by value where a position may be, all others by the gap between cuts that they lie in. The position among
    them is a running sum. Columns that have few values need no cuts. The driver sees a few numbers for each column and fraction.
    """
    columns = list(dict.fromkeys(columns))
    df = _kept(df, columns)
    return _percentiles(df, columns, fractions, _statistics(df, columns))


def _kept(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns alone, written once: what the frame is made of is not made again in every pass."""
    if not columns:
        return df
    narrow = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    return storage.written(df.sparkSession, narrow, storage.scratch_folder(df.sparkSession, "numbers")).toDF(*columns)


def _percentiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[float], stats: dict[str, dict]) -> DataFrame:
    spark, value_type = df.sparkSession, _value_type(df, columns)
    native = "bigint" if value_type != "double" else "double"
    totals = {c: s["n"] for c, s in stats.items()}
    # columns of few rows, or of whole numbers in a narrow range, have few values
    wide = {c: s["n"] for c, s in stats.items() if s["n"] > KEPT and not (_is_whole(df.schema[c].dataType) and s["high"] - s["low"] < KEPT)}
    cuts, kept = _cuts(df, wide, fractions) if wide else ({}, {})
    wanted = [(i, c, float(f), float(f * (totals[c] - 1)) if totals[c] else None) for i, c in enumerate(columns) for f in fractions]
    positions = spark.createDataFrame(wanted, "place int, column_name string, fraction double, position double")

    # a value's slot among cuts and gaps is found before it is used: as part of every use the code would be too long to be compiled
    slots = {}
    for i, c in enumerate(columns):
        value, tests = F.col(f"v{i}"), [test for cut in cuts.get(c, []) for test in (F.col(f"v{i}") >= F.lit(cut), F.col(f"v{i}") > F.lit(cut))]
        slots[f"s{i}"] = reduce(add, (test.cast("int") for test in tests), F.lit(0))
    slotted = df.select(*(_present(df, c).alias(f"v{i}") for i, c in enumerate(columns))).withColumns(slots)

    def entry(i: int, c: str) -> Column:
        """The column's place, the slot of its value, and the value unless it is in a gap of no interest."""
        value, slot, own, gaps = F.col(f"v{i}"), F.col(f"s{i}"), cuts.get(c, []), kept.get(c, [])
        inside = value
        if own:
            between = ((2 * j, a, b) for j, (a, b) in enumerate(zip([None, *own], [*own, None], strict=True)))
            counted = [j for j, a, b in between if a is not None and b is not None and any(g.low <= a and b <= g.high for g in gaps)]
            inside = F.when((slot % 2 == 1) | slot.isin(counted), value)
        return F.when(value.isNotNull(), F.struct(F.lit(i).alias("place"), slot.alias("slot"), inside.cast(native).alias("value")))

    entries = [entry(i, c) for i, c in enumerate(columns)]
    counted = slotted.select(F.inline(F.array(*entries))).where("place IS NOT NULL").groupBy("place", "slot", "value").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("place").orderBy("slot", "value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("end", F.sum("n").over(upto))
    # a row for each column and fraction
    placed = F.broadcast(positions).join(placed, "place", "left")
    floor, ceil = F.floor("position"), F.ceil("position")

    # never seen, as the sketch's error is below the margin
    value = F.coalesce("value", F.raise_error(F.lit("a percentile lies outside its range")).cast(native))

    def at(position: Column) -> Column:
        return F.max(F.when((position >= F.col("end") - F.col("n")) & (position < F.col("end")), value)).cast(value_type)

    weight = F.col("position") - floor
    found = placed.groupBy("column_name", "fraction", weight.alias("weight")).agg(at(floor).alias("low"), at(ceil).alias("high"))
    step = (F.col("high") - F.col("low")) * F.col("weight").cast("decimal(7,6)" if value_type != "double" else "double")
    # equal neighbours may be infinite
    value = F.when(F.col("high") == F.col("low"), F.col("low")).otherwise(F.col("low") + step)
    return found.select("column_name", "fraction", value.cast(value_type).alias("value"))


def describe_numeric(df: DataFrame, digits: int = 6) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each numeric column; NaN counts as missing.

    Minimum, quartiles and maximum are exact: decimals if all numeric columns are integers, else doubles. Everything but
    the quartiles comes from one pass that runs at once, as the values around them are looked for by it.
    """
    names = _numeric(df)
    value_type = _value_type(df, names)
    df = _kept(df, names)
    stats = _statistics(df, names, ("mean", F.avg), ("std", F.stddev_samp))
    number = Decimal if value_type != "double" else float
    summary = [
        (c, s["n"], *(None if s[k] is None else float(s[k]) for k in ("mean", "std")), *(None if s[k] is None else number(s[k]) for k in ("low", "high")))
        for c, s in stats.items()
    ]
    schema = f"column_name string, non_null_count bigint, mean double, std double, min {value_type}, max {value_type}"
    rounded = {c: settle(F.col(c), digits) for c in ("mean", "std")}
    quartiles = (
        _percentiles(df, names, QUARTILES, stats)
        .groupBy("column_name")
        .agg(*(F.max(F.when(F.col("fraction") == q, F.col("value"))).alias(f"p{int(q * 100)}") for q in QUARTILES))
    )
    described = df.sparkSession.createDataFrame(summary, schema).withColumns(rounded)
    return described.join(F.broadcast(quartiles), "column_name", "left").select(
        "column_name", "non_null_count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )
