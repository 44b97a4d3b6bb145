"""Mixing sources to target weights, with DataFrame functions only.

Every source gets a weight and a share of the budget by it. A source gives each of its rows ``EPOCHS`` times at most;
what that leaves of the budget is shared again by weight among the others, until no target is above its limit. Within a
source rows stand in the order of a hash of seed and id. A target of e whole epochs and a rest takes each row e
times and then rows from the front until the rest is used up; the row at the cut gives its first words only, so
a source gives its target, rounded down, exactly.

The prefix sums are distributed. Hash keys are uniform, so equal ranges of them hold equally many rows: a
source is cut into one range for each ``RANGE`` rows, words are summed by range before anything moves, and the sums
of a source's ranges are added up. That tells in which range the budget ends, and only that one is sorted and
added up row by row; every other row is before or after the cut by its key. Rows that agree in id, source and size
are one row with a count until the end. To find the cuts no text moves: rows are id, source, size and key. The driver sees a
few numbers for each round of sharing, and how many sources each sorted range of them holds.

Defined results: a null text has no words, and such rows take 0. Null is a source of its own and comes last; a null id is hashed as an
empty string. Sources without words have target 0, an empty table gives an empty result. Repeated rows are rows of
their own. Further columns are ignored by :func:`shares` and returned by :func:`mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import filled, kept_table

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
BUDGET = 1.5  # times the words of all rows
EPOCHS = 2
SEED = 42
RANGE = 1 << 17  # rows that are sorted together, about

BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 32


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order, null last, from 0; counted over sorted ranges."""
    order = [F.col("source").asc_nulls_last()]
    ranged = kept_table(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before, offsets = 0, []
    for row in ranged.groupBy("part").count().orderBy("part").collect():  # a row for each range
        offsets.append((row["part"], before))
        before += row["count"]
    plan = F.broadcast(sources.sparkSession.createDataFrame(offsets, "part int, before bigint"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return ranged.join(plan, "part").withColumn("place", place).drop("part", "before")


def _level(sources: DataFrame, budget: float) -> float:
    """Words for each unit of weight where limits and weights together use up the budget."""
    level, full = 0.0, -1
    while True:
        limited = F.col("limit") <= F.lit(level) * F.col("weight")
        used, left, n = sources.agg(
            F.coalesce(F.sum(F.when(limited, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~limited, F.col("weight"))), F.lit(0)),
            F.count_if(limited),
        ).first()
        if n == full or not left:
            return level
        level, full = (budget - used) / left, n


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (source, source_size and more) with weight and target; a source has one row."""
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * epochs).cast("double")
    placed = kept_table(_numbered(sources).withColumn("weight", weight).withColumn("limit", limit), "mix-weights")
    total = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = _level(placed, budget * total)
    share = F.lit(level) * F.col("weight")
    return placed.withColumn("target", F.least("limit", share)).drop("place", "limit")


def _key(id_col: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    own, text, source = (F.col(f"`{c}`") for c in (id_col, text_col, source_col))
    size = F.regexp_count(filled(text), F.lit(WORD)).cast("long")
    return docs.select(own.alias("id"), source.cast("string").alias("source"), size.alias("size"), *more)


def _by_source(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
    """An inner join on the source, null included, and further columns; Spark chooses how, by size."""
    same = left["source"].eqNullSafe(right["source"])
    for name in more:
        same &= left[name] == right[name]
    return left.join(right, same).drop(right["source"], *(right[name] for name in more))


def cuts(
    counted: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS, seed: int = SEED
) -> DataFrame:
    """What each source gives, a row for each: source_size, target, times, and where the rest of its budget ends.

    ``counted`` holds id, source, size and the number n of such rows. ``cut`` is the (key, id, size) of the rows at the
    cut, ``left`` the words still to take there; both are null if nothing is left after whole epochs.
    """
    sources = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("rows"))
    whole = F.floor("target")
    times = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    planned = targets(sources, weights, budget, epochs).select(
        "source", "source_size", "target", F.ceil(F.col("rows") / RANGE).alias("ranges"), times.alias("times"),
        (whole - times * F.col("source_size")).alias("rest"),
    )
    planned = kept_table(planned, "mix-targets")

    first_bits = F.conv(F.substring("key", 1, KEY_BITS // 4), 16, 10).cast("long")
    placed = _by_source(counted, planned.where("rest > 0").select("source", "ranges", "rest")).withColumn("key", _key(F.col("id"), seed))
    placed = placed.withColumn("range", F.shiftright(first_bits * F.col("ranges"), KEY_BITS))
    words = F.col("size") * F.col("n")
    sums = placed.groupBy("source", "range", "rest").agg(F.sum(words).alias("words"))
    in_order = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("earlier", F.coalesce(F.sum("words").over(in_order), F.lit(0)))
    # the rest ends in one range of each source; only that one is sorted
    ending = sums.where("earlier < rest AND rest <= earlier + words").select("source", "range", "earlier")
    inside = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("earlier") + F.coalesce(F.sum(words).over(inside), F.lit(0))
    sorted_rows = _by_source(placed, ending, "range").withColumn("before", before)
    at_cut = sorted_rows.where(F.col("before") < F.col("rest")).where(F.col("rest") <= F.col("before") + words)
    found = at_cut.select("source", F.struct("key", "id", "size").alias("cut"), (F.col("rest") - F.col("before")).alias("left"))
    joined = planned.join(found, planned["source"].eqNullSafe(found["source"]), "left").drop(found["source"])
    return kept_table(joined.drop("ranges", "rest"), "mix-cuts")


def _taken_once(place: Column, copy: Column) -> Column:
    """Words of a row that the rest of the budget takes; ``copy`` counts rows at the same place from 0."""
    at_cut = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.col("left") - copy * F.col("size")))
    return F.when(place < F.col("cut"), F.col("size")).when(place == F.col("cut"), at_cut).otherwise(0)


def shares(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, **options
) -> DataFrame:
    """(id, size, source_size, target, taken) for every row; ``taken`` counts repeats."""
    rows = _rows(docs, id_col, text_col, source_col)
    counted = kept_table(rows.groupBy("id", "source", "size").agg(F.count("*").alias("n")), "mix-rows")
    copies = _by_source(counted, cuts(counted, seed=seed, **options)).withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    )
    once = _taken_once(F.struct(_key(F.col("id"), seed).alias("key"), "id", "size"), F.col("copy"))
    taken = (F.col("times") * F.col("size") + once).cast("long")
    return copies.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, **options
) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, as often as they are taken; texts at a cut are shortened.

    A shortened text ends with its last word that is taken. Rows without words are not in the mix.
    """
    columns = docs.columns
    rows = _rows(docs, id_col, text_col, source_col, F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))
    counted = rows.groupBy("id", "source", "size").agg(F.count("*").alias("n"))
    found = _by_source(rows, cuts(kept_table(counted, "mix-rows"), seed=seed, **options))
    found = found.withColumn("place", F.struct(_key(F.col("id"), seed).alias("key"), "id", "size"))
    # only rows at a cut are numbered; they agree in id, source and size
    tied = Window.partitionBy("source").orderBy(F.col(f"row.`{text_col}`"))
    at_cut = found.where(F.col("place") == F.col("cut")).withColumn("copy", F.row_number().over(tied) - 1)
    others = found.where(F.coalesce(F.col("place") != F.col("cut"), F.lit(True))).withColumn("copy", F.lit(0))
    once = _taken_once(F.col("place"), F.col("copy"))
    all_words = F.array_repeat("size", F.col("times").cast("int"))
    takes = at_cut.unionByName(others).withColumn("takes", F.explode(F.concat(all_words, F.array(once)))).where("takes > 0")
    text = F.col(f"row.`{text_col}`")
    first_words = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"{BLANKS}*{WORD}"), F.lit(0)), 1, F.col("takes").cast("int")), "")
    text = F.when(F.col("takes") < F.col("size"), first_words).otherwise(text)
    return takes.select(*((text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in columns))
