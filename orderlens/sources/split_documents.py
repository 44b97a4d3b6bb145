"""Large order documents, cut between their orders, so that many tasks read and parse one document.

1. A file is read in the splits that Spark makes of it, as fragments that end with a closing brace. Each fragment
   counts its quotes, and its brackets outside of strings, for a start outside and for one inside a string.
2. The fragments of a split become one row, the only time that the text is shuffled. Prefix sums within the split tell how
   deep each fragment ends, for both starts; prefix sums over the splits of a file, how every split begins. An order ends
   where a brace closes to the depth of the list of orders.
3. Each split is cut behind the orders that end in it. What it has of its first and of its last order comes together with
   the neighbouring splits' by the order's number; the others are whole. Each becomes a document of one order. What the cut
   leaves, the text before the first order, between two and behind the last, must be just the list's own punctuation; each
   order is parsed strictly. So a cut document is sound if its parts are, however it was cut.

A file that is anything else - no orders, further fields, one document behind another, compressed, not in UTF-8 - is
parsed whole, in one task, by the rules of :func:`parse_orders`. Empty and blank files are no documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens import storage
from orderlens.sources.documents import parse_orders

STRING = r'"[^"]*+(?:"|\z)'
ESCAPED = r"(?s)\\."
BLANK = r"[ \t\r\n]*"
FIRST = rf'^{BLANK}\{{{BLANK}"orders"{BLANK}:{BLANK}\[{BLANK}(?=\{{)'
NEXT = rf"^{BLANK},{BLANK}(?=\{{)"
LAST = rf"^{BLANK}\]{BLANK}\}}{BLANK}\z"
LISTED = 2  # brackets open between two orders
SPLIT = ["file", "split"]


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Fragments with their place, quotes and net brackets before the closing brace; in a split, in the order of ``n``."""

    def times(text: Column, *letters: str) -> Column:
        without = reduce(lambda rest, letter: F.replace(rest, F.lit(letter)), letters, text)
        return (F.octet_length(text) - F.octet_length(without)).cast("int")

    def opened(text: Column) -> Column:
        return times(text, "[", "{") - times(text, "]")

    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", ESCAPED, "")).otherwise(F.col("value"))
    read = spark.read.option("lineSep", "}").text(path).select(
        storage.file_path().alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"),
        "value",
        F.col("_metadata.file_size").alias("file_size"),
        (F.octet_length("value") + F.lit(1)).cast("bigint").alias("size"),
        plain.alias("plain"),
    )
    # what is in a string for a start outside is outside of it for a start inside
    parted = read.withColumns({"outside": F.regexp_replace("plain", STRING, ""), "quotes": times(F.col("plain"), '"')})
    counted = {"from_outside": opened(F.col("outside")), "from_string": opened(F.col("plain")) - opened(F.col("outside"))}
    return parted.withColumns(counted).drop("plain", "outside")


def _before(df: DataFrame, totals: dict[str, str]) -> DataFrame:
    """A row per file and split with the sums of columns over the file's splits before it."""
    ahead = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({name: F.coalesce(F.sum(total).over(ahead), F.lit(0)) for name, total in totals.items()})


def _joined(fragments: DataFrame) -> DataFrame:
    """A row for each split: its fragments in order, and the depths that those end at, for both starts; none in a string."""
    order = Window.partitionBy(*SPLIT).orderBy("n")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    through = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = fragments.withColumn("earlier", F.coalesce(F.sum("quotes").over(ahead), F.lit(0)))
    for start in (0, 1):  # quotes before the split, modulo 2
        inside, closing = (F.col("earlier") + start) % 2, (F.col("earlier") + F.col("quotes") + start) % 2 == 0
        change = F.when(inside == 0, F.col("from_outside")).otherwise(F.col("from_string")) - closing.cast("int")
        found = found.withColumns({f"change_{start}": change, f"closing_{start}": closing})
    found = found.withColumns({f"depth_{start}": F.sum(f"change_{start}").over(through) for start in (0, 1)})
    depths = (F.when(F.col(f"closing_{start}"), F.col(f"depth_{start}").cast("int")).alias(f"depths_{start}") for start in (0, 1))
    parts = F.array_sort(F.collect_list(F.struct("n", F.col("value").alias("texts"), *depths)))
    sums = (F.sum(c).alias(c) for c in ("quotes", "change_0", "change_1", "size"))
    splits = found.groupBy(*SPLIT).agg(parts.alias("parts"), *sums, F.first("file_size").alias("file_size"))
    return splits.select("*", *(f"parts.{name}" for name in ("texts", "depths_0", "depths_1"))).drop("parts")


def _ends(depths: Column, listed: Column) -> Column:
    """The numbers, from 1, of the fragments that end an order."""
    number = F.transform(depths, lambda depth, i: F.when(depth == listed, i + 1))
    return F.filter(number, F.isnotnull)


def _placed(joined: DataFrame) -> DataFrame:
    """Of each split, how it begins, the orders that end in it and before it, and those of the file; ``whole``: all of it was read."""
    splits = _before(joined.select(*SPLIT, "quotes", "change_0", "change_1", "size", "file_size"), {"quotes_before": "quotes"})
    odd = F.col("quotes_before") % 2 == 1
    splits = splits.withColumns({"odd": odd, "change": F.when(odd, F.col("change_1")).otherwise(F.col("change_0"))})
    splits = _before(splits, {"above": "change"}).select(*SPLIT, "odd", (LISTED - F.col("above")).alias("listed"), "size", "file_size")
    depths = joined.select(*SPLIT, "depths_0", "depths_1").join(splits, SPLIT)
    ended = F.size(_ends(F.when(F.col("odd"), F.col("depths_1")).otherwise(F.col("depths_0")), F.col("listed")))
    counted = _before(depths.select(*splits.columns, ended.cast("bigint").alias("ended")), {"ended_before": "ended"})
    of_file = Window.partitionBy("file")
    beyond = F.sum("size").over(of_file) - F.col("file_size")  # the reader does not tell whether the file ends with a brace, its size does
    return counted.select(
        *SPLIT, "odd", "listed", "ended", "ended_before", F.sum("ended").over(of_file).alias("n_orders"),
        (beyond == 0).alias("shut"), beyond.isin(0, 1).alias("whole"),
    )


def _cut(joined: DataFrame, placed: DataFrame) -> DataFrame:
    """What each split has of its orders, and of what is left as the last piece; ``inner``: all of the order, ``sound`` if it is just behind another."""
    both = joined.select(*SPLIT, "texts", "depths_0", "depths_1").join(placed, SPLIT)
    ends = _ends(F.when(F.col("odd"), F.col("depths_1")).otherwise(F.col("depths_0")), F.col("listed"))
    spans = F.arrays_zip(F.concat(F.array(F.lit(0)), ends).alias("low"), F.array_union(ends, F.array(F.size("texts"))).alias("high"))
    # behind the last order, if nothing is left, there is no end and so no text
    texts = F.transform(spans, lambda s: F.array_join(F.slice("texts", s["low"] + 1, s["high"] - s["low"]), "}"))
    cut = both.select(*SPLIT, "ended", "ended_before", "n_orders", "shut", "whole", F.posexplode(texts).alias("at", "text"))
    inner = (F.col("at") > 0) & (F.col("at") < F.col("ended"))
    return cut.where("text is not null").select(
        *SPLIT, (F.col("ended_before") + F.col("at")).alias("piece"), "text", "n_orders", "shut", "whole",
        inner.alias("inner"), F.when(inner, F.col("text").rlike(NEXT)).alias("sound"),
    )


def read_orders_split(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files of one document each, as rows of ``orders``: one order a row, or all of a document that is parsed whole.

    Whatever does not parse is an error. The text is shuffled once and written twice to the scratch folder, the first time until
    it is written again; the fragments of a split, and an order, must fit in one task. For small documents
    ``read_orders_json(multi_line=True)`` is cheaper. Which files are parsed whole is found out when this is called; their names go
    through the driver.
    """
    scratch = storage.scratch_folder(spark, "split-documents")
    with storage.tidy_shuffles(spark):
        joined = storage.written(spark, _joined(_fragments(spark, path)), f"{scratch}/joined", compression="zstd")
        placed = storage.written(spark, _placed(joined), f"{scratch}/placed")
        pieces = storage.written(spark, _cut(joined, placed), f"{scratch}/pieces", compression="zstd")
    storage.delete(spark, f"{scratch}/joined")
    storage.delete(spark, f"{scratch}/placed")

    of_file = ("n_orders", "shut", "whole")
    inner = pieces.where("inner")
    parts = F.array_sort(F.collect_list(F.struct("split", "text")))
    outer = pieces.where("not inner").groupBy("file", "piece").agg(parts.alias("parts"), *(F.first(c).alias(c) for c in of_file))
    first, last = F.col("piece") == 0, F.col("piece") == F.col("n_orders")
    shut = F.when(~last | F.col("shut"), F.lit("}")).otherwise(F.lit(""))
    outer = outer.select("file", "piece", F.concat(F.array_join("parts.text", "}"), shut).alias("text"), "n_orders", "whole")
    sound = F.when(last, F.col("text").rlike(LAST)).when(first, F.col("text").rlike(FIRST)).otherwise(F.col("text").rlike(NEXT))
    judged = outer.select("file", "whole", "n_orders", sound.alias("sound"), last.alias("last"))
    judged = judged.union(inner.select("file", "whole", "n_orders", "sound", F.lit(False)))
    fits = F.bool_and(F.col("sound") & F.col("whole")) & F.bool_or("last") & (F.max("n_orders") > 0)
    others = [row["file"] for row in judged.groupBy("file").agg(fits.alias("fits")).where(~F.col("fits")).collect()]

    order = F.regexp_replace("text", F.when(first, F.lit(FIRST)).otherwise(F.lit(NEXT)), F.lit(""))
    cut = outer.where(~last).select("file", order.alias("text"))
    cut = cut.union(inner.select("file", F.concat(F.regexp_replace("text", NEXT, ""), F.lit("}"))))
    if others:
        odd = spark.createDataFrame([(name,) for name in others], "file string")
        cut = cut.join(F.broadcast(odd), "file", "left_anti")  # else the text would be shuffled
    found = [parse_orders(cut.select(F.concat(F.lit('{"orders":['), "text", F.lit("]}")).alias("value")), "value")]
    if others:
        found.append(parse_orders(spark.read.text(others, wholetext=True), "value"))
    return reduce(DataFrame.unionByName, found)
