"""Every operator and report as a query over the star-schema tables.

Each query derives its input from the whole tables with :func:`order_items`, asking only for the
columns it needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import storage
from orderlens.functions import readable_quantity, safe_int, safe_str, to_raw_orders
from orderlens.functions.labels import RATE_BUCKETS
from orderlens.operators import (
    build_marts,
    cast_losses,
    dedupe_latest,
    department_analytics,
    describe_numeric,
    distinct_sketches,
    hourly_analytics,
    mart_grain,
    marts_from_grain,
    merge_sketches,
    preview,
    product_analytics,
    profile_columns,
    read_quarantine,
    roll_up_departments,
    sample_rows,
    sketched_counts,
    validate_raw,
)
from orderlens.plans import REPORTS, load_tables, process_lake, run, run_refresh
from orderlens.schema import DOCUMENT, ORDER, PRODUCT_IN_ORDER, RAW
from orderlens.session import tune
from orderlens.sinks import ensure_tables, load_report, read_table, read_tables, refresh_table, table_counts
from orderlens.sources import (
    cleanup_lake,
    flatten_orders,
    land_batch,
    list_batches,
    parse_orders,
    read_batch,
    read_lake,
    read_orders_json,
    read_orders_split,
    require_non_empty,
    with_ingestion_ts,
)
from orderlens.sources.star_tables import STAMP, order_items
from orderlens.streaming import incremental_refresh, stream_hourly_counts, stream_refresh

Query = Callable[[SparkSession, str], DataFrame]

MARTS: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
    "product_analytics": (product_analytics, ("order_id", "product_name", "department", "reordered")),
    "hourly_analytics": (hourly_analytics, ("order_id", "order_hour_of_day")),
    "department_analytics": (department_analytics, ("order_id", "department")),
}
STAR_TABLES = ("lineitem", "orders", "part", "events")
ROW_KEYS = ("order_id", "product_id", "add_to_cart_order", "reordered")


def _mart(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    build, columns = MARTS[table]
    return build(order_items(spark, sf_dir, columns))


def _report(spark: SparkSession, sf_dir: str, name: str, **params) -> DataFrame:
    report = REPORTS[name]
    if report.table == "raw_orders":
        source = order_items(spark, sf_dir, report.columns)
    else:
        source = _mart(spark, sf_dir, report.table)
    return run(name, {report.table: source}, **params)


ORDER_FIELDS = [f for f in ORDER.fields if f.name != "products"]


def _orders(spark: SparkSession, sf_dir: str, per_document: int) -> DataFrame:
    """Whole orders: their fields and the list of their products, as long as an order has lines; ``part`` numbers documents.

    The rows are dealt by document, which serves the grouping by order and that by document.
    """
    product = F.struct(*PRODUCT_IN_ORDER.fieldNames())
    part = (F.col("order_id") / per_document).cast("bigint")
    dealt = order_items(spark, sf_dir).withColumn("part", part).repartition("part")
    return dealt.groupBy("part", *(f.name for f in ORDER_FIELDS)).agg(F.collect_list(product).alias("products"))


def _documents(spark: SparkSession, sf_dir: str, per_document: int) -> DataFrame:
    """JSON documents of neighbouring orders, each with one more order without products: ``part``, ``value``."""
    kinds = {f.name: f.dataType for f in RAW.fields}
    full = F.struct(*ORDER.fieldNames())
    rest = (F.lit(None).cast(kinds[f.name]).alias(f.name) for f in ORDER_FIELDS[1:])
    bare = F.struct(F.lit(-1).cast("bigint").alias("order_id"), *rest, F.slice("products", 1, 0).alias("products"))
    listed = F.concat(F.collect_list(full), F.array(F.any_value(bare)))
    document = F.struct(listed.alias(DOCUMENT.fieldNames()[0]))
    return _orders(spark, sf_dir, per_document).groupBy("part").agg(F.to_json(document).alias("value"))


def document_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """One document per line, in compressed files."""
    path = f"{folder}/documents"
    _documents(spark, sf_dir, 3).select("value").write.text(path, compression="lz4")
    return path


def _a_file_each(texts: DataFrame, folder: str) -> None:
    """Each row as a file of its own, in one folder; the tasks move their files into place."""
    with storage.tidy_shuffles(texts.sparkSession):
        texts.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)


def parsed_and_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = parse_orders(_documents(spark, sf_dir, 3), "value")
    return with_ingestion_ts(flatten_orders(documents), STAMP)


def files_read_and_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(spark, sf_dir, storage.scratch_folder(spark, "read"))
    return with_ingestion_ts(flatten_orders(read_orders_json(spark, files)), STAMP)


def whole_files_read_and_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file is one document, of up to 500 orders; some do not parse and are set aside."""
    folder = storage.scratch_folder(spark, "read")
    value = F.explode(F.array("value", F.lit('{"orders": [')))
    _a_file_each(_documents(spark, sf_dir, 500).select(value), folder)
    read = read_orders_json(spark, folder, multi_line=True, rejects=f"{folder}-rejects")
    return with_ingestion_ts(flatten_orders(read), STAMP)


LANDED = 4 << 30  # bytes of documents that are files at a time: these are ten times as large as their tables


def large_files_cut_and_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file is one document, of up to 5,000 orders, cut between them; some have no orders and are parsed whole.

    Beyond ``LANDED`` bytes the files of some documents are read before those of others land.
    """
    folder = storage.scratch_folder(spark, "read")
    with storage.tidy_shuffles(spark):
        documents = storage.written(spark, _documents(spark, sf_dir, 5000), f"{folder}/documents", compression="zstd")
    size = documents.agg(F.sum(F.octet_length("value").cast("bigint"))).first()[0] or 0
    value = F.explode(F.array("value", F.lit('{"orders": []}')))

    def read(landing: DataFrame, files: str) -> DataFrame:
        _a_file_each(landing.select(value), files)
        return with_ingestion_ts(flatten_orders(read_orders_split(spark, files)), STAMP)

    polls = -(-size // LANDED)
    if polls <= 1:
        return read(documents, f"{folder}/0")
    poll = F.pmod(F.coalesce("part", F.lit(0)), F.lit(polls))
    for i in range(polls):
        items = read(documents.where(poll == i), f"{folder}/{i}")
        with storage.tidy_shuffles(spark):
            items.write.mode("append").parquet(f"{folder}/items")
        storage.delete(spark, f"{folder}/{i}")
    return spark.read.schema(items.schema).parquet(f"{folder}/items")


def nested_and_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without text in between: numbers as variants, as the document schema has them."""
    orders = F.collect_list(F.struct(*ORDER.fieldNames())).cast(DOCUMENT["orders"].dataType).alias("orders")
    documents = _orders(spark, sf_dir, 3).groupBy("part").agg(orders)
    return with_ingestion_ts(flatten_orders(documents), STAMP)


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = order_items(spark, sf_dir, ("order_id", "product_id"))
    return with_ingestion_ts(require_non_empty(items), "2024-05-01 12:00:00")


def landed_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch landed twice under one id counts once."""
    lake = storage.scratch_folder(spark, "lake")
    for _ in range(2):
        land_batch(order_items(spark, sf_dir), lake, batch_id="20240101_000000")
    return read_lake(spark, lake)


def lake_of_many_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches as other writers leave them, whole numbers in 64 bits or a float interval, beside an own one."""
    lake = storage.scratch_folder(spark, "lake")
    raw = order_items(spark, sf_dir)
    part = F.col("order_id") % 3
    whole = {f.name: F.col(f.name).cast("bigint") for f in RAW.fields if f.dataType.simpleString() == "int"}
    first = raw.where("days_since_prior_order is null").where(part != 0)
    raw.where("days_since_prior_order is not null").where(part != 0).withColumns(whole).write.parquet(f"{lake}/orders_1.parquet")
    floating = whole | {"days_since_prior_order": F.col("days_since_prior_order").cast("double")}
    first.withColumns(floating).write.parquet(f"{lake}/orders_2.parquet")
    land_batch(raw.where(part == 0).where("order_id % 2 = 0"), lake)
    # and one batch that holds files of both kinds
    both, rest = f"{lake}/orders_4.parquet", raw.where(part == 0).where("order_id % 2 <> 0")
    rest.where("days_since_prior_order is not null").write.parquet(both)
    rest.where("days_since_prior_order is null").withColumns(floating).write.mode("append").parquet(both)
    return read_lake(spark, lake)


def foreign_file_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose writer stored every number as float."""
    file = f"{storage.scratch_folder(spark, 'foreign')}/orders.parquet"
    raw = order_items(spark, sf_dir)
    numbers = {c: F.col(c).cast("double") for c, kind in raw.dtypes if kind != "string"}
    raw.withColumns(numbers).write.parquet(file)
    return read_batch(spark, file)


def lake_after_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that arrives after the listing survives the cleanup of the listed one."""
    lake = storage.scratch_folder(spark, "lake")
    land_batch(order_items(spark, sf_dir), lake)
    listed = list_batches(spark, lake)
    land_batch(with_ingestion_ts(order_items(spark, sf_dir), "2024-01-02 00:00:00"), lake)
    cleanup_lake(spark, listed)
    return read_lake(spark, lake).groupBy("ingestion_timestamp").agg(F.count(F.lit(1)).alias("total_rows"))


def one_table_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table, replaced by its repeat orders and then by all rows, clustered."""
    warehouse = storage.scratch_folder(spark, "warehouse")
    refresh_table(order_items(spark, sf_dir).filter("reordered = 1"), warehouse, "raw_orders")
    refresh_table(order_items(spark, sf_dir), warehouse, "raw_orders", cluster=True)
    return read_table(spark, warehouse, "raw_orders")


def one_table_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables loaded, then one replaced by a frame without rows."""
    warehouse = storage.scratch_folder(spark, "warehouse")
    load_tables(order_items(spark, sf_dir), warehouse)
    refresh_table(read_table(spark, warehouse, "hourly_analytics").limit(0), warehouse, "hourly_analytics")
    return load_report(spark, warehouse)


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table through the catalog, which was attached while it was empty."""
    warehouse = storage.scratch_folder(spark, "warehouse")
    database = f"orderlens_{uuid.uuid4().hex}"
    ensure_tables(spark, warehouse, database)
    for _ in range(2):
        refresh_table(order_items(spark, sf_dir), warehouse, "raw_orders")
    return spark.sql(f"SELECT * FROM {database}.raw_orders")


def landed_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = storage.scratch_folder(spark, "lake")
    land_batch(order_items(spark, sf_dir), lake)
    return read_lake(spark, lake)


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    folder = storage.scratch_folder(spark, "refresh")
    files = document_files(spark, sf_dir, folder)
    warehouse = f"{folder}/warehouse"
    return run_refresh(spark, files, f"{folder}/lake", warehouse, ts=STAMP, cluster=True), warehouse


def refreshed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _refreshed(spark, sf_dir)[1], "raw_orders")


def refreshed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _refreshed(spark, sf_dir)[1], "product_analytics")


def refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir)[0]


def streamed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run dies on one batch, another lands, and the next run replays the first and loads both."""
    folder = storage.scratch_folder(spark, "stream")
    raw = order_items(spark, sf_dir)
    land_batch(raw.where("order_id % 2 = 0"), f"{folder}/lake")
    storage.write_text(spark, f"{folder}/file", "no folder")
    try:
        stream_refresh(spark, f"{folder}/lake", f"{folder}/file/warehouse", f"{folder}/checkpoint")
        raise AssertionError("a warehouse below a file was written")
    except StreamingQueryException:
        pass
    land_batch(raw.where("order_id % 2 <> 0"), f"{folder}/lake")
    stream_refresh(spark, f"{folder}/lake", f"{folder}/warehouse", f"{folder}/checkpoint")
    return read_table(spark, f"{folder}/warehouse", "raw_orders")


def _in_increments(spark: SparkSession, sf_dir: str) -> str:
    """Three batches, one after each run; the second is loaded again, as if its run had died before it was recorded."""
    folder = storage.scratch_folder(spark, "increments")
    raw = order_items(spark, sf_dir)
    warehouse, checkpoint = f"{folder}/warehouse", f"{folder}/checkpoint"
    for part in range(3):
        land_batch(raw.where(F.pmod("order_id", F.lit(3)) == part), f"{folder}/lake")
        if part == 2:
            storage.delete(spark, f"{checkpoint}/commits/1")
            storage.delete(spark, f"{checkpoint}/commits/.1.crc")
        incremental_refresh(spark, f"{folder}/lake", warehouse, checkpoint)
    return warehouse


def rows_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _in_increments(spark, sf_dir), "raw_orders")


def marts_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _side_by_side(read_tables(spark, _in_increments(spark, sf_dir)))


def events_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in files by time, streamed in micro-batches of two files over two runs."""
    folder = storage.scratch_folder(spark, "events")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(second), F.max(second)).first()
    part = F.floor((second - F.lit(first)) * 6 / F.lit(last - first + 1))
    for number in range(6):
        events.where(part == number).coalesce(1).write.parquet(f"{folder}/in/{number}")
        if number in (2, 5):
            found = stream_hourly_counts(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", files_at_once=2)
    return found


def safe_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cast on floats, padded text, text with a fraction and text that is no number."""
    key = F.col("event_id").cast("string")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        safe_int("value").alias("from_float"),
        safe_int(-F.col("value")).alias("from_negative"),
        safe_int(F.concat(F.lit(" "), key, F.lit(" "))).alias("from_padded"),
        safe_int(F.concat(key, F.lit(".7"))).alias("from_fraction_text"),
        safe_int("event_type").alias("from_word"),
        safe_int(F.lit(float("nan"))).alias("from_nan"),
        safe_int("user_id", "tinyint").cast("int").alias("from_wide"),
    )


def safe_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        safe_str("event_type").alias("from_text"),
        safe_str(F.when(F.col("event_id") % 3 == 0, F.col("user_id"))).alias("from_number"),
        safe_str(F.when(F.col("event_id") % 2 == 0, F.lit(float("nan"))), floating=True).alias("from_nan"),
    )


def both_copies_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row landed twice, the second time a day later and with one position more."""
    first = order_items(spark, sf_dir)
    second = first.withColumn("ingestion_timestamp", F.lit("2024-01-02 00:00:00")).withColumn(
        "add_to_cart_order", F.col("add_to_cart_order") + 1
    )
    return dedupe_latest(first.unionByName(second))


def rows_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on rows with empty users, departments and hours beyond the column's range."""
    raw = order_items(spark, sf_dir)
    return validate_raw(
        raw.withColumn("user_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id")))
        .withColumn("department", F.when(F.col("order_dow") != 3, F.col("department")))
        .withColumn("order_hour_of_day", F.col("order_hour_of_day") + 240)
        .withColumn("reordered", F.col("reordered") - 1)
    )


def values_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values beyond the lake's types, as another writer may hold them."""
    raw = order_items(spark, sf_dir)
    return cast_losses(
        raw.withColumn("days_since_prior_order", F.col("days_since_prior_order") * 1e8)
        .withColumn("add_to_cart_order", F.concat("add_to_cart_order", F.when(F.col("reordered") == 1, "x").otherwise("")))
    )


def rows_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the set of rules they break, loaded ones among them; one of two writers has wider types, and a load is retried."""
    folder = storage.scratch_folder(spark, "quarantine")
    raw = storage.written(spark, order_items(spark, sf_dir), f"{folder}/items")
    faulty = raw.withColumn("user_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id"))).withColumn(
        "order_hour_of_day", F.col("order_hour_of_day") + 240
    )
    wide = faulty.withColumn("days_since_prior_order", F.col("days_since_prior_order") * 1e8)
    even = F.col("order_id") % 2 == 0
    for _ in range(2):
        land_batch(faulty.where(even), f"{folder}/lake", batch_id="1")
        wide.where(~even).write.mode("overwrite").parquet(f"{folder}/lake/orders_2.parquet")
        process_lake(spark, f"{folder}/lake", f"{folder}/warehouse", quarantine=f"{folder}/faulty")
    aside = read_quarantine(spark, f"{folder}/faulty").select("batch", F.concat_ws("; ", "broken").alias("broken"))
    loaded = read_table(spark, f"{folder}/warehouse", "raw_orders").select(
        F.when(even, "orders_1.parquet").otherwise("orders_2.parquet").alias("batch"), F.lit("").alias("broken")
    )
    return aside.unionByName(loaded).groupBy("batch", "broken").agg(F.count(F.lit(1)).alias("total_rows"))


ERROR = 0.04  # of a sketched count, five times the mean error


def sketches_rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts by department, and of all, from sketches by department and hour, within ERROR of the exact ones."""
    items = order_items(spark, sf_dir, ("department", "order_hour_of_day", "order_id", "user_id", "product_id"))
    keys = ("order_id", "user_id", "product_id")
    folder = storage.scratch_folder(spark, "sketches")
    fine = storage.written(spark, distinct_sketches(items, ("department", "order_hour_of_day"), keys), folder)
    by_department = merge_sketches(fine, ("department",), keys)
    whole = merge_sketches(by_department, (), keys).select(F.lit("all").alias("department"), "*")
    exact = [
        items.select(name, *keys).groupBy("department").agg(*(F.count_distinct(k).alias(k) for k in keys))
        for name in (F.col("department"), F.lit("all").alias("department"))
    ]
    both = sketched_counts(by_department.unionByName(whole), keys).join(exact[0].unionByName(exact[1]), "department")
    near = {f"{k}_near": F.abs(F.col(f"{k}_count") - F.col(k)) <= F.lit(ERROR) * F.col(k) for k in keys}
    return both.withColumns(near).select("department", *keys, *near)


def all_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of each mart, all from the shared aggregate."""
    return _side_by_side(build_marts(order_items(spark, sf_dir)))


def _side_by_side(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of all marts under the columns of all."""
    columns = {c: kind for name in MARTS for c, kind in tables[name].dtypes}
    wide = [
        tables[name].select(
            F.lit(name).alias("table_name"),
            *(F.col(c) if c in tables[name].columns else F.lit(None).cast(kind).alias(c) for c, kind in columns.items()),
        )
        for name in MARTS
    ]
    return wide[0].unionByName(wide[1]).unionByName(wide[2])


def rolled_up_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("order_id", "product_name", "department", "order_hour_of_day", "reordered")
    return marts_from_grain(mart_grain(order_items(spark, sf_dir, columns)))["product_analytics"]


def star_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in STAR_TABLES})


def readable_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of lines of each quantity, scaled to reach every unit."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    counts = lines.groupBy(F.col("l_linenumber").alias("line")).agg(F.count(F.lit(1)).alias("n"))
    return scaled_counts(storage.written(spark, counts, storage.scratch_folder(spark, "counts")))


def scaled_counts(counts: DataFrame) -> DataFrame:
    """Each count ``n`` of a ``line`` times powers of ten, with its text; decimals hold what does not fit in 64 bits."""
    powers = [10**p for p in range(0, 13, 2)]
    largest = (counts.agg(F.max("n")).first()[0] or 0) * powers[-1]
    n = F.col("n") if largest < 1 << 63 else F.col("n").cast("decimal(19,0)")
    times = F.explode(F.array(*map(F.lit, powers))).alias("times")
    scaled = counts.select("line", "n", times).select("line", "times", (n * F.col("times")).alias("quantity"))
    return scaled.select("line", "times", "quantity", readable_quantity(F.col("quantity")).alias("quantity_text"))


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def queries() -> dict[str, Query]:
    """Query name to ``(spark, sf_dir) -> DataFrame``."""
    raw = order_items
    found: dict[str, Query] = {name: partial(_report, name=name) for name in REPORTS}
    found |= {name: partial(_mart, table=name) for name in MARTS}
    found |= {
        # other thresholds, where the defaults select everything at small scale
        "a2_top_reorder_min_60": partial(_report, name="a2_top_reorder", min_orders=60, n=25),
        "a6_top_2_per_department": partial(_report, name="a6_top_per_department", n=2),
        "a7_evergreen_min_80": partial(_report, name="a7_evergreen", min_orders=80),
        "a8_five_buckets": partial(
            _report,
            name="a8_rate_buckets",
            floors=((0.9, "Very High (>=90%)"), (0.8, "High (80-89%)"), *RATE_BUCKETS[1:]),
        ),
        "c2_concentration_2400": partial(_report, name="c2_concentration", threshold=2400),
        "c3_zscore_1": partial(_report, name="c3_zscore", z=1),
        "c5_gap_to_zero": partial(_report, name="c5_gap_to_next", lead_default=0),
        "i6_share_with_others_4": partial(_report, name="i6_share_with_others", min_pct=4),
        "d7_consistent_users_min_70": partial(_report, name="d7_consistent_users", min_items=70, n=50),
        "d12_basket_depth_2_5": partial(_report, name="d12_basket_depth", edges=(2, 5)),
        # sources, casts, marts, sinks
        "parse_orders": parsed_and_flattened,
        "flatten_orders": nested_and_flattened,
        "with_ingestion_ts": stamped,
        "land_batch": landed_again,
        "read_batch": foreign_file_read,
        "cleanup_lake": lake_after_cleanup,
        "refresh_table": one_table_refreshed,
        "refresh_empty": one_table_emptied,
        "ensure_tables": catalog_table,
        "roll_up_departments": lambda spark, sf_dir: roll_up_departments(_mart(spark, sf_dir, "product_analytics")),
        "read_orders_json": files_read_and_flattened,
        "read_orders_json_whole_files": whole_files_read_and_flattened,
        "read_orders_split": large_files_cut_and_flattened,
        "read_lake": landed_and_read,
        "read_lake_mixed": lake_of_many_writers,
        "safe_int": safe_integers,
        "safe_str": safe_strings,
        "to_raw_orders": lambda spark, sf_dir: to_raw_orders(raw(spark, sf_dir)),
        "build_marts": all_marts,
        "marts_from_grain": rolled_up_products,
        "dedupe_latest": both_copies_deduplicated,
        "run_refresh": refreshed_items,
        "run_refresh_products": refreshed_products,
        "load_report": refresh_counts,
        "stream_refresh": streamed_twice,
        "incremental_refresh": rows_in_increments,
        "incremental_marts": marts_in_increments,
        "stream_hourly_counts": events_by_hour,
        # profiling and checks
        "preview": lambda spark, sf_dir: preview(raw(spark, sf_dir), 5, ROW_KEYS),
        "profile_columns": lambda spark, sf_dir: profile_columns(raw(spark, sf_dir)),
        "sample_rows": lambda spark, sf_dir: sample_rows(raw(spark, sf_dir), ROW_KEYS),
        "describe_numeric": lambda spark, sf_dir: describe_numeric(raw(spark, sf_dir)),
        "validate_raw": rows_with_faults,
        "set_aside": rows_set_aside,
        "distinct_sketches": sketches_rolled_up,
        "cast_losses": values_lost,
        "table_counts": star_table_counts,
        "readable_quantity": readable_line_counts,
    }
    return {name: _tuned(query) for name, query in found.items()}
