import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens import storage
from orderlens.__main__ import main
from orderlens.functions import to_raw_orders
from orderlens.operators import cast_losses
from orderlens.plans import check_lake, ingest_documents, load_tables, process_lake, register_views, run, run_refresh
from orderlens.schema import RAW, TABLES
from orderlens.sinks import (
    ensure_tables,
    load_report,
    read_table,
    read_tables,
    refresh_table,
    refresh_tables,
    sync_catalog,
    warehouse,
)
from orderlens.sources import cleanup_lake, land_batch, list_batches, parse_orders, read_batch, read_lake
from orderlens.streaming import stream_refresh


@pytest.fixture
def place(tmp_path):
    return lambda name: f"file:{tmp_path}/{name}"


@pytest.fixture
def batch(items):
    return items(
        {"order_id": 1, "product_id": 2}, {"order_id": 1, "product_id": 1, "reordered": 1},
        {"order_id": 2, "department": None, "order_hour_of_day": 10},
    )


def counts(spark, root):
    return {r.table_name: r.total_rows for r in load_report(spark, root).collect()}


LOADED = {"raw_orders": 3, "product_analytics": 2, "hourly_analytics": 2, "department_analytics": 2}


def test_missing_lake_and_warehouse_are_empty(spark, place):
    assert read_lake(spark, place("lake")).schema == RAW
    assert read_lake(spark, place("lake")).isEmpty()
    assert counts(spark, place("wh")) == dict.fromkeys(TABLES, 0)


def test_landing_writes_whole_batches(spark, place, batch):
    lake = place("lake")
    path = land_batch(batch, lake)
    assert list_batches(spark, lake) == [path]
    assert path.rsplit("/", 1)[1].startswith("orders_2") and path.endswith(".parquet")
    assert read_lake(spark, lake).exceptAll(batch).isEmpty()
    land_batch(batch, lake, batch_id="20240101_000000")
    land_batch(batch, lake, batch_id="20240101_000000")
    assert read_lake(spark, lake).count() == 6


def test_half_written_batches_stay_hidden(spark, place, batch, monkeypatch):
    lake = place("lake")
    monkeypatch.setattr(storage, "move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        land_batch(batch, lake)
    assert list_batches(spark, lake) == []
    assert read_lake(spark, lake).isEmpty()


def test_foreign_files_are_cast(spark, tmp_path, place):
    import pandas as pd

    row = {f.name: 1 for f in RAW.fields[:9]} | {f.name: "x" for f in RAW.fields}
    row |= {"order_id": 1, "order_dow": 3, "reordered": 1, "days_since_prior_order": 7.0}
    pd.DataFrame([row, row | {"days_since_prior_order": None}]).to_parquet(tmp_path / "float.parquet", index=False)
    pd.DataFrame([row | {"days_since_prior_order": 9}]).to_parquet(tmp_path / "whole.parquet", index=False)
    for name in ("float", "whole"):
        land_batch(read_batch(spark, str(tmp_path / f"{name}.parquet")), place("lake"))
    days = [r.days_since_prior_order for r in read_lake(spark, place("lake")).collect()]
    assert sorted(days, key=lambda d: d or 0) == [None, 7, 9]


def test_refresh_replaces_and_repeats(spark, place, batch):
    root = place("wh")
    for _ in range(2):
        load_tables(batch, root)
        assert counts(spark, root) == LOADED
    assert {n: df.schema for n, df in read_tables(spark, root).items()} == TABLES
    load_tables(batch.limit(0), root)
    assert counts(spark, root) == dict.fromkeys(TABLES, 0)


def test_detail_files_are_sorted_by_key(spark, place, batch):
    refresh_table(batch.coalesce(1), place("wh"), "raw_orders")
    kept = [(r.order_id, r.product_id) for r in read_table(spark, place("wh"), "raw_orders").collect()]
    assert kept == [(1, 1), (1, 2), (2, 1)]


def test_clustered_files_hold_key_ranges(spark, place, items):
    """With the small partitions of this test kept apart; most rows are copies of one."""
    copies = [{"order_id": 50, "product_id": 1}] * 400
    raw = items(*({"order_id": n * 7 % 100, "product_id": n} for n in range(100)), *copies).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        refresh_table(raw, place("wh"), "raw_orders", cluster=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = read_table(spark, place("wh"), "raw_orders")
    assert table.count() == 500 and table.exceptAll(raw).isEmpty()
    files = table.groupBy(F.input_file_name().alias("f"))
    spans = sorted(rows(files.agg(F.min("order_id"), F.max("order_id"), F.count("order_id")).drop("f")))
    assert len(spans) == 8 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert max(count for _, _, count in spans) < 150


def test_failed_refresh_changes_nothing(spark, place, batch, tmp_path, monkeypatch):
    root = place("wh")
    load_tables(batch, root)
    broken = batch.withColumn("department", F.raise_error(F.lit("disk lost")).cast("string"))
    with pytest.raises(Exception, match="disk lost"):
        refresh_tables(spark, {"hourly_analytics": read_table(spark, root, "hourly_analytics"), "raw_orders": broken}, root)
    assert counts(spark, root) == LOADED
    assert len(os.listdir(tmp_path / "wh" / "hourly_analytics")) == 2
    monkeypatch.setattr(warehouse, "KEPT_HOURS", 0)
    load_tables(batch, root)
    load_tables(batch, root)
    assert len(os.listdir(tmp_path / "wh" / "hourly_analytics")) == warehouse.KEPT_GENERATIONS


def test_processing_an_empty_lake_fails(spark, place, batch):
    load_tables(batch, place("wh"))
    with pytest.raises(FileNotFoundError):
        process_lake(spark, place("lake"), place("wh"))
    assert counts(spark, place("wh")) == LOADED


def test_one_table_can_be_refreshed_from_itself(spark, place, batch):
    root = place("wh")
    load_tables(batch, root)
    refresh_table(read_table(spark, root, "raw_orders").filter("order_id = 1"), root, "raw_orders")
    assert counts(spark, root) == LOADED | {"raw_orders": 2}


def test_running_readers_keep_their_generation(spark, place, batch, tmp_path, monkeypatch):
    root = place("wh")
    load_tables(batch, root)
    held = read_table(spark, root, "raw_orders")
    for _ in range(4):
        load_tables(batch.limit(0), root)
    assert held.count() == 3
    # a generation stays until it was replaced long enough ago, and the last ones stay anyway
    monkeypatch.setattr(warehouse, "KEPT_HOURS", 0)
    load_tables(batch, root)
    assert len(os.listdir(tmp_path / "wh" / "raw_orders")) == warehouse.KEPT_GENERATIONS


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda df: df.withColumnRenamed("order_id", "orderid"), "absent .*order_id.* not expected .*orderid"),
        (lambda df: df.drop("aisle"), "absent .*aisle"),
        (lambda df: df.withColumn("more", F.lit(1)), "not expected .*more"),
        (lambda df: df.withColumn("order_dow", F.col("order_dow").cast("bigint")), "order_dow bigint"),
        (lambda df: df.withColumn("order_id", F.col("order_id").cast("string")), "order_id string"),
    ],
)
def test_sinks_take_only_what_fits(spark, place, batch, change, message):
    for write in (lambda df: land_batch(df, place("lake")), lambda df: refresh_table(df, place("wh"), "raw_orders")):
        with pytest.raises((ValueError, TypeError), match=message):
            write(change(batch))
    assert list_batches(spark, place("lake")) == []
    assert counts(spark, place("wh")) == dict.fromkeys(TABLES, 0)


def test_sinks_widen(spark, place, batch):
    refresh_table(batch.withColumn("order_id", F.col("order_id").cast("int")), place("wh"), "raw_orders")
    assert read_table(spark, place("wh"), "raw_orders").schema == RAW
    with pytest.raises(ValueError, match="absent"):
        refresh_table(spark.range(3), place("wh"), "hourly_analytics")


def test_files_of_another_writer_in_the_lake(spark, place, batch, tmp_path):
    """Written with pandas: integers in 64 bits, and a float interval as soon as one is missing."""
    land_batch(batch, place("lake"))
    frame = batch.toPandas()
    whole = [c for c in frame if frame[c].dtype.kind == "i" or c == "days_since_prior_order"]
    frame[whole] = frame[whole].fillna(5).astype("int64")
    frame.to_parquet(tmp_path / "lake" / "orders_1.parquet")
    frame["days_since_prior_order"] = [7.0, None, 3e9]
    frame.to_parquet(tmp_path / "lake" / "orders_2.parquet")
    found = {r.rule: r.violations for r in check_lake(spark, place("lake")).collect()}
    assert found["days_since_prior_order survives the cast"] == 1
    assert found["department not null"] == 3
    with pytest.raises(ValueError, match="survives the cast"):
        process_lake(spark, place("lake"), place("wh"), check=True)
    process_lake(spark, place("lake"), place("wh"))
    loaded = read_table(spark, place("wh"), "raw_orders")
    assert loaded.schema == RAW and loaded.count() == 9
    assert sorted(r[0] or -1 for r in loaded.select("days_since_prior_order").collect()) == [-1] * 5 + [5, 5, 5, 7]


def test_values_lost_from_documents(spark):
    text = '{"orders": [{"order_id": 1, "days_since_prior_order": 3000000000}, {"order_id": "x"}, {"order_id": null}]}'
    orders = parse_orders(spark.createDataFrame([(text,)], "body string"), "body").select(F.inline("orders"))
    found = {r.rule: r.violations for r in cast_losses(orders).collect()}
    assert found["days_since_prior_order survives the cast"] == 1
    assert found["order_id survives the cast"] == 1


def test_clustered_process(spark, place, items, tmp_path):
    raw = items(*({"order_id": i % 500, "product_id": i} for i in range(2000)))
    land_batch(raw.repartition(4), place("lake"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        process_lake(spark, place("lake"), place("wh"), cluster=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    detail = read_table(spark, place("wh"), "raw_orders")
    spans = detail.groupBy(F.input_file_name()).agg(F.min("order_id").alias("a"), F.max("order_id").alias("b"))
    ordered = sorted((r.a, r.b) for r in spans.collect())
    assert len(ordered) > 1
    assert all(b <= a for (_, b), (a, _) in zip(ordered, ordered[1:], strict=False))


def test_quotes_in_paths(spark, place, batch):
    root = place("it's a \"warehouse\"")
    try:
        load_tables(batch, root)
        ensure_tables(spark, root, "shop4")
        assert spark.sql("SELECT count(*) FROM shop4.raw_orders").first()[0] == 3
    finally:
        spark.sql("DROP DATABASE IF EXISTS shop4 CASCADE")


def test_catalog_follows_without_being_named(spark, place, batch):
    try:
        ensure_tables(spark, place("wh"), "shop5")
        for n in (1, 2, 3):
            load_tables(batch.limit(n), place("wh"))
            assert spark.sql("SELECT count(*) FROM shop5.raw_orders").first()[0] == n
    finally:
        spark.sql("DROP DATABASE IF EXISTS shop5 CASCADE")
    load_tables(batch, place("wh"))


def test_cleanup_deletes_only_what_was_loaded(spark, place, batch, monkeypatch):
    lake, root = place("lake"), place("wh")
    land_batch(batch, lake)
    late = []

    def load(raw, *options):
        load_tables(raw, *options)
        late.append(land_batch(batch, lake))

    monkeypatch.setattr("orderlens.plans.refresh.load_tables", load)
    assert {r.table_name: r.total_rows for r in process_lake(spark, lake, root).collect()} == LOADED
    assert list_batches(spark, lake) == late


def test_failure_before_cleanup_keeps_the_lake(spark, place, batch, monkeypatch):
    lake = place("lake")
    land_batch(batch, lake)
    monkeypatch.setattr("orderlens.plans.refresh.load_tables", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        process_lake(spark, lake, place("wh"))
    assert read_lake(spark, lake).count() == 3


def test_cleanup_reports_failures(spark, place, batch, monkeypatch, caplog):
    paths = [land_batch(batch, place("lake")) for _ in range(2)]
    real = storage.delete

    def fail_first(spark, path):
        if path == paths[0]:
            raise OSError("denied")
        return real(spark, path)

    monkeypatch.setattr(storage, "delete", fail_first)
    assert cleanup_lake(spark, paths) == [paths[0]]
    assert "denied" in caplog.text
    assert list_batches(spark, place("lake")) == [paths[0]]


@pytest.mark.parametrize(("dedupe", "expected"), [(False, 6), (True, 3)])
def test_batches_landed_twice(spark, place, batch, dedupe, expected):
    for day in (1, 2):
        land_batch(batch.withColumn("ingestion_timestamp", F.lit(f"2024-01-0{day} 00:00:00")), place("lake"))
    process_lake(spark, place("lake"), place("wh"), dedupe=dedupe)
    tables = read_tables(spark, place("wh"))
    assert tables["raw_orders"].count() == expected
    assert tables["department_analytics"].agg(F.sum("total_orders")).first()[0] == expected


def test_whole_refresh_from_documents(spark, place, tmp_path):
    order = {"order_id": 1, "user_id": 1, "order_hour_of_day": 8,
             "products": [{"product_id": n, "product_name": "p", "department": "d", "reordered": 1} for n in (1, 2)]}
    (tmp_path / "poll.json").write_text(json.dumps({"orders": [order, {"order_id": 2}]}))
    report = run_refresh(spark, place("poll.json"), place("lake"), place("wh"), ts="2024-01-01 00:00:00")
    assert {r.table_name: r.total_rows for r in report.collect()} == {
        "raw_orders": 2, "product_analytics": 1, "hourly_analytics": 1, "department_analytics": 1,
    }
    tables = read_tables(spark, place("wh"))
    assert rows(run("a1_top_products", tables)) == [("p", "d", 2, 2, 1.0)]
    assert {r.ingestion_timestamp for r in tables["raw_orders"].collect()} == {"2024-01-01 00:00:00"}
    assert list_batches(spark, place("lake")) == []
    (tmp_path / "empty.json").write_text('{"orders": []}')
    with pytest.raises(ValueError):
        ingest_documents(spark, place("empty.json"), place("lake"))
    assert counts(spark, place("wh"))["raw_orders"] == 2


def test_tables_in_the_catalog(spark, place, batch):
    root = place("wh")
    try:
        ensure_tables(spark, root, "shop")
        assert spark.sql("SELECT count(*) FROM shop.raw_orders").first()[0] == 0
        load_tables(batch, root)
        ensure_tables(spark, root, "shop")
        assert spark.sql("SELECT count(*) FROM shop.raw_orders").first()[0] == 3
        load_tables(batch.filter("order_id = 2"), root)
        sync_catalog(spark, root, "shop")
        assert rows(spark.sql("SELECT * FROM shop.hourly_analytics")) == [(10, 1)]
    finally:
        spark.sql("DROP DATABASE IF EXISTS shop CASCADE")
    assert counts(spark, root)["raw_orders"] == 1


def test_catalog_follows_every_refresh(spark, place, batch):
    def loaded():
        return spark.sql("SELECT count(*) FROM shop2.raw_orders").first()[0]

    try:
        for step in (1, 2, 3):
            land_batch(batch.limit(step), place("lake"))
            process_lake(spark, place("lake"), place("wh"), database="shop2")
            assert loaded() == step
        land_batch(batch.limit(2), place("lake"))
        stream_refresh(spark, place("lake"), place("wh"), place("checkpoint"), database="shop2")
        assert loaded() == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS shop2 CASCADE")


def test_stream_loads_new_batches_once(spark, place, batch, items):
    lake, root, checkpoint = place("lake"), place("wh"), place("checkpoint")
    land_batch(batch, lake)
    land_batch(items({"order_id": 9}), lake)
    report = stream_refresh(spark, lake, root, checkpoint)
    assert {r.table_name: r.total_rows for r in report.collect()} == LOADED | {"raw_orders": 4}
    assert list_batches(spark, lake) == []
    land_batch(items({"order_id": 10}, {"order_id": 11}), lake)
    stream_refresh(spark, lake, root, checkpoint, cleanup=False)
    assert counts(spark, root)["raw_orders"] == 2
    stream_refresh(spark, lake, root, checkpoint)
    assert counts(spark, root)["raw_orders"] == 2
    assert len(list_batches(spark, lake)) == 1  # goes with the next load


def broken_load(*args, **options):
    raise OSError("lost")


def test_failed_stream_repeats_its_batch(spark, place, batch, items, monkeypatch):
    lake, root, checkpoint = place("lake"), place("wh"), place("checkpoint")
    land_batch(batch, lake)
    with monkeypatch.context() as broken:
        broken.setattr("orderlens.streaming.refresh.load_tables", broken_load)
        with pytest.raises(Exception, match="lost"):
            stream_refresh(spark, lake, root, checkpoint)
    assert read_lake(spark, lake).count() == 3
    # another batch lands before the next run, which has a micro-batch for each
    land_batch(items({"order_id": 9}), lake)
    stream_refresh(spark, lake, root, checkpoint)
    assert counts(spark, root) == LOADED | {"raw_orders": 4}
    assert list_batches(spark, lake) == []


def test_stream_that_died_before_cleaning_up(spark, place, batch, items):
    lake, root, checkpoint = place("lake"), place("wh"), place("checkpoint")
    land_batch(batch, lake)
    stream_refresh(spark, lake, root, checkpoint, cleanup=False)
    land_batch(items({"order_id": 9}), lake)
    stream_refresh(spark, lake, root, checkpoint)
    assert counts(spark, root)["raw_orders"] == 4
    assert list_batches(spark, lake) == []


def test_stream_takes_files_of_any_age(spark, place, batch, items, tmp_path):
    lake = place("lake")
    land_batch(batch, lake, batch_id="old")
    land_batch(items({"order_id": 9}), lake)
    for file in (tmp_path / "lake" / "orders_old.parquet").iterdir():
        os.utime(file, (file.stat().st_atime, file.stat().st_mtime - 9 * 86_400))
    stream_refresh(spark, lake, place("wh"), place("checkpoint"))
    assert counts(spark, place("wh"))["raw_orders"] == 4
    land_batch(batch, lake, batch_id="older")
    for file in (tmp_path / "lake" / "orders_older.parquet").iterdir():
        os.utime(file, (file.stat().st_atime, file.stat().st_mtime - 99 * 86_400))
    stream_refresh(spark, lake, place("wh"), place("checkpoint"))
    assert counts(spark, place("wh"))["raw_orders"] == 3


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "app"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.scratch_folder(Session(), "x")
    assert storage.scratch_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_can_be_dropped(spark):
    folder = storage.scratch_folder(spark, "x")
    assert storage.written(spark, spark.range(3), folder).count() == 3
    storage.drop_scratch(spark)
    assert not storage.exists(spark, folder)


def test_command_line(spark, place, tmp_path, capsys):
    order = {"order_id": 1, "products": [{"product_id": 1, "product_name": "pear", "department": "fruit"}]}
    (tmp_path / "poll.json").write_text(json.dumps({"orders": [order]}))
    where = ["--lake", place("lake"), "--warehouse", place("wh")]
    main(["ingest", "--documents", place("poll.json"), "--lake", place("lake")])
    main(["process", *where, "--dedupe", "--database", "shop3"])
    main(["refresh", "--documents", place("poll.json"), *where, "--whole-files", "--cluster", "--rejects", place("rejects")])
    main(["ingest", "--documents", place("poll.json"), "--lake", place("lake")])
    main(["check", "--lake", place("lake")])
    assert "user_id not null" in capsys.readouterr().out
    main(["stream", *where, "--checkpoint", place("checkpoint")])
    capsys.readouterr()
    main(["report", "--warehouse", place("wh"), "a1_top_products"])
    assert "pear" in capsys.readouterr().out
    main(["report", "--warehouse", place("wh"), "a2_top_reorder", "--param", "min_orders=99"])
    assert "pear" not in capsys.readouterr().out
    main(["report", "--warehouse", place("wh"), "a1_top_products", "--output", place("out"), "--format", "json"])
    assert spark.read.json(place("out")).first().product_name == "pear"
    assert spark.sql("SELECT count(*) FROM shop3.product_analytics").first()[0] == 1
    spark.sql("DROP DATABASE shop3 CASCADE")


def test_reports_print_every_row(spark, place, mart, capsys):
    departments = mart("department_analytics", [(f"d{i}", i + 1) for i in range(1500)])
    refresh_table(departments, place("wh"), "department_analytics")
    capsys.readouterr()
    main(["report", "--warehouse", place("wh"), "c1_market_share"])
    assert len(capsys.readouterr().out.splitlines()) == 1501


def test_reports_as_views(spark, place, batch):
    load_tables(batch, place("wh"))
    register_views(read_tables(spark, place("wh")))
    got = rows(spark.sql("SELECT unique_orders FROM d1_totals CROSS JOIN (SELECT count(*) FROM raw_orders)"))
    assert got == [(2,)]
    assert spark.sql("SELECT * FROM b1_hour_share").count() == 2


def test_files_of_one_batch_may_differ(spark, place, batch, items):
    lake = place("lake")
    floating = {"days_since_prior_order": "double", "user_id": "double"}
    mixed = f"{lake}/orders_mixed.parquet"
    batch.write.parquet(mixed)
    batch.withColumns({c: F.col(c).cast(k) for c, k in floating.items()}).write.mode("append").parquet(mixed)
    land_batch(items({"order_id": 77}), lake)
    found = read_lake(spark, lake)
    assert found.schema == RAW
    assert sorted(r.order_id for r in found.collect()) == sorted([r.order_id for r in batch.collect()] * 2 + [77])


def test_own_batches_take_no_job_to_be_read(spark, place, batch):
    lake, status = place("lake"), spark.sparkContext.statusTracker()
    for i in range(5):
        land_batch(batch, lake, batch_id=str(i))
    before = len(status.getJobIdsForGroup(None))
    frame = read_lake(spark, lake)
    assert len(status.getJobIdsForGroup(None)) == before
    assert frame.count() == 5 * batch.count()


def test_two_refreshes_at_a_time(spark, place, batch, monkeypatch):
    """The second one starts while the first is writing, and fails; the first one ends as if alone."""
    root, seen = place("wh"), []
    load_tables(batch, root)
    real = warehouse.exactly

    def during(frame, schema):
        if not seen:
            seen.append(1)
            with pytest.raises(warehouse.RefreshRunningError):
                refresh_table(batch.limit(0).transform(to_raw_orders), root, "raw_orders")
        return real(frame, schema)

    monkeypatch.setattr(warehouse, "exactly", during)
    load_tables(batch, root)
    assert seen and counts(spark, root) == LOADED
    assert storage.children(spark, f"{root}/claims") == []


def test_claim_of_a_dead_driver(spark, place, batch, monkeypatch):
    root = place("wh")
    load_tables(batch, root)
    storage.claim(spark, f"{root}/claims/{2:012d}")
    with pytest.raises(warehouse.RefreshRunningError, match="delete"):
        load_tables(batch, root)
    monkeypatch.setattr(warehouse, "CLAIM_HOURS", 0.0)
    load_tables(batch, root)
    assert counts(spark, root) == LOADED


def test_failed_refresh_gives_its_claim_back(spark, place, batch):
    root = place("wh")
    with pytest.raises(ValueError):
        refresh_table(batch.drop("user_id"), root, "raw_orders")
    load_tables(batch, root)
    assert counts(spark, root) == LOADED
