import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens import storage
from orderlens.operators import broken_rules, read_quarantine, set_aside
from orderlens.plans import process_lake
from orderlens.sinks import read_table
from orderlens.sources import land_batch, list_batches


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def test_a_row_names_all_its_rules_and_is_kept_as_written(items):
    wide = items({"order_id": 1}, {"order_id": -2, "user_id": None}, {"order_id": 3}).withColumns(
        {"add_to_cart_order": F.when(F.col("order_id") == 3, "x").otherwise("4"), "a.b": F.lit(5)}
    )
    found = {r["order_id"]: r for r in broken_rules(wide).collect()}
    assert found[1]["broken"] == [] and found[1]["written"] is None and found[1]["add_to_cart_order"] == 4
    assert found[-2]["broken"] == ["order_id fits uint32", "user_id not null"]
    assert found[3]["broken"] == ["add_to_cart_order survives the cast", "add_to_cart_order not null"]
    written = json.loads(found[3]["written"])
    assert written["add_to_cart_order"] == "x" and written["a.b"] == 5 and "days_since_prior_order" in written


def test_sound_rows_load_and_a_retry_sets_nothing_aside_twice(spark, items, place):
    lake, aside = place("a lake+1%"), place("aside")
    land_batch(items({"order_id": 1}, {"order_id": 2, "user_id": None}), lake, batch_id="1")
    items({"order_id": 3}, {"order_id": 4}).withColumn("user_id", F.lit(2.0**40)).coalesce(1).write.parquet(f"{lake}/orders_2.parquet")
    for _ in range(2):  # the load dies behind the split
        with pytest.raises(Exception):
            storage.write_text(spark, place("file"), "no folder") if not storage.exists(spark, place("file")) else None
            process_lake(spark, lake, f"{place('file')}/warehouse", quarantine=aside)
    assert len(list_batches(spark, lake)) == 2
    process_lake(spark, lake, place("warehouse"), quarantine=aside)
    assert [r[0] for r in rows(read_table(spark, place("warehouse"), "raw_orders").select("order_id"))] == [1]
    found = read_quarantine(spark, aside).select("batch", "order_id", "broken")
    assert sorted(map(tuple, found.collect())) == [
        ("orders_1.parquet", 2, ["user_id not null"]),
        ("orders_2.parquet", 3, ["user_id fits uint32"]),
        ("orders_2.parquet", 4, ["user_id fits uint32"]),
    ]
    # nothing but the batches' folders is left
    fs, target = storage._open(spark, aside)
    assert sorted(s.getPath().getName() for s in fs.listStatus(target)) == ["batch=orders_1.parquet", "batch=orders_2.parquet"]
    # a batch that is landed again without faults has no rows there any more
    land_batch(items({"order_id": 1}, {"order_id": 2}), lake, batch_id="1")
    process_lake(spark, lake, place("warehouse"), quarantine=aside)
    assert {r[0] for r in rows(read_quarantine(spark, aside).select("batch"))} == {"orders_2.parquet"}


def test_only_faulty_rows_or_none(spark, items, place):
    assert rows(read_quarantine(spark, place("nothing"))) == []
    land_batch(items({"order_id": None}), place("lake"))
    counts = process_lake(spark, place("lake"), place("warehouse"), quarantine=place("aside"))
    assert {r["table_name"]: r["total_rows"] for r in counts.collect()}["raw_orders"] == 0
    assert read_quarantine(spark, place("aside")).count() == 1


def test_batches_of_two_folders_are_refused(spark, items, place):
    batches = [land_batch(items({}), place("lake")), land_batch(items({}), place("deeper/lake"))]
    with pytest.raises(ValueError, match="not of one lake"):
        set_aside(spark, batches, place("aside"))
