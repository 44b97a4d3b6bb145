"""Increments and hourly counts: what each micro-batch reads, replays, late rows."""

from datetime import datetime, timedelta

import pytest
from conftest import rows

from orderlens import storage
from orderlens.operators import build_marts
from orderlens.schema import TABLES
from orderlens.sinks import read_tables, refresh_table, sync_catalog
from orderlens.sources import land_batch
from orderlens.streaming import hourly_counts, incremental, incremental_refresh, read_hourly_counts, stream_hourly_counts


@pytest.fixture
def place(tmp_path):
    return lambda name: f"{tmp_path}/{name}"


def batch(items, start, n):
    return items(*({"order_id": i, "product_name": f"p{i % 4}", "department": None if i % 5 == 0 else "d", "reordered": i % 2,
                    "order_hour_of_day": i % 24} for i in range(start, start + n)))


def contents(tables):
    return {name: sorted(rows(df.select(*TABLES[name].fieldNames())), key=repr) for name, df in tables.items()}


def wanted(raw):
    return contents({name: df.select(*TABLES[name].fieldNames()) for name, df in build_marts(raw).items()})


def run(spark, place):
    progress = []
    incremental_refresh(spark, place("lake"), place("wh"), place("checkpoint"), progress)
    return sum(p["numInputRows"] for p in progress)


def test_increments_read_only_what_is_new(spark, place, items, monkeypatch):
    monkeypatch.setattr(incremental, "FANOUT", 2)
    raw, read = None, []
    for start, n in ((0, 100), (100, 3), (103, 50), (153, 3), (156, 3)):
        new = batch(items, start, n)
        raw = new if raw is None else raw.unionByName(new)
        land_batch(new, place("lake"))
        read.append(run(spark, place))
        assert contents(read_tables(spark, place("wh"))) == wanted(raw)
    assert read[1] < 20 and read[3] == read[4] == read[1] and read[0] > 90
    assert run(spark, place) == 0
    state = storage.children(spark, storage.children(spark, f"{place('wh')}/increments")[0] + "/states")
    assert len(state) == 2


def test_replayed_increment_counts_once(spark, place, items):
    raw = batch(items, 0, 20)
    land_batch(raw, place("lake"))
    run(spark, place)
    for name in ("commits/0", "commits/.0.crc"):
        storage.delete(spark, f"{place('checkpoint')}/{name}")
    assert run(spark, place) > 0
    assert contents(read_tables(spark, place("wh"))) == wanted(raw)


def test_increment_that_fails_changes_nothing(spark, place, items, monkeypatch):
    first, second = batch(items, 0, 20), batch(items, 20, 7)
    land_batch(first, place("lake"))
    run(spark, place)
    land_batch(second, place("lake"))

    def broken(*args, **options):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "refresh_tables", broken)
        with pytest.raises(Exception, match="lost"):
            run(spark, place)
    assert contents(read_tables(spark, place("wh"))) == wanted(first)
    run(spark, place)
    assert contents(read_tables(spark, place("wh"))) == wanted(first.unionByName(second))


def test_increments_in_the_catalog(spark, place, items):
    for start in (0, 10):
        land_batch(batch(items, start, 10), place("lake"))
        run(spark, place)
    spark.sql(f"CREATE DATABASE steps LOCATION '{place('db')}'")
    sync_catalog(spark, place("wh"), "steps")
    assert spark.sql("SELECT count(*) FROM steps.raw_orders").first()[0] == 20
    refresh_table(read_tables(spark, place("wh"))["raw_orders"].where("order_id < 5"), place("wh"), "raw_orders")
    sync_catalog(spark, place("wh"), "steps")
    assert spark.sql("SELECT count(*) FROM steps.raw_orders").first()[0] == 5
    spark.sql("DROP DATABASE steps CASCADE")


def test_stream_of_an_empty_lake(spark, place):
    (spark.range(0).write.parquet(place("lake/none")))
    assert {r.total_rows for r in incremental_refresh(spark, place("lake"), place("wh"), place("checkpoint")).collect()} == {0}


START = datetime(2024, 1, 1)


def events(spark, *minutes):
    data = [(i, None if m is None else START + timedelta(minutes=m), "click" if i % 2 else "view") for i, m in enumerate(minutes)]
    return spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, event_type string")


def hours(found):
    return {(int((r.hour_start - START).total_seconds() // 3600), r.event_type): r.events for r in found.collect()}


def test_hours_stay_open_for_the_delay_and_late_events_are_dropped(spark, place):
    def arrive(*minutes):
        events(spark, *minutes).coalesce(1).write.mode("append").parquet(place("in"))
        progress = []
        found = stream_hourly_counts(spark, place("in"), place("out"), place("checkpoint"), "2 hours", progress=progress)
        dropped = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
        return hours(found), dropped, min([s["numRowsTotal"] for p in progress for s in p["stateOperators"]], default=None)

    assert arrive(10, 20, 50, None) == ({(0, "view"): 2, (0, "click"): 1}, 0, 2)
    # out of order, but the hour is open until an event two hours after its end has been seen
    found, dropped, _ = arrive(170, 30)
    assert (found[0, "click"], dropped) == (2, 0)
    found, dropped, _ = arrive(185, 185)
    assert dropped == 0
    # hour 0 is closed now; the event of hour 1 is not late
    found, dropped, state = arrive(40, 70)
    assert dropped == 1 and found[0, "view"] == 2 and found[0, "click"] == 2 and found[1, "click"] == 1
    assert state < len(found)  # the closed hour has left the state
    assert arrive()[0] == found


def test_replayed_counts_change_nothing(spark, place):
    events(spark, 1, 2, 3).coalesce(1).write.parquet(place("in"))
    first = hours(stream_hourly_counts(spark, place("in"), place("out"), place("checkpoint")))
    newest = max(int(p.rsplit("/", 1)[1]) for p in storage.children(spark, place("checkpoint/commits")))
    for name in (f"commits/{newest}", f"commits/.{newest}.crc"):
        storage.delete(spark, f"{place('checkpoint')}/{name}")
    assert hours(stream_hourly_counts(spark, place("in"), place("out"), place("checkpoint"))) == first == {(0, "view"): 2, (0, "click"): 1}


def test_stream_and_table_agree(spark, place):
    table = events(spark, *range(0, 1000, 7))
    table.repartition(4).write.parquet(place("in"))
    assert hours(stream_hourly_counts(spark, place("in"), place("out"), place("checkpoint"))) == hours(hourly_counts(table))
    assert rows(read_hourly_counts(spark, place("nowhere"))) == []
