import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.schema import ORDER, PRODUCT_IN_ORDER, RAW
from orderlens.sources import flatten_orders, parse_orders, read_orders_json, require_non_empty, with_ingestion_ts
from orderlens.sources.star_tables import STAMP, order_items

TWO_PRODUCTS = {
    "order_id": 1, "user_id": 5, "order_number": 2, "order_dow": 6, "order_hour_of_day": 23,
    "days_since_prior_order": 7.0,
    "products": [
        {"product_id": 10, "product_name": "Banana", "department": "produce", "aisle": "fruit",
         "add_to_cart_order": 1, "reordered": 1},
        {"product_id": 11, "product_name": "Milk"},
    ],
}
DOCUMENT = {"orders": [TWO_PRODUCTS, {"order_id": 2, "products": []}, {"order_id": 3}, {"order_id": 4, "products": None}]}


GOOD, JUNK, CUT = json.dumps(DOCUMENT), json.dumps({"orders": [TWO_PRODUCTS, "junk"]}), '{"orders": ['
JUNK_PRODUCT = json.dumps({"orders": [TWO_PRODUCTS | {"products": [*TWO_PRODUCTS["products"], 7]}]})


@pytest.fixture
def folder(tmp_path):
    """One document per file."""
    (tmp_path / "a.json").write_text(json.dumps(DOCUMENT, indent=2))
    (tmp_path / "b.json").write_text('{"message": "no orders today"}')
    return str(tmp_path)


def test_flatten_keeps_only_orders_with_products(spark, folder):
    flat = flatten_orders(read_orders_json(spark, folder, multi_line=True)).orderBy("product_id")
    assert flat.columns == RAW.fieldNames()[:-1]
    assert [f.dataType for f in flat.schema.fields] == [f.dataType for f in RAW.fields[:-1]]
    assert rows(flat) == [
        (1, 5, 2, 6, 23, 7, 10, "Banana", "produce", "fruit", 1, 1),
        (1, 5, 2, 6, 23, 7, 11, "Milk", None, None, None, None),
    ]


def test_one_document_per_line_and_text_column_give_the_same(spark, tmp_path):
    lines = [GOOD, "", json.dumps({"orders": []}), "   ", "{}", GOOD]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    by_file = flatten_orders(read_orders_json(spark, str(tmp_path)))
    by_text = flatten_orders(parse_orders(spark.createDataFrame([(t,) for t in [*lines, None]], "body string"), "body"))
    assert sorted(rows(by_file), key=str) == sorted(rows(by_text), key=str)
    assert by_text.count() == 4


def test_every_line_is_a_document(spark, tmp_path):
    one = {"orders": [{"order_id": 1, "products": [{"product_id": 1}]}]}
    (tmp_path / "a.jsonl").write_text("\n".join([json.dumps(one)] * 10))
    assert flatten_orders(read_orders_json(spark, str(tmp_path))).count() == 10


@pytest.mark.parametrize("text", [CUT, JUNK, JUNK_PRODUCT, "null", "[]", "7", GOOD + " " + GOOD, GOOD + "," + GOOD])
def test_texts_that_do_not_parse_fail(spark, text):
    df = spark.createDataFrame([(GOOD,), (text,)], "body string")
    with pytest.raises(Exception, match="MALFORMED|not exactly one document"):
        flatten_orders(parse_orders(df, "body")).collect()


@pytest.mark.parametrize("text", [CUT, JUNK, JUNK_PRODUCT, "null", "[]", "7", GOOD + " " + GOOD, GOOD + "," + GOOD])
def test_or_are_set_aside_whole(spark, tmp_path, text):
    df = spark.createDataFrame([(GOOD,), (text,), ("{}",)], "body string")
    flat = flatten_orders(parse_orders(df, "body", rejects=str(tmp_path / "rejects")))
    assert flat.count() == 2
    assert [r.value for r in spark.read.text(str(tmp_path / "rejects")).collect()] == [text]


def test_a_file_with_two_documents_is_no_whole_document(spark, tmp_path):
    (tmp_path / "a.json").write_text(f"{GOOD}\n{GOOD}")
    with pytest.raises(Exception, match="MALFORMED|not exactly one document"):
        flatten_orders(read_orders_json(spark, str(tmp_path), multi_line=True)).collect()
    assert flatten_orders(read_orders_json(spark, str(tmp_path))).count() == 4


@pytest.mark.parametrize(
    ("given", "expected"),
    [("7", 7), ("7.0", 7), ("12.7", 12), ("-12.7", -12), ('" 12 "', 12), ('"12.7"', None), ('"abc"', None),
     ("null", None), ("9007199254740993", 9007199254740993), ("1e3", 1000), ("true", 1)],
)
def test_numbers_in_documents(spark, given, expected):
    text = '{"orders": [{"order_id": %s, "products": [{"product_id": 1}]}]}' % given
    flat = flatten_orders(parse_orders(spark.createDataFrame([(text,)], "body string"), "body"))
    assert flat.first().order_id == expected


def test_empty_batch_is_an_error(spark):
    flat = flatten_orders(parse_orders(spark.createDataFrame([('{"orders": []}',)], "body string"), "body"))
    with pytest.raises(ValueError, match="no rows"):
        require_non_empty(flat)


def test_ingestion_time(spark):
    df = spark.range(3)
    assert {r.ingestion_timestamp for r in with_ingestion_ts(df, STAMP).collect()} == {STAMP}
    stamps = {r.ingestion_timestamp for r in with_ingestion_ts(df).collect()}
    assert len(stamps) == 1
    assert spark.sql(f"SELECT to_timestamp('{stamps.pop()}', 'yyyy-MM-dd HH:mm:ss') IS NOT NULL AS ok").first().ok


def test_flatten_undoes_nesting(spark):
    """Whole orders with all their products, nested and flattened again."""
    raw = order_items(spark, "/root/testdata/sf0.001")
    in_order = [f.name for f in ORDER.fields if f.name != "products"]
    nested = raw.groupBy(*in_order).agg(
        F.collect_list(F.struct(*(f.name for f in PRODUCT_IN_ORDER.fields))).alias("products")
    )
    text = nested.select(F.to_json(F.struct(F.array(F.struct("*")).alias("orders"))).alias("body"))
    back = with_ingestion_ts(flatten_orders(parse_orders(text, "body")), STAMP)
    assert back.count() == raw.count() == 6000
    assert back.exceptAll(raw).isEmpty()


@pytest.mark.parametrize("text", [
    '{"orders": []}] junk [', '{"orders": []}] junk [{}', '{"orders": []}]', '{"orders": []}} junk', '{"orders": []}, "x": 1} {',
    '{"orders": []}], [{"orders": []}', '{"orders": []} junk', '{"orders": []}{', '[{"orders": []}]',
])
def test_text_behind_a_document_is_an_error(spark, tmp_path, text):
    sound = '{"orders": [{"order_id": 1, "products": [{"product_id": 2, "product_name": "]} {["}]}]}'
    df = spark.createDataFrame([(sound,), (text,)], "value string")
    with pytest.raises(Exception):  # noqa: B017
        rows(flatten_orders(parse_orders(df, "value")))
    kept = flatten_orders(parse_orders(df, "value", rejects=f"{tmp_path}/rejects"))
    assert [r.product_name for r in kept.collect()] == ["]} {["]
    assert [r.value for r in spark.read.text(f"{tmp_path}/rejects").collect()] == [text]
