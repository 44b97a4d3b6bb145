"""Documents cut between their orders, over splits of a few hundred bytes."""

import gzip
import json
import random

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from orderlens import storage
from orderlens.sources import flatten_orders, read_orders_json, read_orders_split


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


NAMES = ["milk", "a } b", "{[", "]}", '"', '\\', '\\"}', "{\"orders\": [", "é}ü", "", "\n}\t", "},{", "\\\\}"]


def document(rng, orders):
    def product(i):
        return {"product_id": i, "product_name": rng.choice(NAMES), "department": rng.choice(NAMES), "add_to_cart_order": i, "extra": {"a": [{}, "}"]}}

    return {
        "orders": [
            {"order_id": o, "products": [product(i) for i in range(rng.randrange(5))], "odd": rng.choice([None, {}, {"x": {"y": []}}, [[{}]]])}
            for o in range(orders)
        ]
    }


def write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.json").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def flat(orders):
    return sorted(rows(flatten_orders(orders)), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_equals_whole_parsing(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    texts = {
        "plain": json.dumps(document(rng, 40)),
        "pretty": json.dumps(document(rng, 25), indent=2, ensure_ascii=False) + "\n\n",
        "one": json.dumps(document(rng, 1)),
        # parsed whole
        "none": '{"orders": []}',
        "missing": "{}",
        "blank": " \n",
        "empty": "",
        "more": json.dumps({"meta": {"a": {"b": {}}, "c": [{}, {}]}, **document(rng, 6), "next": [{"a": 1}]}),
        "nulls": '{"orders": [{"order_id": 1, "products": [{"product_id": 2}]}, null, {"order_id": 3, "products": [{"product_id": 4}]}]}',
    }
    folder = write(tmp_path / "a folder+1", **texts)
    (tmp_path / "a folder+1" / "zipped.json.gz").write_bytes(gzip.compress(json.dumps(document(rng, 9)).encode()))
    whole = flat(read_orders_json(spark, folder, multi_line=True))
    assert len(whole) > 50 and flat(read_orders_split(spark, folder)) == whole


def test_a_document_is_parsed_by_many_tasks(spark, tmp_path, tiny_splits):
    folder = write(tmp_path / "in", big=json.dumps(document(random.Random(5), 60)))
    found = read_orders_split(spark, folder)
    assert found.count() == 60  # a row for each order
    splits = spark.read.option("lineSep", "}").text(folder).select("_metadata.file_block_start").distinct().count()
    assert splits > 20


SOUND = '{"order_id": 1, "products": []}'


@pytest.mark.parametrize(
    "text",
    [
        f'{{"orders": [{SOUND}, {SOUND}',
        f'{{"orders": [{SOUND}, {SOUND}]',
        f'{{"orders": [{SOUND}, {SOUND}]}} junk',
        f'{{"orders": [{SOUND}, {SOUND}]}}}}',
        f'{{"orders": [{SOUND} {SOUND}]}}',
        f'{{"orders": [{SOUND},, {SOUND}]}}',
        f'{{"orders": [{SOUND}, {SOUND},]}}',
        f'{{"orders": [{SOUND}, {{"order_id": 1, "products": 7}}]}}',
        f'{{"orders": [{SOUND}, {{"order_id": }}]}}',
        f'{{"orders": [{SOUND}, {{"order_id" 1}}]}}',
        f'{{"orders": [{SOUND}, {{"a": "open}}]}}',
        f'{{"orders": [{SOUND}]}}{{"orders": [{SOUND}]}}',
        f'{{"orders": [{SOUND}]}}, {SOUND}]}}',
    ],
)
def test_what_does_not_parse_is_an_error(spark, tmp_path, tiny_splits, text):
    folder = write(tmp_path / "in", broken=text, sound=f'{{"orders": [{SOUND}]}}')
    with pytest.raises((Py4JJavaError, PySparkException)):
        rows(read_orders_split(spark, folder))


def test_scratch_holds_the_orders_only(spark, tmp_path):
    folder = write(tmp_path / "in", sound=f'{{"orders": [{SOUND}]}}')
    found = read_orders_split(spark, folder)
    root = storage._application_folder(spark)
    mine = [p for p in storage.children(spark, root) if "split-documents" in p]
    assert found.count() == 1 and {c.rsplit("/", 1)[-1] for p in mine for c in storage.children(spark, p)} == {"pieces"}
