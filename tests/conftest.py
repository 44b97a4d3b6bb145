import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from orderlens.schema import RAW, TABLES  # noqa: E402
from orderlens.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("orderlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("catalog")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="session")
def items(spark):
    """Order items from dictionaries; fields that are left out get a default."""
    defaults = dict(
        order_id=1, user_id=1, order_number=1, order_dow=0, order_hour_of_day=9, days_since_prior_order=None,
        product_id=1, product_name="milk", department="dairy", aisle="cold", add_to_cart_order=1, reordered=0,
        ingestion_timestamp="2024-01-01 00:00:00",
    )

    def make(*given: dict) -> DataFrame:
        data = [tuple({**defaults, **g}[f] for f in RAW.fieldNames()) for g in given]
        return spark.createDataFrame(data, RAW)

    return make


@pytest.fixture(scope="session")
def mart(spark):
    """One of the marts from tuples in column order."""

    def make(name: str, data: list[tuple]) -> DataFrame:
        return spark.createDataFrame(data, TABLES[name])

    return make


@pytest.fixture(scope="session")
def departments(mart):
    return lambda **totals: mart("department_analytics", list(totals.items()))


@pytest.fixture(scope="session")
def hours(mart):
    return lambda totals: mart("hourly_analytics", list(totals.items()))


@pytest.fixture(scope="session")
def products(mart):
    """(name, department, total, reorders) with the rate of the mart."""

    def make(*given: tuple) -> DataFrame:
        return mart(
            "product_analytics",
            [(n, d, t, r, int(100 * r / t + 0.5) / 100 if t else 0.0) for n, d, t, r in given],
        )

    return make
