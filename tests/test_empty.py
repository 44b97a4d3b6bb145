import pytest
from conftest import rows

from orderlens.operators import build_marts, describe_numeric, preview, profile_columns, validate_raw
from orderlens.plans import REPORTS, run
from orderlens.schema import RAW, TABLES

ONE_ROW = {"c2_concentration": (0, None, None), "d1_totals": (0, 0, 0, 0), "d2_items_per_order": (None, None, None),
           "i1_overall_rate": (None,)}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_accept_empty_tables(spark, name):
    table = REPORTS[name].table
    got = rows(run(name, {table: spark.createDataFrame([], TABLES[table])}))
    assert got == ([ONE_ROW[name]] if name in ONE_ROW else [])


def test_operators_accept_an_empty_frame(spark):
    raw = spark.createDataFrame([], RAW)
    assert all(df.isEmpty() for df in build_marts(raw).values())
    assert preview(raw).isEmpty()
    assert {r.non_null_count for r in profile_columns(raw).collect()} == {0}
    assert {r.violations for r in validate_raw(raw).collect()} == {0}
    described = describe_numeric(raw).collect()
    assert len(described) == 9 and {r.p50 for r in described} == {None}


def test_unknown_report(spark):
    with pytest.raises(KeyError, match="no report named"):
        run("a99", {})
