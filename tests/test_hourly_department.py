import pytest
from conftest import rows

from orderlens.plans import department as c
from orderlens.plans import hourly as b
from orderlens.plans import insights as i

SHARES = {"produce": 309, "dairy eggs": 167, "beverages": 102, "snacks": 92, "frozen": 69}


@pytest.fixture
def twenty(mart):
    """Five large departments and fifteen small ones, 1,072 items."""
    small = {f"small {n}": 22 for n in range(14)} | {"small 14": 1072 - sum(SHARES.values()) - 14 * 22}
    return mart("department_analytics", list((SHARES | small).items()))


def test_b1_published_shares(hours):
    day = {15: 133, 17: 132, 9: 119} | {10: 300, 11: 388}
    got = {r[0]: r[2] for r in rows(b.b1_hour_share(hours(day)))}
    assert (got[15], got[17], got[9]) == (12.41, 12.31, 11.1)
    assert sum(got.values()) == pytest.approx(100, abs=0.05)


def test_b2_segment_edges(hours):
    got = {r[0]: r[1:] for r in rows(b.b2_time_segments(hours({h: 1 for h in (4, 5, 11, 12, 17, 18, 21, 22)})))}
    assert got == {n: (2, 25.0) for n in ("Morning (05-11)", "Afternoon (12-17)", "Evening (18-21)", "Night (22-04)")}


def test_b3_runs_through_the_day(hours):
    assert rows(b.b3_running_total(hours({3: 5, 1: 2, 20: 4}))) == [(1, 2, 2), (3, 5, 7), (20, 4, 11)]


def test_b4_mean_itself_is_below(hours):
    got = rows(b.b4_hour_vs_avg(hours({0: 1, 1: 2, 2: 4})))
    assert got == [(0, 1, 2.33, "Below Average"), (1, 2, 2.33, "Below Average"), (2, 4, 2.33, "Above Average")]
    assert {r[3] for r in rows(b.b4_hour_vs_avg(hours({0: 2, 1: 2})))} == {"Below Average"}


def test_c1_published_shares(twenty):
    got = {r[0]: r[2] for r in rows(c.c1_market_share(twenty))}
    assert [got[d] for d in SHARES] == [28.82, 15.58, 9.51, 8.58, 6.44]
    assert rows(c.c1_market_share(twenty))[0][0] == "produce"


def test_c2_published_concentration(twenty, departments):
    assert rows(c.c2_concentration(twenty)) == [(20, 5, 68.94)]
    assert rows(c.c2_concentration(departments(a=49, b=50), threshold=50)) == [(2, 1, 50.51)]


def test_c3_outlier_and_equal_totals(departments):
    nine = departments(**{f"d{n}": 10 for n in range(9)}, big=100)
    got = rows(c.c3_zscore(nine))
    assert got[0] == ("big", 100, 3.0, "Anomaly")
    assert {r[2:] for r in got[1:]} == {(-0.33, "Normal")}
    assert {r[2:] for r in rows(c.c3_zscore(departments(a=5, b=5)))} == {(None, "Normal")}


def test_c4_compares_with_the_unrounded_mean(departments):
    got = {r[0]: r[2:] for r in rows(c.c4_vs_average(departments(a=1, b=2, c=4)))}
    assert got == {"a": (2.33, "Below Average"), "b": (2.33, "Below Average"), "c": (2.33, "Above Average")}
    assert {r[3] for r in rows(c.c4_vs_average(departments(a=2, b=2)))} == {"Below Average"}


def test_c5_ranks_and_gaps(departments, mart):
    assert rows(c.c5_gap_to_next(departments(a=10, c=5, b=5, d=1))) == [
        ("a", 10, 1, 5), ("b", 5, 2, 0), ("c", 5, 2, 4), ("d", 1, 4, None),
    ]
    assert rows(c.c5_gap_to_next(departments(a=10, b=4), lead_default=0))[-1] == ("b", 4, 2, 4)
    with_null = mart("department_analytics", [(None, 5), ("x", 5), ("y", 2)])
    assert rows(c.c5_gap_to_next(with_null)) == [("x", 5, 1, 0), (None, 5, 1, 3), ("y", 2, 3, None)]


def test_i4_cumulative_share(departments):
    assert rows(i.i4_pareto(departments(a=5, b=3, c=1, d=1))) == [
        ("a", 5, 5, 50.0), ("b", 3, 8, 80.0), ("c", 1, 10, 100.0), ("d", 1, 10, 100.0),
    ]


def test_i5_peak_window(hours):
    day = {h: 1 for h in range(24)} | {10: 9, 11: 3, 13: 8, None: 50}
    assert rows(i.i5_peak_window(hours(day))) == [(10, 14, 21)]
    assert rows(i.i5_peak_window(hours({1: 2, 5: 2}), width=1)) == [(1, 2, 2)]


def test_i6_groups_the_rest(departments):
    got = rows(i.i6_share_with_others(departments(a=90, b=5, c=3, d=2)))
    assert sorted(got) == [("Others", 5, 5.0), ("a", 90, 90.0), ("b", 5, 5.0)]


def test_i7_lowest(departments):
    assert rows(i.i7_lowest_departments(departments(bulk=1, other=1, produce=9))) == [("bulk", 1), ("other", 1)]
