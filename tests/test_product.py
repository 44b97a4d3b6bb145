from conftest import rows

from orderlens.plans import product as p


def names(df):
    return [r.product_name for r in df.collect()]


def test_a1_orders_by_total_and_breaks_ties_by_name(products):
    mart = products(("b", "x", 5, 0), ("a", "y", 5, 0), ("a", "x", 5, 0), ("c", "x", 9, 0), (None, "x", 5, 0))
    got = p.a1_top_products(mart, n=4)
    assert [(r.product_name, r.department) for r in got.collect()] == [("c", "x"), ("a", "x"), ("a", "y"), ("b", "x")]
    assert got.columns == ["product_name", "department", "total_orders", "reorder_count", "reorder_rate"]


def test_a2_needs_five_orders(products):
    assert names(p.a2_top_reorder(products(("four", "d", 4, 4), ("five", "d", 5, 1)))) == ["five"]


def test_a3_has_no_minimum(products):
    assert names(p.a3_lowest_reorder(products(("x", "d", 1, 0), ("y", "d", 9, 1), ("z", "d", 2, 2)), n=2)) == ["x", "y"]


def test_a4_counts_named_products(products):
    mart = products(("a", "d", 2, 0), (None, "d", 3, 0), ("c", None, 1, 0))
    assert rows(p.a4_department_breadth(mart)) == [("d", 1, 5), (None, 1, 1)]


def test_a5_is_unweighted(products):
    mart = products(("a", "d", 100, 100), ("b", "d", 1, 0), ("c", "e", 3, 1), ("f", "e", 3, 2))
    assert sorted(rows(p.a5_department_avg_rate(mart))) == [("d", 0.5, 101), ("e", 0.5, 6)]


def test_a6_keeps_ties(products):
    totals = (9, 8, 8, 7, 6, 6, 5)
    mart = products(*((f"p{i}", "d", t, 0) for i, t in enumerate(totals)), ("q", None, 3, 0))
    got = rows(p.a6_top_per_department(mart))
    assert sorted(r[4] for r in got if r[0] == "d") == [1, 2, 2, 4, 5, 5]
    assert [r for r in got if r[0] is None] == [(None, "q", 3, 0.0, 1)]
    assert [r[0] for r in got] == ["d"] * 6 + [None]


def test_a7_score_and_minimum(products):
    mart = products(("few", "d", 29, 29), ("a", "d", 30, 15), ("b", "d", 40, 10))
    assert rows(p.a7_evergreen(mart)) == [("a", "d", 30, 0.5, 15.0), ("b", "d", 40, 0.25, 10.0)]


def test_a8_bucket_edges(products):
    mart = products(*((f"r{r}", "d", 100, r) for r in (19, 20, 49, 50, 79, 80)))
    got = {r[0]: r[1:] for r in rows(p.a8_rate_buckets(mart))}
    assert got == {
        "Very Low (<20%)": (1, 100), "Low (20-49%)": (2, 200), "Medium (50-79%)": (2, 200), "High (>=80%)": (1, 100),
    }


def test_a8_takes_other_buckets(products):
    mart = products(("a", "d", 10, 9), ("b", "d", 10, 1))
    got = p.a8_rate_buckets(mart, floors=((0.5, "half or more"),), rest="less")
    assert sorted(r.reorder_bucket for r in got.collect()) == ["half or more", "less"]


def test_a9_is_weighted_and_survives_zero(products):
    mart = products(("a", "d", 100, 50), ("b", "d", 50, 0), ("c", "e", 0, 0))
    assert {r[0]: r[1:] for r in rows(p.a9_orders_vs_reorders(mart))} == {"d": (150, 50, 0.3333), "e": (0, 0, None)}


def test_a10_edges(products):
    mart = products(("nine", "d", 9, 0), ("ten", "d", 10, 2), ("rate30", "d", 10, 3), ("big", "d", 50, 10))
    assert rows(p.a10_first_time_dominant(mart)) == [("big", "d", 50, 0.2, 40), ("ten", "d", 10, 0.2, 8)]
