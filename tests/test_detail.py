from conftest import rows

from orderlens.plans import detail as d
from orderlens.plans import insights as i


def test_d1_and_d2_published_totals(items):
    """1,084 items in 100 orders of 100 users, 825 products, positions 1 to 50."""
    raw = items(
        *({"order_id": n % 100, "user_id": 1000 + n % 100, "product_id": n % 825, "add_to_cart_order": n % 50 + 1}
          for n in range(1084))
    )
    assert rows(d.d1_totals(raw)) == [(1084, 100, 100, 825)]
    assert rows(d.d2_items_per_order(raw)) == [(10.84, 50, 1)]
    approx = d.d1_totals(raw, approx=True).first()
    assert approx.total_rows == 1084 and abs(approx.unique_products - 825) < 825 * 0.15


def test_d3_names_the_days(items):
    got = rows(d.d3_by_weekday(items(*({"order_dow": n} for n in (0, 1, 2, 3, 4, 5, 6, 7, 7)))))
    days = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    assert got == [(n, name, 1) for n, name in enumerate(days)] + [(7, None, 2)]


def test_d4_means_over_items(items):
    raw = items(
        {"order_id": 1, "days_since_prior_order": None},
        {"order_id": 2, "days_since_prior_order": 10},
        {"order_id": 2, "days_since_prior_order": 10},
        {"order_id": 3, "days_since_prior_order": 1},
        {"user_id": 2, "order_id": 4},
    )
    assert rows(d.d4_active_users(raw)) == [(1, 3, 4, 7.0), (2, 1, 1, None)]
    assert rows(d.d4_active_users(raw, n=1)) == [(1, 3, 4, 7.0)]


def test_d5_sums_raw_flags(items):
    raw = items({"reordered": 1}, {"reordered": 2}, {"reordered": None}, {"department": "x", "reordered": 0})
    assert rows(d.d5_department_reorder(raw)) == [("dairy", 3, 3, 100.0), ("x", 1, 0, 0.0)]


def test_d6_counts_orders(items):
    raw = items({"order_id": 1}, {"order_id": 1}, {"aisle": "a", "order_id": 1}, {"aisle": "a", "order_id": 2})
    assert rows(d.d6_top_aisles(raw)) == [("a", "dairy", 2, 2), ("cold", "dairy", 1, 2)]


def test_d7_needs_fifty_items(items):
    raw = items(
        *({"user_id": 1, "product_id": n} for n in range(49)),
        *({"user_id": 2, "product_id": n % 7, "reordered": n % 2} for n in range(50)),
        *({"user_id": 3, "product_id": 1, "reordered": n % 2} for n in range(52)),
    )
    assert rows(d.d7_consistent_users(raw)) == [(3, 52, 50.0, 1), (2, 50, 50.0, 7)]


def test_d8_shares(items):
    raw = items(*({"department": "a"} for _ in range(3)), {"department": "b"})
    assert rows(d.d8_department_share(raw)) == [("a", 3, 75.0), ("b", 1, 25.0)]


def test_d9_published_baskets(items):
    periods = {"Afternoon": (12, 466, 44), "Morning": (8, 309, 29), "Evening": (18, 152, 18), "Night": (2, 157, 9)}
    raw = items(
        *({"order_hour_of_day": hour, "order_id": hour * 1000 + n % orders, "user_id": hour * 1000 + n % orders}
          for hour, count, orders in periods.values() for n in range(count))
    )
    got = {r[0]: r[1:] for r in rows(d.d9_shopping_periods(raw))}
    assert got == {
        "Afternoon": (44, 44, 10.59), "Morning": (29, 29, 10.66), "Evening": (18, 18, 8.44), "Night": (9, 9, 17.44),
    }


def test_d9_period_edges(items):
    raw = items(*({"order_id": h, "order_hour_of_day": h} for h in (5, 6, 10, 11, 15, 16, 20, 21)))
    assert {r[0]: r[1] for r in rows(d.d9_shopping_periods(raw))} == {
        "Morning": 2, "Afternoon": 2, "Evening": 2, "Night": 2,
    }


def test_d10_counts_each_user_once(items):
    raw = items(
        *({"user_id": 1, "order_id": 1, "reordered": 1} for _ in range(3)), {"user_id": 2, "order_id": 2}
    )
    assert rows(d.d10_loyal_departments(raw)) == [("dairy", 1.0, 50.0, 2)]


def test_d11_groups(items):
    days = (None, 7, 8, 14, 15, 30, 31)
    raw = items(*({"user_id": n, "order_id": n, "days_since_prior_order": day} for n, day in enumerate(days)))
    assert {r[0]: r[1:3] for r in rows(d.d11_retention(raw))} == {
        "Weekly": (1, 1), "Biweekly": (2, 2), "Monthly": (2, 2), "Inactive": (1, 1),
    }


def test_d12_splits_one_order_by_position(items):
    raw = items(*({"add_to_cart_order": n} for n in range(1, 17)))
    assert rows(d.d12_basket_depth(raw)) == [
        ("Medium Basket", 1, 10, 10.0), ("Small Basket", 1, 5, 5.0), ("Large Basket", 1, 1, 1.0),
    ]


def test_insights_on_items(items):
    raw = items(
        {"order_number": 10, "days_since_prior_order": 7},
        {"order_number": 11, "days_since_prior_order": 7, "reordered": 1},
        {"order_number": 12, "days_since_prior_order": 30, "reordered": 1},
        {"order_number": None},
    )
    assert rows(i.i1_overall_rate(raw)) == [(50.0,)]
    assert rows(i.i2_interval_modes(raw)) == [(7, 2), (30, 1)]
    assert rows(i.i3_rate_by_tenure(raw)) == [("more than 10", 2, 100.0), ("up to 10", 2, 0.0)]
