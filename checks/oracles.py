"""DuckDB counterparts of the queries.

DuckDB rounds the binary value of a double while Spark rounds its shortest decimal form, so every
rounded figure goes through a decimal here (:func:`_round`).
"""

from __future__ import annotations


def _round(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28, 12)), {digits}) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return _round(f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / nullif({whole}, 0)", 2)


ITEMS = """
items AS (
  SELECT
    l.l_orderkey AS order_id,
    o.o_custkey AS user_id,
    1 + (o.o_orderkey + o.o_custkey) % 24 AS order_number,
    CAST(dayofweek(o.o_orderdate) AS INTEGER) AS order_dow,
    CAST(o.o_orderkey % 12 + o.o_custkey % 13 AS INTEGER) AS order_hour_of_day,
    CASE WHEN (o.o_orderkey + o.o_custkey) % 24 > 0
         THEN CAST((o.o_orderkey * 7 + o.o_custkey * 3) % 41 AS INTEGER) END AS days_since_prior_order,
    l.l_partkey AS product_id,
    p.p_name AS product_name,
    p.p_brand AS department,
    p.p_brand || ' / ' || p.p_type AS aisle,
    CAST(l.l_linenumber + l.l_suppkey % 3 * 6 AS INTEGER) AS add_to_cart_order,
    CASE WHEN (l.l_orderkey + l.l_linenumber * 3 + l.l_suppkey) % 10
              < (length(p.p_name) * 3 + coalesce(try_cast(substr(p.p_brand, 7, 10) AS INTEGER), 0)) % 11
         THEN 1 ELSE 0 END AS reordered,
    '2024-01-01 00:00:00' AS ingestion_timestamp
  FROM lineitem l
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
)"""

PRODUCTS = f"""
products AS (
  SELECT product_name, department, total_orders, reorder_count,
         CASE WHEN total_orders > 0 THEN {_round('reorder_count / total_orders', 2)} ELSE 0.0::DOUBLE END AS reorder_rate
  FROM (SELECT product_name, department, count(order_id) AS total_orders,
               count(*) FILTER (reordered = 1) AS reorder_count
        FROM items GROUP BY ALL)
)"""

HOURS = "hours AS (SELECT order_hour_of_day, count(order_id) AS total_orders FROM items GROUP BY ALL)"
DEPARTMENTS = "departments AS (SELECT department, count(order_id) AS total_orders FROM items GROUP BY ALL)"

PRODUCT_ORDER = "product_name NULLS LAST, department NULLS LAST"


def _items(select: str) -> str:
    return f"WITH {ITEMS} {select}"


def _products(select: str) -> str:
    return f"WITH {ITEMS}, {PRODUCTS} {select}"


def _hours(select: str) -> str:
    return f"WITH {ITEMS}, {HOURS} {select}"


def _departments(select: str) -> str:
    return f"WITH {ITEMS}, {DEPARTMENTS} {select}"


def _top_reorder(min_orders: int, n: int) -> str:
    return _products(
        f"SELECT * FROM products WHERE total_orders >= {min_orders} "
        f"ORDER BY reorder_rate DESC, {PRODUCT_ORDER} LIMIT {n}"
    )


def _top_per_department(n: int) -> str:
    return _products(f"""
      SELECT department, product_name, total_orders, reorder_rate, CAST(r AS INTEGER) AS rank_in_dept
      FROM (SELECT *, rank() OVER (PARTITION BY department ORDER BY total_orders DESC) AS r FROM products)
      WHERE r <= {n}""")


def _evergreen(min_orders: int) -> str:
    return _products(f"""
      SELECT product_name, department, total_orders, reorder_rate,
             {_round('total_orders * reorder_rate', 2)} AS loyalty_score
      FROM products WHERE total_orders >= {min_orders}
      ORDER BY loyalty_score DESC, {PRODUCT_ORDER} LIMIT 15""")


# The labels of the groups in the statements below are fixed values: results are compared with them.
def _buckets(cases: str) -> str:
    return _products(f"""
      SELECT CASE {cases} WHEN reorder_rate >= 0.5 THEN 'Medium (50-79%)'
                  WHEN reorder_rate >= 0.2 THEN 'Low (20-49%)' ELSE 'Very Low (<20%)' END AS reorder_bucket,
             count(*) AS product_count, CAST(sum(total_orders) AS BIGINT) AS total_orders
      FROM products GROUP BY 1""")


def _concentration(threshold: int) -> str:
    held = f"sum(total_orders) FILTER (total_orders >= {threshold})"
    return _departments(f"""
      SELECT count(*) AS total_departments, count(*) FILTER (total_orders >= {threshold}) AS major_departments,
             {_pct(f'coalesce({held}, 0)', 'sum(total_orders)')} AS pct_orders_from_major_departments
      FROM departments""")


def _zscore(z: float) -> str:
    return _departments(f"""
      SELECT department, total_orders, {_round('z', 2)} AS z_score,
             CASE WHEN abs(z) >= {z} THEN 'Anomaly' ELSE 'Normal' END AS anomaly_status
      FROM (SELECT *, (total_orders - avg(total_orders) OVER ()) / nullif(stddev_pop(total_orders) OVER (), 0) AS z
            FROM departments)""")


def _gap(default: str) -> str:
    return _departments(f"""
      SELECT department, total_orders, CAST(rank() OVER (ORDER BY total_orders DESC) AS INTEGER) AS dept_rank,
             total_orders - lead(total_orders, 1, {default}) OVER (ORDER BY total_orders DESC, department NULLS LAST)
               AS gap_to_next
      FROM departments""")


def _consistent(min_items: int, n: int) -> str:
    return _items(f"""
      SELECT user_id, count(*) AS total_items, {_round('avg(reordered) * 100', 2)} AS reorder_rate_pct,
             count(DISTINCT product_id) AS unique_products
      FROM items GROUP BY user_id HAVING total_items >= {min_items}
      ORDER BY reorder_rate_pct DESC, total_items DESC, user_id NULLS LAST LIMIT {n}""")


def _depth(small: int, medium: int) -> str:
    return _items(f"""
      SELECT CASE WHEN add_to_cart_order <= {small} THEN 'Small Basket'
                  WHEN add_to_cart_order <= {medium} THEN 'Medium Basket' ELSE 'Large Basket' END AS basket_depth,
             count(DISTINCT order_id) AS total_orders, count(*) AS total_items,
             {_round('count(*) / count(DISTINCT order_id)', 2)} AS avg_items_per_order
      FROM items GROUP BY 1""")


def _others(min_pct: int) -> str:
    return _departments(f"""
      SELECT name AS department, CAST(sum(total_orders) AS BIGINT) AS total_orders,
             {_pct('sum(total_orders)', 'any_value(whole)')} AS market_share_pct
      FROM (SELECT if(total_orders * 100 >= {min_pct} * whole, department, 'Others') AS name, total_orders, whole
            FROM (SELECT *, sum(total_orders) OVER () AS whole FROM departments))
      GROUP BY name""")


def _reports() -> dict[str, str]:
    return {
        "a1_top_products": _products(f"FROM products ORDER BY total_orders DESC, {PRODUCT_ORDER} LIMIT 10"),
        "a2_top_reorder": _top_reorder(5, 10),
        "a2_top_reorder_min_60": _top_reorder(60, 25),
        "a3_lowest_reorder": _products(f"FROM products ORDER BY reorder_rate, {PRODUCT_ORDER} LIMIT 10"),
        "a4_department_breadth": _products("""
          SELECT department, count(product_name) AS total_products, CAST(sum(total_orders) AS BIGINT) AS total_orders_dept
          FROM products GROUP BY department"""),
        "a5_department_avg_rate": _products(f"""
          SELECT department,
                 {_round('CAST(sum(CAST(reorder_rate AS DECIMAL(18, 2))) AS DOUBLE) / count(reorder_rate)', 4)}
                   AS avg_reorder_rate,
                 CAST(sum(total_orders) AS BIGINT) AS total_orders
          FROM products GROUP BY department"""),
        "a6_top_per_department": _top_per_department(5),
        "a6_top_2_per_department": _top_per_department(2),
        "a7_evergreen": _evergreen(30),
        "a7_evergreen_min_80": _evergreen(80),
        "a8_rate_buckets": _buckets("WHEN reorder_rate >= 0.8 THEN 'High (>=80%)'"),
        "a8_five_buckets": _buckets(
            "WHEN reorder_rate >= 0.9 THEN 'Very High (>=90%)' WHEN reorder_rate >= 0.8 THEN 'High (80-89%)'"
        ),
        "a9_orders_vs_reorders": _products(f"""
          SELECT department, CAST(sum(total_orders) AS BIGINT) AS total_orders,
                 CAST(sum(reorder_count) AS BIGINT) AS total_reorders,
                 {_round('sum(reorder_count) / nullif(sum(total_orders), 0)', 4)} AS dept_reorder_rate
          FROM products GROUP BY department"""),
        "a10_first_time_dominant": _products(f"""
          SELECT product_name, department, total_orders, reorder_rate, total_orders - reorder_count AS new_buyer_orders
          FROM products WHERE reorder_rate < 0.3 AND total_orders >= 10
          ORDER BY new_buyer_orders DESC, {PRODUCT_ORDER} LIMIT 15"""),
        "b1_hour_share": _hours(
            f"SELECT *, {_pct('total_orders', 'sum(total_orders) OVER ()')} AS pct_of_day FROM hours"
        ),
        "b2_time_segments": _hours(f"""
          SELECT *, {_pct('total_orders', 'sum(total_orders) OVER ()')} AS pct
          FROM (SELECT CASE WHEN order_hour_of_day BETWEEN 5 AND 11 THEN 'Morning (05-11)'
                            WHEN order_hour_of_day BETWEEN 12 AND 17 THEN 'Afternoon (12-17)'
                            WHEN order_hour_of_day BETWEEN 18 AND 21 THEN 'Evening (18-21)'
                            ELSE 'Night (22-04)' END AS time_segment,
                       CAST(sum(total_orders) AS BIGINT) AS total_orders
                FROM hours GROUP BY 1)"""),
        "b3_running_total": _hours("""
          SELECT *, CAST(sum(total_orders) OVER (ORDER BY order_hour_of_day) AS BIGINT) AS cumulative_orders FROM hours"""),
        "b4_hour_vs_avg": _hours(f"""
          SELECT order_hour_of_day, total_orders, {_round('mean', 2)} AS daily_avg,
                 if(total_orders > mean, 'Above Average', 'Below Average') AS vs_avg
          FROM (SELECT *, avg(total_orders) OVER () AS mean FROM hours)"""),
        "c1_market_share": _departments(
            f"SELECT *, {_pct('total_orders', 'sum(total_orders) OVER ()')} AS market_share_pct FROM departments"
        ),
        "c2_concentration": _concentration(50),
        "c2_concentration_2400": _concentration(2400),
        "c3_zscore": _zscore(2),
        "c3_zscore_1": _zscore(1),
        "c4_vs_average": _departments(f"""
          SELECT department, total_orders, {_round('mean', 2)} AS avg_orders,
                 if(total_orders > mean, 'Above Average', 'Below Average') AS performance
          FROM (SELECT *, avg(total_orders) OVER () AS mean FROM departments)"""),
        "c5_gap_to_next": _gap("NULL"),
        "c5_gap_to_zero": _gap("0"),
        "d1_totals": _items("""
          SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_orders,
                 count(DISTINCT user_id) AS unique_users, count(DISTINCT product_id) AS unique_products
          FROM items"""),
        "d2_items_per_order": _items(f"""
          SELECT {_round('count(*) / count(DISTINCT order_id)', 2)} AS avg_items_per_order,
                 max(add_to_cart_order) AS max_items_in_one_order, min(add_to_cart_order) AS min_items_in_one_order
          FROM items"""),
        "d3_by_weekday": _items("""
          SELECT order_dow,
                 ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][order_dow + 1] AS day_name,
                 count(*) AS total_orders
          FROM items GROUP BY order_dow"""),
        "d4_active_users": _items(f"""
          SELECT user_id, count(DISTINCT order_id) AS total_orders, count(*) AS total_items,
                 {_round('avg(days_since_prior_order)', 1)} AS avg_days_between_orders
          FROM items GROUP BY user_id ORDER BY total_orders DESC, user_id NULLS LAST LIMIT 10"""),
        "d5_department_reorder": _items(f"""
          SELECT department, count(*) AS total_items, CAST(sum(reordered) AS BIGINT) AS reordered_items,
                 {_pct('sum(reordered)', 'count(*)')} AS reorder_rate_pct
          FROM items GROUP BY department"""),
        "d6_top_aisles": _items("""
          SELECT aisle, department, count(DISTINCT order_id) AS unique_orders, count(*) AS total_items
          FROM items GROUP BY ALL
          ORDER BY unique_orders DESC, aisle NULLS LAST, department NULLS LAST LIMIT 10"""),
        "d7_consistent_users": _consistent(50, 20),
        "d7_consistent_users_min_70": _consistent(70, 50),
        "d8_department_share": _items(f"""
          SELECT *, {_pct('total_items', 'sum(total_items) OVER ()')} AS contribution_pct
          FROM (SELECT department, count(*) AS total_items FROM items GROUP BY department)"""),
        "d9_shopping_periods": _items(f"""
          SELECT CASE WHEN order_hour_of_day BETWEEN 6 AND 10 THEN 'Morning'
                      WHEN order_hour_of_day BETWEEN 11 AND 15 THEN 'Afternoon'
                      WHEN order_hour_of_day BETWEEN 16 AND 20 THEN 'Evening' ELSE 'Night' END AS shopping_period,
                 count(DISTINCT order_id) AS total_orders, count(DISTINCT user_id) AS active_users,
                 {_round('count(*) / count(DISTINCT order_id)', 2)} AS avg_items_per_order
          FROM items GROUP BY 1"""),
        "d10_loyal_departments": _items(f"""
          SELECT department, {_round('avg(orders)', 2)} AS avg_orders_per_user,
                 {_round('avg(rate) * 100', 2)} AS avg_reorder_rate_pct, count(user_id) AS total_users
          FROM (SELECT department, user_id, count(DISTINCT order_id) AS orders, avg(reordered) AS rate
                FROM items GROUP BY ALL)
          GROUP BY department"""),
        "d11_retention": _items(f"""
          SELECT CASE WHEN days_since_prior_order <= 7 THEN 'Weekly' WHEN days_since_prior_order <= 14 THEN 'Biweekly'
                      WHEN days_since_prior_order <= 30 THEN 'Monthly' ELSE 'Inactive' END AS retention_group,
                 count(DISTINCT user_id) AS total_users, count(DISTINCT order_id) AS total_orders,
                 {_round('avg(reordered) * 100', 2)} AS reorder_rate_pct
          FROM items WHERE days_since_prior_order IS NOT NULL GROUP BY 1"""),
        "d12_basket_depth": _depth(5, 15),
        "d12_basket_depth_2_5": _depth(2, 5),
        "i1_overall_rate": _items(f"SELECT {_round('avg(reordered) * 100', 2)} AS reorder_rate_pct FROM items"),
        "i2_interval_modes": _items("""
          SELECT days_since_prior_order, count(*) AS total_items FROM items WHERE days_since_prior_order IS NOT NULL
          GROUP BY ALL ORDER BY total_items DESC, days_since_prior_order LIMIT 2"""),
        "i3_rate_by_tenure": _items(f"""
          SELECT if(order_number > 10, 'more than 10', 'up to 10') AS order_tenure, count(*) AS total_items,
                 {_round('avg(reordered) * 100', 2)} AS reorder_rate_pct
          FROM items GROUP BY 1"""),
        "i4_pareto": _departments(f"""
          SELECT department, total_orders, CAST(through AS BIGINT) AS cumulative_orders,
                 {_pct('through', 'sum(total_orders) OVER ()')} AS cumulative_pct
          FROM (SELECT *, sum(total_orders) OVER (ORDER BY total_orders DESC) AS through FROM departments)"""),
        "i5_peak_window": _hours("""
          SELECT h.order_hour_of_day AS start_hour, h.order_hour_of_day + 4 AS end_hour,
                 CAST(sum(g.total_orders) AS BIGINT) AS total_orders
          FROM hours h JOIN hours g ON g.order_hour_of_day BETWEEN h.order_hour_of_day AND h.order_hour_of_day + 3
          GROUP BY ALL ORDER BY total_orders DESC, start_hour LIMIT 1"""),
        "i6_share_with_others": _others(5),
        "i6_share_with_others_4": _others(4),
        "i7_lowest_departments": _departments(
            "FROM departments ORDER BY total_orders, department NULLS LAST LIMIT 2"
        ),
    }


# The warehouse's integer widths.
def _unsigned_and_null_rules() -> str:
    unsigned = {
        "order_id": 32,
        "user_id": 32,
        "order_number": 32,
        "order_dow": 8,
        "order_hour_of_day": 8,
        "days_since_prior_order": 16,
        "product_id": 32,
        "add_to_cart_order": 8,
        "reordered": 8,
    }
    filled = [c for c in unsigned if c != "days_since_prior_order"]
    filled += ["product_name", "department", "aisle", "ingestion_timestamp"]
    rules = [f"SELECT '{c} not null' AS rule, count(*) FILTER ({c} IS NULL) AS violations FROM faulty" for c in filled]
    rules += [
        f"SELECT '{c} fits uint{bits}', count(*) FILTER ({c} < 0 OR {c} >= {2**bits}) FROM faulty"
        for c, bits in unsigned.items()
    ]
    return " UNION ALL ".join(rules)


COLUMN_TYPES = {
    "order_id": "bigint",
    "user_id": "bigint",
    "order_number": "bigint",
    "order_dow": "int",
    "order_hour_of_day": "int",
    "days_since_prior_order": "int",
    "product_id": "bigint",
    "product_name": "string",
    "department": "string",
    "aisle": "string",
    "add_to_cart_order": "int",
    "reordered": "int",
    "ingestion_timestamp": "string",
}


def _described(column: str) -> str:
    quantiles = ", ".join(
        f"CAST(quantile_cont(CAST({column} AS DOUBLE), {q}) AS DECIMAL(38, 6)) AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75)
    )
    return f"""
      SELECT '{column}' AS column_name, count({column}) AS non_null_count, {_round(f'avg({column})', 6)} AS mean,
             {_round(f'stddev_samp({column})', 6)} AS std, CAST(min({column}) AS DECIMAL(38, 6)) AS min, {quantiles},
             CAST(max({column}) AS DECIMAL(38, 6)) AS max
      FROM items"""


def _quantity_text(n: str) -> str:
    units = (("quadrillion", 15), ("trillion", 12), ("billion", 9), ("million", 6), ("thousand", 3))
    cases = " ".join(
        f"WHEN {n} >= 1e{power} THEN printf('%.2f {unit}', CAST({n} AS DOUBLE) / 1e{power})" for unit, power in units
    )
    return f"CASE {cases} ELSE printf('%.2f', CAST({n} AS DOUBLE)) END"


def _counts(tables: dict[str, str]) -> str:
    union = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {source}" for t, source in tables.items())
    return f"SELECT table_name, n AS total_rows, {_quantity_text('n')} AS total_rows_text FROM ({union})"


def _operators() -> dict[str, str]:
    all_marts = f"""
        WITH {ITEMS}, {PRODUCTS}, {HOURS}, {DEPARTMENTS}
        SELECT 'product_analytics' AS table_name, * FROM products
        UNION ALL BY NAME SELECT 'hourly_analytics' AS table_name, * FROM hours
        UNION ALL BY NAME SELECT 'department_analytics' AS table_name, * FROM departments"""
    all_rows = _items("FROM items")
    keys = "order_id, product_id, add_to_cart_order, reordered"
    numeric = [c for c, kind in COLUMN_TYPES.items() if kind != "string"]
    return {
        "product_analytics": _products("FROM products"),
        "hourly_analytics": _hours("FROM hours"),
        "department_analytics": _departments("FROM departments"),
        "marts_from_grain": _products("FROM products"),
        "run_refresh": all_rows,
        "run_refresh_products": _products("FROM products"),
        "incremental_refresh": all_rows,
        "stream_hourly_counts": """
          SELECT date_trunc('hour', ts) AS hour_start, event_type, count(*) AS events
          FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
        "stream_refresh": all_rows,
        "parse_orders": all_rows,
        "read_orders_json": all_rows,
        "read_orders_json_whole_files": all_rows,
        "read_lake_mixed": all_rows,
        "read_orders_split": all_rows,
        "flatten_orders": all_rows,
        "read_batch": all_rows,
        "refresh_table": all_rows,
        "refresh_empty": f"WITH {ITEMS}, {PRODUCTS}, {HOURS}, {DEPARTMENTS} "
        + _counts(
            {
                "raw_orders": "items",
                "product_analytics": "products",
                "hourly_analytics": "(FROM hours LIMIT 0)",
                "department_analytics": "departments",
            }
        ),
        "land_batch": all_rows,
        "ensure_tables": all_rows,
        "roll_up_departments": _departments("FROM departments"),
        "cleanup_lake": _items("SELECT '2024-01-02 00:00:00' AS ingestion_timestamp, count(*) AS total_rows FROM items"),
        "with_ingestion_ts": _items(
            "SELECT order_id, product_id, '2024-05-01 12:00:00' AS ingestion_timestamp FROM items"
        ),
        "read_lake": all_rows,
        "to_raw_orders": _items("""
          SELECT * REPLACE (coalesce(product_name, '') AS product_name, coalesce(department, '') AS department,
                            coalesce(aisle, '') AS aisle)
          FROM items"""),
        "build_marts": all_marts,
        "incremental_marts": all_marts,
        "load_report": f"WITH {ITEMS}, {PRODUCTS}, {HOURS}, {DEPARTMENTS} "
        + _counts(
            {
                "raw_orders": "items",
                "product_analytics": "products",
                "hourly_analytics": "hours",
                "department_analytics": "departments",
            }
        ),
        "table_counts": _counts({t: t for t in ("lineitem", "orders", "part", "events")}),
        "readable_quantity": f"""
          SELECT line, times, n * times AS quantity, {_quantity_text('n * times')} AS quantity_text
          FROM (SELECT l_linenumber AS line, count(*) AS n FROM lineitem GROUP BY ALL),
               (SELECT CAST(unnest([1, 100, 10000, 1000000, 100000000, 10000000000, 1000000000000]) AS BIGINT) AS times)""",
        "safe_int": """
          SELECT event_id, CAST(trunc(value) AS BIGINT) AS from_float, CAST(trunc(-value) AS BIGINT) AS from_negative,
                 event_id AS from_padded, NULL::BIGINT AS from_fraction_text, NULL::BIGINT AS from_word,
                 NULL::BIGINT AS from_nan, if(user_id BETWEEN -128 AND 127, CAST(user_id AS INTEGER), NULL) AS from_wide
          FROM events""",
        "safe_str": """
          SELECT event_id, coalesce(event_type, '') AS from_text,
                 if(event_id % 3 = 0, coalesce(CAST(user_id AS VARCHAR), ''), '') AS from_number, '' AS from_nan
          FROM events""",
        "dedupe_latest": f"""
          WITH {ITEMS}, copies AS (
            FROM items UNION ALL
            SELECT * REPLACE (add_to_cart_order + 1 AS add_to_cart_order, '2024-01-02 00:00:00' AS ingestion_timestamp)
            FROM items)
          SELECT * EXCLUDE (newest) FROM (
            SELECT *, max(ingestion_timestamp) OVER (PARTITION BY order_id, product_id) AS newest FROM copies)
          WHERE ingestion_timestamp = newest OR order_id IS NULL OR product_id IS NULL""",
        "preview": _items(f"FROM items ORDER BY {keys} LIMIT 5"),
        "sample_rows": _items(f"FROM items ORDER BY md5(concat_ws('|', '42', {keys})), {keys} LIMIT 5"),
        "profile_columns": _items(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count({c}) AS non_null_count FROM items"
                for c, kind in COLUMN_TYPES.items()
            )
        ),
        "describe_numeric": _items(" UNION ALL ".join(_described(c) for c in numeric)),
        "cast_losses": _items("""
          SELECT 'days_since_prior_order survives the cast' AS rule,
                 count(*) FILTER (days_since_prior_order * 1e8 >= 2147483648) AS violations FROM items
          UNION ALL SELECT 'add_to_cart_order survives the cast', count(*) FILTER (reordered = 1) FROM items"""),
        "set_aside": _items("""
          SELECT if(order_id % 2 = 0, 'orders_1.parquet', 'orders_2.parquet') AS batch,
                 concat_ws('; ',
                   if(order_id % 2 <> 0 AND days_since_prior_order * 1e8 >= 2147483648, 'days_since_prior_order survives the cast', NULL),
                   if(user_id % 7 = 0, 'user_id not null', NULL),
                   if(order_hour_of_day + 240 > 255, 'order_hour_of_day fits uint8', NULL),
                   if(order_id % 2 <> 0 AND days_since_prior_order * 1e8 BETWEEN 65536 AND 2147483647, 'days_since_prior_order fits uint16', NULL)) AS broken,
                 count(*) AS total_rows
          FROM items GROUP BY ALL"""),
        "distinct_sketches": _items("""
          SELECT name AS department, count(DISTINCT order_id) AS order_id, count(DISTINCT user_id) AS user_id,
                 count(DISTINCT product_id) AS product_id, true AS order_id_near, true AS user_id_near, true AS product_id_near
          FROM (SELECT unnest([department, 'all']) AS name, order_id, user_id, product_id FROM items) GROUP BY ALL"""),
        "validate_raw": f"""
          WITH {ITEMS}, faulty AS (
            SELECT * REPLACE (
              if(user_id % 7 <> 0, user_id, NULL) AS user_id, if(order_dow <> 3, department, NULL) AS department,
              order_hour_of_day + 240 AS order_hour_of_day, reordered - 1 AS reordered)
            FROM items)
          {_unsigned_and_null_rules()}""",
    }


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL over the same tables."""
    return {**_reports(), **_operators()}
