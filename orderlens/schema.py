"""Table shapes shared by the sources, the marts and the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, DOUBLE, STRING, VARIANT = (
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.StringType(),
    T.VariantType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Numbers in a fetched document stay variants until the safe cast, so that 7, 7.0 and " 7 "
# all become 7, integers beyond 2**53 keep every digit and "abc" becomes NULL.
PRODUCT_IN_ORDER = _struct(
    ("product_id", VARIANT),
    ("product_name", STRING),
    ("department", STRING),
    ("aisle", STRING),
    ("add_to_cart_order", VARIANT),
    ("reordered", VARIANT),
)
ORDER = _struct(
    ("order_id", VARIANT),
    ("user_id", VARIANT),
    ("order_number", VARIANT),
    ("order_dow", VARIANT),
    ("order_hour_of_day", VARIANT),
    ("days_since_prior_order", VARIANT),
    ("products", T.ArrayType(PRODUCT_IN_ORDER)),
)
DOCUMENT = _struct(("orders", T.ArrayType(ORDER)))

# One row per (order, product): the lake files and the detail table.
RAW = _struct(
    ("order_id", LONG),
    ("user_id", LONG),
    ("order_number", LONG),
    ("order_dow", INT),
    ("order_hour_of_day", INT),
    ("days_since_prior_order", INT),
    ("product_id", LONG),
    ("product_name", STRING),
    ("department", STRING),
    ("aisle", STRING),
    ("add_to_cart_order", INT),
    ("reordered", INT),
    ("ingestion_timestamp", STRING),
)

PRODUCT_ANALYTICS = _struct(
    ("product_name", STRING),
    ("department", STRING),
    ("total_orders", LONG),
    ("reorder_count", LONG),
    ("reorder_rate", DOUBLE),
)
HOURLY_ANALYTICS = _struct(("order_hour_of_day", INT), ("total_orders", LONG))
DEPARTMENT_ANALYTICS = _struct(("department", STRING), ("total_orders", LONG))

TABLES: dict[str, T.StructType] = {
    "raw_orders": RAW,
    "product_analytics": PRODUCT_ANALYTICS,
    "hourly_analytics": HOURLY_ANALYTICS,
    "department_analytics": DEPARTMENT_ANALYTICS,
}

# The keys each warehouse table is sorted by.
SORT_KEYS: dict[str, tuple[str, ...]] = {
    "raw_orders": ("order_id", "product_id"),
    "product_analytics": ("product_name", "department"),
    "hourly_analytics": ("order_hour_of_day",),
    "department_analytics": ("department",),
}

# Warehouse integer widths in bits (all unsigned) and the one column that may be empty.
UNSIGNED_BITS: dict[str, int] = {
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
NULLABLE = ("days_since_prior_order",)
