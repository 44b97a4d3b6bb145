from orderlens.functions.casts import conform, safe_int, safe_int_variant, safe_str, to_raw_orders
from orderlens.functions.ratios import percent, ratio, settle
from orderlens.functions.text import readable_quantity

__all__ = [
    "conform",
    "percent",
    "ratio",
    "readable_quantity",
    "safe_int",
    "safe_int_variant",
    "safe_str",
    "settle",
    "to_raw_orders",
]
