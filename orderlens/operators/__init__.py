from orderlens.operators.dedupe import dedupe_latest
from orderlens.operators.marts import (
    build_marts,
    department_analytics,
    hourly_analytics,
    mart_grain,
    marts_from_grain,
    product_analytics,
    roll_up_departments,
)
from orderlens.operators.profiling import (
    describe_numeric,
    exact_percentiles,
    preview,
    profile_columns,
    sample_rows,
)
from orderlens.operators.quality import (
    broken_rules,
    cast_losses,
    read_quarantine,
    set_aside,
    sound_rows,
    validate_batches,
    validate_raw,
)
from orderlens.operators.ranking import tie_order, top_ranked
from orderlens.operators.sketches import distinct_sketches, merge_sketches, sketched_counts

__all__ = [
    "broken_rules",
    "build_marts",
    "cast_losses",
    "dedupe_latest",
    "department_analytics",
    "describe_numeric",
    "distinct_sketches",
    "exact_percentiles",
    "hourly_analytics",
    "mart_grain",
    "marts_from_grain",
    "merge_sketches",
    "preview",
    "product_analytics",
    "profile_columns",
    "read_quarantine",
    "roll_up_departments",
    "sample_rows",
    "set_aside",
    "sound_rows",
    "sketched_counts",
    "tie_order",
    "top_ranked",
    "validate_batches",
    "validate_raw",
]
