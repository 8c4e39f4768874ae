"""Reusable DataFrame operators."""

from finlake.operators.cdc import (  # noqa: F401
    scd1_upsert, latest_snapshot, snapshot_diff, snapshot_apply, null_safe_join_cond,
)
from finlake.operators.spine import day_spine, month_spine, dense_panel, month_bounds  # noqa: F401
from finlake.operators.windows import (  # noqa: F401
    running_total, trailing_sum, trailing_mean, partition_totals, previous_value,
)
from finlake.operators.aggregates import conditional_sums, pivot_sums  # noqa: F401
