"""Reusable DataFrame operators: lazy, built-in expressions only, no actions."""

from bizmetrics.operators.adoption import (
    flags_to_long,
    join_member_counts,
    member_counts,
    membership_flags,
    metric_rows,
    repeat_rows,
    rollup_distinct,
)
from bizmetrics.operators.exact_sums import added_limbs, limb_sums, limbs_decimal, limbs_text
from bizmetrics.operators.hierarchy import hierarchy_metrics, month_spine, prior_period
from bizmetrics.operators.periods import (
    bucket_days,
    period_row,
    previous_month_days,
    report_date,
    with_bucket_end,
)
from bizmetrics.operators.sets import dense_numbers, levels_of, member_sets, set_sizes, trailing_months, united
from bizmetrics.operators.sketches import merged_sketches, quantile_sketches, rank_error, sketch_percentiles, sketch_size
from bizmetrics.operators.sums import attach_row, period_sums, row_value
from bizmetrics.operators.usage import (
    approx_percentiles,
    hourly_usage,
    join_segments,
    merged_average,
    segment_copies,
    usage_by_bucket,
)

__all__ = [
    "added_limbs",
    "approx_percentiles",
    "attach_row",
    "bucket_days",
    "dense_numbers",
    "flags_to_long",
    "hierarchy_metrics",
    "hourly_usage",
    "join_member_counts",
    "join_segments",
    "levels_of",
    "limb_sums",
    "limbs_decimal",
    "limbs_text",
    "member_counts",
    "member_sets",
    "membership_flags",
    "merged_average",
    "merged_sketches",
    "metric_rows",
    "month_spine",
    "period_row",
    "period_sums",
    "previous_month_days",
    "prior_period",
    "quantile_sketches",
    "rank_error",
    "repeat_rows",
    "report_date",
    "rollup_distinct",
    "row_value",
    "segment_copies",
    "set_sizes",
    "sketch_percentiles",
    "sketch_size",
    "trailing_months",
    "united",
    "usage_by_bucket",
    "with_bucket_end",
]
