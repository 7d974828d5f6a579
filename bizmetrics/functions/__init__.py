"""Column expressions: built-in Spark functions only, so they stay inside whole-stage codegen."""

from bizmetrics.functions.arithmetic import growth_rate, least_strict, safe_divide, scaled
from bizmetrics.functions.dates import (
    as_date,
    hour_bucket,
    hour_of_day,
    month_label,
    month_week_end,
    month_week_start,
    months_before,
    years_before,
)
from bizmetrics.functions.identity import pseudonym_key

__all__ = [
    "as_date",
    "growth_rate",
    "hour_bucket",
    "hour_of_day",
    "least_strict",
    "month_label",
    "month_week_end",
    "month_week_start",
    "months_before",
    "pseudonym_key",
    "safe_divide",
    "scaled",
    "years_before",
]
