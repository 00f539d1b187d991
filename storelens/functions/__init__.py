"""Column-level helpers shared by the operators."""

from storelens.functions.dates import (add_days, calendar_days_between, month_label,
                                       whole_days_between)
from storelens.functions.numeric import (cents, exact_mean, from_cents, half_up_ratio,
                                         money_sum, percent, wide_sum)

__all__ = [
    "add_days", "calendar_days_between", "month_label", "whole_days_between",
    "cents", "exact_mean", "from_cents", "half_up_ratio", "money_sum", "percent",
    "wide_sum",
]
