from .dates import (cash_lag_date, in_years, month_name, month_start, padded,
                    prior_month_start, quarter_label, weekday_name, weekday_sunday0,
                    year_at_most)
from .money import amount, or_zero, pct_change, round2

__all__ = [
    "amount", "cash_lag_date", "in_years", "month_name", "month_start", "or_zero",
    "padded", "pct_change", "prior_month_start", "quarter_label", "round2",
    "weekday_name", "weekday_sunday0", "year_at_most",
]
