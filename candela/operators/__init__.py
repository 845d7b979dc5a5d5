"""Operators over ``bars``: each is ``op(bars, ...) -> DataFrame``, lazy, answering every symbol."""

from candela.operators.anchored import (
    anchored_avg_price,
    anchored_avg_return,
    anchored_max_return_rate,
    anchored_monthly_variation,
    anchored_return_rate,
    anchored_volume_variation,
    mark_anchors,
)
from candela.operators.calendar import (
    avg_price_period,
    avg_price_until,
    avg_return,
    dividend_return,
    last_bar,
    max_return,
    max_return_rate,
    moving_average,
    period_return,
    period_return_until,
    return_rate,
    return_rate_period,
    stock_variation,
    stock_variation_until,
)
from candela.operators.correlation import column_correlation, correlation_between, correlation_matrix
from candela.operators.daily import intraday_variation, latest_average, max_daily_return, with_month_label
from candela.operators.explore import (
    date_span,
    descriptive_stats,
    head_and_tail,
    missing_counts,
    most_common,
    most_common_day,
    num_observations,
    sampling_frequency,
)

__all__ = [
    "anchored_avg_price",
    "anchored_avg_return",
    "anchored_max_return_rate",
    "anchored_monthly_variation",
    "anchored_return_rate",
    "anchored_volume_variation",
    "avg_price_period",
    "avg_price_until",
    "avg_return",
    "column_correlation",
    "correlation_between",
    "correlation_matrix",
    "date_span",
    "descriptive_stats",
    "dividend_return",
    "head_and_tail",
    "intraday_variation",
    "last_bar",
    "latest_average",
    "mark_anchors",
    "max_daily_return",
    "max_return",
    "max_return_rate",
    "missing_counts",
    "most_common",
    "most_common_day",
    "moving_average",
    "num_observations",
    "period_return",
    "period_return_until",
    "return_rate",
    "return_rate_period",
    "sampling_frequency",
    "stock_variation",
    "stock_variation_until",
    "with_month_label",
]
