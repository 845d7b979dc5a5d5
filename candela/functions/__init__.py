"""Column expressions shared by the operators (all JVM-side, no UDF)."""

from candela.functions.columns import (
    calendar_keys,
    month_label,
    newest_first,
    pct,
    pearson,
    position_return_rate,
    round_to,
)

__all__ = ["calendar_keys", "month_label", "newest_first", "pct", "pearson", "position_return_rate", "round_to"]
