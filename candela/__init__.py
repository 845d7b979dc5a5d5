"""candela: daily price-bar analytics on Spark DataFrames.

``bars`` is one long table (symbol, Date, Open, High, Low, Close, Volume, Dividends, Stock Splits);
every operator takes it and answers per symbol in a single lazy plan.
"""

from candela.schema import BARS_COLUMNS, BARS_SCHEMA

__all__ = ["BARS_COLUMNS", "BARS_SCHEMA"]
