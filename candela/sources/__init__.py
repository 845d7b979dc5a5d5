"""Sources and sinks of the price table ``bars``."""

from candela.sources.csv import csv_lines, latest_written, line_counts, read_bars_csv, refused_lines, typed_bars, write_bars_csv
from candela.sources.tables import bars_from_orders, load_bars, load_table, read_bars, write_bars

__all__ = [
    "bars_from_orders",
    "csv_lines",
    "latest_written",
    "line_counts",
    "load_bars",
    "load_table",
    "read_bars",
    "read_bars_csv",
    "refused_lines",
    "typed_bars",
    "write_bars",
    "write_bars_csv",
]
