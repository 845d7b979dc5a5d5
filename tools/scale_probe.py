"""Scale probe: synthetic bars generated on the executors (``spark.range``), ``symbols`` x ``days``, cached,
then selected operators timed with the ``noop`` sink. Not a registered query; it shows how the
per-symbol plans behave with many symbols or very long series.

Usage: python tools/scale_probe.py SYMBOLS DAYS [CPUS]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def synthetic_bars(spark, symbols: int, days: int):
    from pyspark.sql import functions as F

    i = F.col("id")
    return spark.range(symbols * days).select(
        F.concat(F.lit("S"), (i % symbols).cast("string")).alias("symbol"),
        F.date_add(F.lit("1925-01-01").cast("date"), (i / symbols).cast("int")).alias("Date"),
        (F.rand(1) * 100 + 1).alias("Open"),
        (F.rand(2) * 100 + 1).alias("High"),
        (F.rand(3) * 100).alias("Low"),
        (F.rand(4) * 100 + 1).alias("Close"),
        (F.rand(5) * 1000).cast("bigint").alias("Volume"),
        F.lit(0.0).alias("Dividends"),
        F.lit(0.0).alias("Stock Splits"),
    )


def main() -> None:
    symbols, days = int(sys.argv[1]), int(sys.argv[2])
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    from pyspark.sql import SparkSession

    from candela import operators as ops

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bars = synthetic_bars(spark, symbols, days).cache()
    bars.count()
    cases = {
        "max_return_rate_y": lambda b: ops.max_return_rate(b, "y", 200),
        "return_rate_period_w": lambda b: ops.return_rate_period(b, "w", 200),
        "moving_average_5": lambda b: ops.moving_average(b, "Open", 5),
        "head_tail_40": lambda b: ops.head_and_tail(b),
        "anchored_return_rate_w": lambda b: ops.anchored_return_rate(b, "w"),
        "anchored_avg_price_m": lambda b: ops.anchored_avg_price(b, "m"),
        "anchored_volume_variation_y": lambda b: ops.anchored_volume_variation(b, "y"),
        "descriptive_stats": ops.descriptive_stats,
    }
    out = {}
    for name, build in cases.items():
        runs = []
        for _ in range(2):
            t0 = time.perf_counter()
            build(bars).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        out[name] = round(min(runs), 3)
    print(json.dumps({"symbols": symbols, "days": days, "rows": symbols * days, "cpus": cpus, "sec": out}))


if __name__ == "__main__":
    main()
