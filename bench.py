"""Time the headline queries; prints one JSON line.

Each query is run in full into Spark's ``noop`` sink: all once to warm up, then each ``BENCH_RUNS`` times;
the best run counts. ``inputs`` gives the rows, symbols and slices of the bars that the queries read, ``rows`` what they
return, ``us_per_row`` the cost of a row for the two inputs that grow with the scale factor.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.operators.series import SLICE_BARS, cut, depth_cuts
from marketlake.session import build_session
from marketlake.sources import bars

HEADLINE = [
    "silver_bars",
    "silver_bars_hourly",
    "silver_clean",
    "silver_write_read",
    "many_symbols",
    "hot_series",
    "indicators_wide_sliced",
    "macd_sliced",
    "macd_scan",
    "silver_subset_rerun",
    "prices_upsert_twice",
    "stream_gold",
    "indicator_document_summary",
    "sma",
    "ema",
    "macd",
    "rsi",
    "bollinger",
    "atr",
    "pivot_points",
    "indicators_wide",
    "indicators_wide_hourly",
    "indicator_document",
    "batch_statistics",
    "volatility",
    "trend",
    "support_resistance",
    "gold_monthly",
    "gold_price_stats",
    "gold_price_stats_hourly",
    "gold_return_stats",
    "prices_range",
    "prices_ranged",
    "prices_upsert",
    "vendor_json_bars",
    "vendor_variant_bars",
    "mask_default",
    "mask_name",
    "batch_status",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "marketlake-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINE

    def timed(name: str) -> float:
        begun = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    def shape(found, grain: str | None, slice_bars: int = SLICE_BARS) -> dict[str, int]:
        found = cut(found, depth_cuts(found, slice_bars)) if grain else found.withColumn("slice", F.lit(0))
        counted = found.groupBy("symbol", "slice").agg(F.count("*").alias("n"))
        row = counted.agg(F.sum("n"), F.countDistinct("symbol"), F.count("*")).first()
        return dict(zip(("rows", "symbols", "slices"), row))

    inputs = {
        "daily": shape(bars.bars_daily(spark, folder), None),
        "hourly": shape(bars.bars_events(spark, folder), "hour"),
        "hourly_sliced": shape(bars.bars_events(spark, folder), "hour", 80),
        "many_symbols": shape(bars.bars_customers(spark, folder), None),
        "hot_series": shape(bars.bars_seconds(spark, folder), "second"),
    }
    for name in names:
        timed(name)
    seconds = {name: round(min(timed(name) for _ in range(runs)), 3) for name in names}
    rows = {name: queries[name](spark, folder).count() for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "inputs": inputs,
                "rows": rows,
                "us_per_row": {n: round(1e6 * seconds[n] / inputs[n]["rows"], 1) for n in ("many_symbols", "hot_series") if n in seconds},
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
