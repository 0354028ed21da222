"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Each query is timed
to the last row through a sink that discards the rows; the session is warmed up
once before."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from daypanel import catalog  # noqa: E402

HEADLINE = (
    "scan_prices", "ingest_vendor_files", "filter_by_date", "trading_days", "day_index",
    "dedupe_keep_last", "price_lookup", "entry_vs_today", "stop_loss_signal", "sample_tickers",
    "initial_allocation", "buy_and_hold", "portfolio_value", "sell_decisions", "sell_proceeds",
    "buy_units", "merge_lots", "tradable_candidates", "pick_replacement", "rebalance_step",
    "scenario_backtest", "scenario_backtest_sampled_universe",
    "trade_ledger", "scenario_snapshot", "sim_chart_table", "valid_payloads",
    "pick_replacement_whole_market", "scenario_backtest_in_order", "scenario_backtest_documented", "held_prices",
    "merge_prices_deduplicated", "accepted_files",
)


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false")
             # No Python call sites in error messages: they cost more than the
             # plans of short queries.
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(fn, spark, sf_dir) -> float:
    started = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    seconds(catalog.QUERIES["scan_prices"], spark, sf_dir)
    seconds(catalog.QUERIES["rebalance_step"], spark, sf_dir)
    times = {name: round(seconds(catalog.QUERIES[name], spark, sf_dir), 3) for name in names}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf.group(1)) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
