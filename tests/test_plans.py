"""What the planner makes of the operators."""

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from daypanel import catalog, session
from daypanel.operators import panel
from daypanel.sources import vendor

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Results read from the same steps have one plan; the steps run once here.
SAME_STEPS = {n for n in catalog.QUERIES if n.startswith(("scenario_", "sim_", "trade_"))} - {"scenario_backtest"}


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in SAME_STEPS])
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow"):
        assert word not in plan, f"{word} in {name}"


def test_date_bounds_reach_the_scan(spark):
    plan = plan_of(catalog.QUERIES["filter_by_date"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan
    assert "LessThan(ts,2024-01-21T00:00)" in plan


def test_scan_reads_only_the_needed_columns(spark):
    plan = plan_of(catalog.QUERIES["trading_days"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_positions_of_a_panel_are_not_shuffled_for_todays_price(spark):
    plan = plan_of(catalog.QUERIES["entry_vs_today"](spark, SF))
    assert plan.count("Exchange hashpartitioning") <= 4, "three panels and one for entry_day"


def passes(spark, name) -> int:
    """Scans of the ticks while a query is built and run, from the plans."""
    spark.sparkContext._jvm.System.gc()
    path, scans = f"{SF}/events.parquet", []
    original = type(spark.read).parquet

    def counted(reader, *paths, **options):
        scans.extend(p for p in paths if p == path)
        return original(reader, *paths, **options)
    type(spark.read).parquet = counted
    try:
        catalog.QUERIES[name](spark, SF).count()
    finally:
        type(spark.read).parquet = original
    return len(scans)


@pytest.mark.parametrize("name", ["portfolio_value", "sell_proceeds", "tradable_candidates", "pick_replacement_whole_market",
                                  "pick_replacement", "rebalance_step", "buy_and_hold", "buy_units", "held_prices",
                                  "scenario_backtest_sampled_universe", "initial_allocation", "price_lookup"])
def test_ticks_are_read_twice_at_most(spark, name):
    assert passes(spark, name) <= 2


def test_broadcasts_need_a_bound(spark):
    """Under a proven bound the small side is broadcast; without one the planner
    decides, and with its own threshold off it shuffles."""
    holdings = spark.createDataFrame([(1, "A")], "sim long, ticker string")
    day_prices = spark.range(10).select(F.col("id").cast("string").alias("ticker"), F.lit(1.0).alias("price"))
    lines = spark.createDataFrame([("p", "l")], "path string, line string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bounded, open_ in (
                (panel.held_prices(day_prices, holdings, max_holdings=1), panel.held_prices(day_prices, holdings)),
                (session.lookup(holdings, day_prices, "ticker", max_table=10), session.lookup(holdings, day_prices, "ticker")),
                (session.lookup(holdings, day_prices, "ticker", max_rows=1),
                 session.lookup(holdings, day_prices, "ticker", max_rows=session.BROADCAST_ROWS + 1)),
                (vendor.without_rejected(lines, vendor.rejected_files(lines), max_rejected=0),
                 vendor.without_rejected(lines, vendor.rejected_files(lines)))):
            assert "BroadcastHashJoin" in plan_of(bounded) and "BroadcastHashJoin" not in plan_of(open_)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sample_is_a_top_n(spark):
    assert "TakeOrderedAndProject" in plan_of(catalog.QUERIES["sample_tickers"](spark, SF))


def test_year_partitions_are_pruned(spark, tmp_path):
    from daypanel.sources import prices as price_source, writers
    writers.write_prices(catalog.load_prices(spark, SF), str(tmp_path / "p"))
    one_day = plan_of(panel.prices_on_day(price_source.read_prices(spark, str(tmp_path / "p")), "2024-01-05"))
    assert "PushedFilters: [IsNotNull(day), EqualTo(day,2024-01-05)]" in one_day
    assert "PartitionFilters: [isnotnull(year" in one_day


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
