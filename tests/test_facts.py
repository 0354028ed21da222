"""The asserted facts of the buy, sell and signal rules, and of ticker names."""

from pyspark.sql import functions as F

from price_frames import day, holding_frame, price_frame
from daypanel.functions import text
from daypanel.functions.policy import Policy
from daypanel.operators import panel, trading


def test_sale_gives_price_times_units(spark):
    holdings = holding_frame(spark, [(1, "TICKER", 1, 10, 50)])
    prices = price_frame(spark, [("TICKER", 2, 10)])
    sold = trading.sell_proceeds(holdings.select("sim", "ticker"), holdings, prices)
    assert sold.first().proceeds == 500.0


def test_purchase_adds_to_what_is_held(spark):
    holdings = holding_frame(spark, [(1, "TICKER", 1, 10, 50)])
    prices = price_frame(spark, [("TICKER", 2, 10)])
    orders = spark.createDataFrame([(1, "TICKER", 500.0), (2, "TICKER", 500.0), (2, "GONE", 500.0)],
                                   "sim long, ticker string, money double")
    units = {(r.sim, r.ticker): r.units
             for r in trading.buy_units(orders, holdings, prices).collect()}
    assert units == {(1, "TICKER"): 100.0, (2, "TICKER"): 50.0, (2, "GONE"): 0.0}


def signals(spark, policy):
    prices = price_frame(spark, [("TICKER", 1, 10), ("TICKER", 3, 10)])
    positions = spark.createDataFrame([("TICKER", day(1), day(3)), ("TICKER", day(1), day(2))],
                                      "ticker string, entry_day date, day date")
    looked_up = panel.entry_vs_today(positions, prices)
    both = trading.gain_plateau_signal(trading.stop_loss_signal(looked_up, policy), policy)
    return {r.day: (r.stop_loss, r.plateau) for r in both.collect()}


def test_signals_as_computed(spark):
    found = signals(spark, Policy(stop_loss_delta=10, plateau_delta=10))
    assert found[day(3)] == (True, False)
    assert found[day(2)] == (False, False), "no price that day: no signal"


def test_signals_as_documented(spark):
    found = signals(spark, Policy(stop_loss_delta=10, plateau_delta=10, mode="documented"))
    assert found[day(3)] == (False, True)


def test_ticker_of_a_line(spark):
    line = spark.createDataFrame([("CSCO,2019-11-01,47.0300,24404100",)], "line string")
    assert line.select(text.field(F.col("line"), 0)).first()[0] == "CSCO"
    quoted = spark.createDataFrame([(' "AAPL" ',), ("MSFT",), ('""X""',)], "name string")
    assert [r[0] for r in quoted.select(text.unquoted(F.col("name"))).collect()] == [
        "AAPL", "MSFT", '"X"']
