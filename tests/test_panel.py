"""Cuts, lookups, duplicates, allocation and valuation on hand-made panels."""

import random

import pytest
from pyspark.sql import functions as F

from price_frames import day, holding_frame, price_frame, ticker_frame
from daypanel.operators import allocation, panel, trading
from daypanel.plans.buy_and_hold import buy_and_hold


def test_date_bounds_are_inclusive(spark):
    prices = price_frame(spark, [("A", d, 1) for d in range(1, 6)])
    kept = panel.filter_by_date(prices, day(2), day(4))
    assert sorted(r.day for r in kept.collect()) == [day(2), day(3), day(4)]


def test_calendar_skips_days_without_trading(spark):
    prices = price_frame(spark, [("A", 5, 1), ("B", 1, 1), ("A", 1, 1)])
    assert [r.day for r in panel.trading_days(prices).collect()] == [day(1), day(5)]
    assert {r.day: r.day_idx for r in panel.day_index(prices).collect()} == {day(1): 0, day(5): 1}


def test_duplicate_keys_keep_first_or_last(spark):
    rows = spark.createDataFrame(
        [("A", day(1), 1.0, 10), ("A", day(1), 2.0, 30), ("A", day(1), 3.0, 20)],
        "ticker string, day date, price double, line long")
    assert panel.dedupe_keep_last(rows, "line").first().price == 2.0
    assert panel.dedupe_keep_first(rows, "line").first().price == 1.0


def test_lookup_reports_missing_prices(spark):
    prices = price_frame(spark, [("A", 1, 4)])
    asked = spark.createDataFrame([("A", day(1)), ("A", day(2)), ("B", day(1))],
                                  "ticker string, day date")
    found = {(r.ticker, r.day): (r.price, r.found)
             for r in panel.price_lookup(asked, prices).collect()}
    assert found == {("A", day(1)): (4.0, True), ("A", day(2)): (0.0, False),
                     ("B", day(1)): (0.0, False)}


def test_missing_opening_price_loses_its_share(spark):
    prices = price_frame(spark, [("A", 1, 10), ("B", 2, 10), ("C", 1, 0)])
    chosen = ticker_frame(spark, ["A", "B", "C", "D"])
    lots = allocation.initial_allocation(prices, chosen, n_sims=2, money=100).collect()
    assert sorted((r.sim, r.ticker, r.units) for r in lots) == [(1, "A", 2.5), (2, "A", 2.5)]


def test_many_scenarios_are_repeated_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(allocation, "SIMS_PER_BLOCK", 7)
    rows = allocation.for_each_sim(ticker_frame(spark, ["A", "B"]), 30)
    assert rows.columns == ["sim", "ticker"]
    assert sorted((r.sim, r.ticker) for r in rows.collect()) == [
        (s, t) for s in range(1, 31) for t in "AB"]
    assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_sample_has_exact_size_and_no_repeats(spark):
    universe = ticker_frame(spark, [f"T{i}" for i in range(100)])
    picks = [r.ticker for r in allocation.sample_tickers(universe, 10, seed=3).collect()]
    again = [r.ticker for r in
             allocation.sample_tickers(universe.repartition(7), 10, seed=3).collect()]
    other = [r.ticker for r in allocation.sample_tickers(universe, 10, seed=4).collect()]
    assert len(set(picks)) == 10 and picks == again and picks != other
    assert allocation.sample_tickers(universe, 500, seed=3).count() == 100


def test_untraded_holding_counts_as_zero(spark):
    prices = price_frame(spark, [("A", 1, 10), ("B", 1, 5), ("A", 2, 11), ("Z", 3, 1)])
    holdings = holding_frame(spark, [(1, "A", 1, 10, 2), (1, "B", 1, 5, 4)])
    totals = panel.portfolio_value(holdings, prices, panel.trading_days(prices), n_sims=2)
    assert {(r.sim, r.day): r.total for r in totals.collect()} == {
        (1, day(1)): 40.0, (1, day(2)): 22.0, (1, day(3)): 0.0,
        (2, day(1)): 0.0, (2, day(2)): 0.0, (2, day(3)): 0.0}


def test_merged_lots_take_the_latest_entry(spark):
    lots = holding_frame(spark, [(1, "A", 1, 10, 2), (1, "A", 4, 12, 3), (2, "A", 1, 10, 1)])
    merged = {(r.sim, r.ticker): (r.entry_day, r.entry_price, r.units)
              for r in allocation.merge_lots(lots).collect()}
    assert merged == {(1, "A"): (day(4), 12.0, 5.0), (2, "A"): (day(1), 10.0, 1.0)}


def test_selling_what_is_not_held_fails(spark):
    holdings = holding_frame(spark, [(1, "A", 1, 10, 2)])
    sales = spark.createDataFrame([(1, "B")], "sim long, ticker string")
    with pytest.raises(Exception, match="not held"):
        trading.sell_proceeds(sales, holdings, price_frame(spark, [("B", 1, 1)])).collect()


def test_held_prices_and_snapshot(spark):
    prices = price_frame(spark, [("A", 1, 10), ("B", 1, 5), ("A", 2, 11)])
    holdings = holding_frame(spark, [(1, "A", 1, 10, 2), (2, "A", 1, 10, 3), (1, "C", 1, 1, 1)])
    today = panel.prices_on_day(prices, day(1))
    assert [r.ticker for r in panel.held_prices(today, holdings).collect()] == ["A"]
    rows = panel.holdings_snapshot(holdings, prices).collect()
    assert sorted((r.sim, r.day, r.ticker, r.price, r.units) for r in rows) == [
        (1, day(1), "A", 10.0, 2.0), (1, day(2), "A", 11.0, 2.0),
        (2, day(1), "A", 10.0, 3.0), (2, day(2), "A", 11.0, 3.0)]
    dated = holdings.withColumn("day", F.lit(day(2)))
    assert panel.holdings_snapshot(dated, prices).count() == 2


def test_buy_and_hold_waits_for_the_first_traded_day(spark):
    prices = price_frame(spark, [("Z", 1, 9), ("A", 2, 10), ("A", 4, 12), ("B", 3, 5)])
    rows = buy_and_hold(prices, ticker_frame(spark, ["A", "B"]), n_sims=1, money=100).collect()
    assert sorted((r.day, r.ticker, r.price, r.units) for r in rows) == [
        (day(2), "A", 10.0, 5.0), (day(4), "A", 12.0, 5.0)]


def test_candidates_fall_back_to_the_whole_universe(spark):
    universe = ticker_frame(spark, ["A", "B", "C"])
    today = price_frame(spark, [("A", 1, 1), ("B", 1, 2), ("X", 1, 3)])
    some = holding_frame(spark, [(1, "A", 1, 1, 1)])
    every = holding_frame(spark, [(1, t, 1, 1, 1) for t in "ABC"])

    def names(portfolio):
        rows = trading.tradable_candidates(universe, portfolio, today).collect()
        return sorted(r.ticker for r in rows)
    assert sorted(r.ticker for r in trading.unowned_tickers(universe, some).collect()) == ["B", "C"]
    assert names(some) == ["B"]
    assert names(every) == ["A", "B"]
    no_b_today = today.where("ticker != 'B'")
    assert trading.tradable_candidates(universe, some, no_b_today).count() == 0, \
        "unowned but untraded tickers do not open the fallback"


@pytest.mark.parametrize("shelf", (1, 3, 64))
def test_prices_are_carried_across_gaps(spark, monkeypatch, shelf):
    monkeypatch.setattr(panel, "DAYS_PER_SHELF", shelf)
    rng = random.Random(shelf)
    cells = [(t, d, rng.choice([0, 5, 6.5, 7])) for t in "ABCDE" for d in range(1, 24) if rng.random() < 0.3]
    cells += [("ALL", d, 1) for d in range(1, 24)] + [("LATE", 23, 2), ("EARLY", 1, 3), ("NEVER", 4, -1)]
    prices = price_frame(spark, cells)
    known = {(t, d): p for t, d, p in cells if p > 0}
    want = {}
    for t in {t for t, _ in known}:
        last = None
        for d in range(1, 24):
            last = d if (t, d) in known else last
            if last:
                want[t, day(d)] = (known[t, last], day(last))
    carried = panel.carried_prices(prices, panel.day_index(prices))
    assert {(r.ticker, r.day): (r.price, r.quoted_day) for r in carried.collect()} == want and carried.count() == len(want)
    holdings = holding_frame(spark, [(1, "A", 1, 5, 2), (1, "LATE", 1, 5, 1), (2, "EARLY", 1, 3, 4), (3, "NEVER", 1, 1, 1)])
    totals = panel.portfolio_value_carried(holdings, prices, panel.day_index(prices), n_sims=3)
    of = lambda t, d: want.get((t, day(d)), (0.0,))[0]
    assert {(r.sim, r.day.day): r.total for r in totals.collect()} == {
        **{(1, d): 2 * of("A", d) + of("LATE", d) for d in range(1, 24)}, **{(2, d): 12.0 for d in range(1, 24)},
        **{(3, d): 0.0 for d in range(1, 24)}}


def test_carried_prices_of_nothing(spark):
    prices = price_frame(spark, [])
    assert panel.carried_prices(prices, panel.day_index(prices)).count() == 0
    calendar = panel.day_index(price_frame(spark, [("A", 1, 1)]))
    assert panel.carried_prices(price_frame(spark, [("A", 2, 5)]), calendar).count() == 0
