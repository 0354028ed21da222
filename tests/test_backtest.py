"""Scenarios against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from price_frames import day, holding_frame, price_frame, ticker_frame
from daypanel.functions.policy import Policy
from daypanel.operators import allocation, panel, ranking, trading
from daypanel.plans import backtest
from daypanel import session


def random_panel(seed, tickers=14, days=6, filled=0.75):
    rng = random.Random(seed)
    cells = []
    for t in range(tickers):
        base = rng.uniform(20, 80)
        for d in range(1, days + 1):
            if rng.random() < filled:
                price = 0.0 if rng.random() < 0.03 else round(base + rng.uniform(-4, 4), 3)
                cells.append((f"T{t}", d, price))
    return cells


def as_prices(cells):
    return {(t, day(d)): p for t, d, p in cells}


def totals_of(spark, prices, moves, n_sims):
    totals = backtest.scenario_totals(moves, panel.day_index(prices), n_sims)
    return {(r.sim, r.day): r.total for r in totals.collect()}


def check(spark, cells, chosen, *, n_sims, seed, mode, universe, in_order=False, days_per_plan=4):
    prices = price_frame(spark, cells)
    spec = backtest.Scenarios(
        n_sims=n_sims, money=100.0, seed=seed, policy=Policy(mode=mode), in_order=in_order, days_per_plan=days_per_plan,
        universe=None if universe is None else ticker_frame(spark, universe))
    moves = backtest.backtest_moves(prices, ticker_frame(spark, chosen), spec)
    want_totals, want_units = brute.run(as_prices(cells), chosen, n_sims=n_sims, money=100.0,
                                        seed=seed, mode=mode, universe=universe,
                                        in_order=in_order)
    assert totals_of(spark, prices, moves, n_sims) == pytest.approx(want_totals)
    after = allocation.merge_lots(trading.lots_after(moves).withColumn(
        "sim", F.col("sim") * 1000 + F.col("day_idx")))
    days = sorted({d for _, d in as_prices(cells)})
    units = {(r.sim // 1000, days[r.sim % 1000], r.ticker): r.units for r in after.collect()}
    assert units == pytest.approx(want_units)
    return moves


@pytest.mark.parametrize("mode", ("code", "documented"))
@pytest.mark.parametrize("universe", ("all", "chosen", "part"))
def test_scenarios_match_plain_loops(spark, mode, universe):
    cells = random_panel(5)
    chosen = ["T0", "T3", "T4", "T9", "T11"]
    allowed = {"all": None, "chosen": chosen, "part": ["T1", "T3", "T5", "T6", "NOWHERE"]}[universe]
    check(spark, cells, chosen, n_sims=6, seed=11, mode=mode, universe=allowed)


@pytest.mark.parametrize("mode", ("code", "documented"))
@pytest.mark.parametrize("filled", (0.8, 1.1))
def test_sales_in_order_match_plain_loops(spark, mode, filled):
    """The universe is what is owned, so draws hit tickers sold the same day."""
    cells = random_panel(21, tickers=9, days=6, filled=filled)
    chosen = [f"T{i}" for i in range(7)]
    check(spark, cells, chosen, n_sims=8, seed=3, mode=mode, universe=chosen, in_order=True)


def test_sales_in_order_for_scenarios_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(ranking, "CHAIN_IN_ROW", 0)
    chosen = [f"T{i}" for i in range(7)]
    check(spark, random_panel(21, tickers=9, days=5), chosen, n_sims=8, seed=3, mode="code",
          universe=chosen, in_order=True)


def test_shared_folder_is_asked_for_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.run_folder(Session(), "x")
    Session.conf.get = staticmethod(lambda key, default: "hdfs://shared/")
    assert session.run_folder(Session(), "x").startswith("hdfs://shared/x-")


def test_shuffled_lookups_give_the_same(spark, monkeypatch):
    """Neither side may be broadcast: the path for states beyond the bound."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    check(spark, random_panel(6), ["T0", "T3", "T4", "T9"], n_sims=4, seed=2, mode="documented",
          universe=None)


def test_large_quotes_are_cut_down_in_place(spark, monkeypatch):
    """Only the state may be broadcast, the day's quotes may not."""
    cells = random_panel(7, tickers=20, days=4)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 9)
    check(spark, cells, ["T0", "T3", "T4"], n_sims=3, seed=2, mode="code",
          universe=None)


def test_prices_of_the_universe_and_the_whole_calendar(spark):
    """Day 1 and day 4 trade only outside of the universe."""
    cells = [("Z", d, 5) for d in range(1, 7)] + [
        (t, d, 10 + d * i) for i, t in enumerate("ABC") for d in (2, 3, 5, 6)] + [("A", 1, 9)]
    prices, chosen = price_frame(spark, cells), ticker_frame(spark, list("ABC"))
    spec = backtest.Scenarios(n_sims=3, seed=1, universe=chosen)
    found = []
    for panel_rows, days in ((prices, None), (prices.where("ticker <> 'Z'"), prices)):
        moves = backtest.backtest_moves(panel_rows, chosen, spec, calendar=days)
        found.append(sorted((r.sim, r.day_idx, r.ticker, r.new_ticker, r.new_units)
                            for r in moves.collect()))
    assert found[0] == found[1] and {r[1] for r in found[0]} == {1, 2, 3, 4, 5}


def test_one_trading_day_gives_nothing(spark):
    prices = price_frame(spark, [("A", 1, 10)])
    result = backtest.scenario_backtest(prices, ticker_frame(spark, ["A"]),
                                        backtest.Scenarios(n_sims=3))
    assert result.count() == 0


def test_nothing_bought_still_reports_zero(spark):
    prices = price_frame(spark, [("A", 1, 10), ("A", 2, 10), ("B", 2, 1)])
    result = backtest.scenario_backtest(prices, ticker_frame(spark, ["B"]),
                                        backtest.Scenarios(n_sims=2))
    assert [(r.sim, r.day, r.total) for r in result.orderBy("sim").collect()] == [
        (1, day(2), 0.0), (2, day(2), 0.0)]


def test_position_stays_when_nothing_can_be_bought(spark):
    # B and C are not owned, so the pool is not empty, but they do not trade.
    cells = [("A", 1, 10), ("A", 2, 10), ("B", 1, 3), ("C", 1, 0), ("C", 2, 0)]
    moves = check(spark, cells, ["A"], n_sims=2, seed=0, mode="code", universe=None)
    assert {(r.ticker, r.new_ticker, r.reason) for r in moves.collect()} == {("A", "A", None)}


def test_two_sales_may_share_one_replacement(spark):
    cells = [(t, d, 10) for t in "AB" for d in (1, 2)] + [("C", 1, 5), ("C", 2, 5)]
    prices = price_frame(spark, cells)
    holdings = holding_frame(spark, [(1, "A", 1, 10, 1), (1, "B", 1, 10, 2)])
    after = trading.rebalance_step(holdings, prices, day=day(2), day_idx=1, seed=0).collect()
    assert [(r.ticker, r.entry_day, r.entry_price, r.units) for r in after] == [
        ("C", day(2), 5.0, 6.0)]


def test_trades_keep_the_value_when_everything_trades(spark):
    cells = random_panel(9, tickers=12, days=5, filled=1.1)
    cells = [(t, d, p or 30.0) for t, d, p in cells]
    prices = price_frame(spark, cells)
    moves = backtest.backtest_moves(prices, ticker_frame(spark, ["T1", "T2", "T3"]),
                                    backtest.Scenarios(n_sims=4, seed=3))
    worst = moves.groupBy("sim", "day").agg(
        F.abs(F.sum(F.col("units") * F.col("price")) -
              F.sum(F.col("new_units") * F.col("new_price"))).alias("gap")).agg(F.max("gap"))
    assert worst.first()[0] < 1e-9


def test_result_does_not_depend_on_partitioning(spark):
    cells = random_panel(10)
    chosen = ["T0", "T3", "T4", "T9", "T11"]
    seen = []
    for parts in ("3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        shuffled = random.Random(int(parts)).sample(cells, len(cells))
        prices = price_frame(spark, shuffled).repartition(int(parts))
        moves = backtest.backtest_moves(prices, ticker_frame(spark, chosen),
                                        backtest.Scenarios(n_sims=3, seed=5))
        seen.append({k: round(v, 9) for k, v in totals_of(spark, prices, moves, 3).items()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1]


def test_holdings_never_exceed_the_chosen_number_and_code_mode_never_says_plateau(spark):
    prices = price_frame(spark, random_panel(12, tickers=25))
    moves = backtest.backtest_moves(prices, ticker_frame(spark, ["T1", "T2", "T3", "T4"]),
                                    backtest.Scenarios(n_sims=8, seed=3))
    held = moves.groupBy("sim", "day").agg(F.count_distinct("new_ticker").alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 4
    assert moves.where("reason = 'PLATEAU'").count() == 0
    assert moves.where("reason = 'STOP_LOSS'").count() > 0


class TakeProfit(Policy):
    def signals(self, entry, today):
        return [("PROFIT", today > entry * 1.02)]


def test_own_rule(spark):
    prices = price_frame(spark, random_panel(13))
    spec = backtest.Scenarios(n_sims=3, seed=3, policy=TakeProfit())
    moves = backtest.backtest_moves(prices, ticker_frame(spark, ["T1", "T2", "T3", "T4"]), spec)
    assert {r.reason for r in moves.select("reason").distinct().collect()} == {None, "PROFIT"}


def test_ledger_pairs_sales_and_purchases(spark):
    prices = price_frame(spark, random_panel(14))
    moves = backtest.backtest_moves(prices, ticker_frame(spark, ["T1", "T2", "T3", "T4"]),
                                    backtest.Scenarios(n_sims=3, seed=3))
    ledger = backtest.trade_ledger(moves)
    sold = moves.where("reason is not null").count()
    assert {r.side: r.n for r in ledger.groupBy("side").agg(F.count("*").alias("n")).collect()} == {
        "SELL": sold, "BUY": sold}
    off = ledger.where(F.abs(F.col("units") * F.col("price") - F.col("money")) > 1e-9)
    assert off.count() == 0


def test_ranks_and_picks_match_plain_loops(spark):
    rng = random.Random(4)
    names = [f"T{i}" for i in range(60)]
    cells = [(t, 1, rng.choice([0, 5, 6])) for t in names if rng.random() < 0.8]
    prices = price_frame(spark, cells)
    universe = rng.sample(names, 25)
    quotes = ranking.ranked_prices(prices, ticker_frame(spark, universe)).collect()
    usable = {t for t, _, p in cells if p > 0}
    order = sorted(usable & set(universe), key=brute.key)
    assert {r.ticker: r.rank for r in quotes} == {
        t: (order.index(t) if t in order else None) for t in usable}
    assert {r.n_traded for r in quotes} == {len(order)}

    # Scenario 9 owns the whole universe: it may draw any ticker that trades.
    owned = {sim: rng.sample(universe, rng.randint(1, 20)) for sim in range(1, 9)}
    owned[9] = universe
    holdings = holding_frame(spark, [(s, t, 1, 5, 1) for s, ts in owned.items() for t in ts])
    sales = [(s, t) for s, ts in owned.items() for t in ts]
    picks = trading.pick_replacement(
        spark.createDataFrame(sales, "sim long, ticker string"), holdings, prices, day=day(1),
        day_idx=3, seed=8, universe=ticker_frame(spark, universe)).collect()
    assert {(r.sim, r.ticker): r.replacement for r in picks} == {
        (s, t): brute.choose(8, s, 3, t, owned[s], universe, usable) for s, t in sales}


def test_a_hot_ticker_and_a_hot_day(spark):
    """A third of all ticks on one ticker, a third of all quotes on one day."""
    from daypanel.sources.prices import prices_from_events
    ticks = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("user_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("ts"),
        (F.col("id") % 97).cast("double").alias("value"))
    prices = prices_from_events(ticks)
    local = ticks.toPandas()
    last = local.sort_values("ts").groupby("user_id").value.last()
    assert {r.ticker: r.price for r in prices.collect()} == {
        f"U{u}": 50.0 + v / 10 for u, v in last.items()}
    ranks = ranking.ranked_prices(prices).select("ticker", "rank").collect()
    order = sorted((r.ticker for r in ranks), key=brute.key)
    assert {r.ticker: r.rank for r in ranks} == {t: i for i, t in enumerate(order)}


def test_two_prices_for_a_key_are_an_error(spark):
    cells = [(t, d, 10 + d) for t in "ABCD" for d in (1, 2, 3)] + [("B", 2, 99)]
    prices, chosen = price_frame(spark, cells), ticker_frame(spark, ["A"])
    with pytest.raises(ValueError, match="B has more than one usable price on 2018-03-02"):
        backtest.backtest_moves(prices, chosen, backtest.Scenarios(n_sims=1))
    one = panel.dedupe_keep_first(prices, "price")
    moves = backtest.backtest_moves(one, chosen, backtest.Scenarios(n_sims=1))
    want, _ = brute.run(as_prices(cells[:-1]), ["A"], n_sims=1, money=1000.0, seed=0)
    assert totals_of(spark, one, moves, 1) == pytest.approx(want)


def test_what_is_no_price_is_no_quote(spark):
    """NaN, infinite, negative and NULL prices, and rows without a key."""
    cells = random_panel(17, tickers=8, days=4)
    odd = [("T1", 2, "NaN"), ("T2", 2, "-5"), ("T3", 3, "Infinity"), ("T4", 3, None), (None, 2, "5"), ("T5", None, "7"),
           ("T6", 9, "NaN")]
    kept = [c for c in cells if (c[0], c[1]) not in {(t, d) for t, d, _ in odd}]
    rows = price_frame(spark, kept).unionByName(spark.createDataFrame(
        [(t, day(d) if d else None, float(p) if p else None, 1) for t, d, p in odd],
        "ticker string, day date, price double, volume long"))
    chosen = ["T1", "T2", "T3", "T4"]
    spec = backtest.Scenarios(n_sims=4, money=100.0, seed=2)
    moves = backtest.backtest_moves(rows, ticker_frame(spark, chosen), spec)
    # Day 9 has a row, so it is a trading day on which nothing has a price.
    want, _ = brute.run(as_prices(kept) | {("T6", day(9)): 0.0}, chosen, n_sims=4, money=100.0, seed=2)
    assert totals_of(spark, rows.where("day is not null"), moves, 4) == pytest.approx(want)


def test_large_scenarios_spread_by_ticker(spark, monkeypatch):
    """Beyond one shelf nothing is partitioned by scenario, and results stay."""
    monkeypatch.setattr(ranking, "LOTS_PER_SHELF", 2)
    check(spark, random_panel(23, tickers=10, days=4), ["T0", "T3", "T4", "T9"], n_sims=3, seed=4, mode="code",
          universe=None)


def test_one_scenario_of_many_lots_is_many_tasks(spark):
    """200,000 lots of one scenario: no task of a step holds more than a part."""
    quotes = spark.range(200_000).select(F.concat(F.lit("T"), "id").alias("ticker"), (F.col("id") % 50 + 10.0).alias("price"))
    lots = quotes.select(F.lit(1).cast("long").alias("sim"), "ticker", F.lit(day(1)).alias("entry_day"),
                         F.lit(20.0).alias("entry_price"), F.lit(1.0).alias("units"))
    ranked = ranking.ranked_prices(quotes.withColumn("day", F.lit(day(2))))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        moves = trading.rebalance_moves(lots, ranked, day=day(2), day_idx=1, seed=1, n_universe=F.lit(200_000))
        after = allocation.merge_lots(trading.lots_after(moves))
        sizes = [r.n for r in after.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(sizes) >= 12 and max(sizes) < 40_000


def test_the_run_leaves_no_files(spark, tmp_path, monkeypatch):
    prices = price_frame(spark, random_panel(3, tickers=4, days=4, filled=1.1))
    monkeypatch.setattr(session, "run_folder", lambda _, label: str(tmp_path / label))
    moves = backtest.backtest_moves(prices, ticker_frame(spark, ["T1"]), backtest.Scenarios(n_sims=2))
    assert not (tmp_path / "backtest").exists() and moves.count() == 6


@pytest.mark.parametrize("days_per_plan, in_order", ((1, False), (3, False), (30, False), (3, True)))
def test_blocks_of_days_match_plain_loops(spark, days_per_plan, in_order):
    chosen = [f"T{i}" for i in range(5)]
    check(spark, random_panel(31, tickers=7, days=8), chosen, n_sims=5, seed=3, mode="code",
          universe=chosen if in_order else None, in_order=in_order, days_per_plan=days_per_plan)


def test_many_scenarios_in_blocks_are_shuffled_once(spark, monkeypatch):
    """Above a shelf a block's rows are dealt by scenario, and no step deals again."""
    cells, chosen = random_panel(32, tickers=10, days=5), ["T0", "T3", "T4", "T9"]
    monkeypatch.setattr(ranking, "LOTS_PER_SHELF", 8)
    check(spark, cells, chosen, n_sims=4, seed=4, mode="code", universe=None)
    rows = spark.range(40).selectExpr(
        "id % 8 sim", "concat('T', id) ticker", "0L entry_day", "5.0D entry_price", "1.0D units", "1L now").repartition("sim")
    quotes = spark.range(300).selectExpr("id % 3 + 1 day_idx", "concat('T', id div 3) ticker", "6.0D price", "id div 3 rank", "100L n_traded")
    step = {"seed": 1, "n_universe": F.lit(100), "policy": Policy(), "max_lots": 5, "max_holdings": 40, "max_quotes": 300}
    moves = backtest._unrolled(rows, quotes, 3, **step)
    plan = moves._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and moves.count() == 120


def test_a_block_of_days_is_one_write(spark, monkeypatch):
    prices, chosen = price_frame(spark, random_panel(33, days=13, filled=1.1)), ticker_frame(spark, ["T1", "T2", "T3"])
    writes = []
    writer = type(prices.write)
    original = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, path, **more: (writes.append(path), original(self, path, **more))[1])
    moves = backtest.backtest_moves(prices, chosen, backtest.Scenarios(n_sims=3, seed=1, days_per_plan=5))
    assert [w.rsplit("/", 1)[1] for w in writes if "/moves/" in w] == ["000001-000005", "000006-000010", "000011-000012"]
    assert moves.select("sim", "day_idx").distinct().count() == 3 * 12


class Lost(Exception):
    pass


def rows_of(moves):
    return sorted((r.sim, r.day_idx, r.ticker, r.new_ticker, round(r.new_units, 9), r.new_entry_day) for r in moves.collect())


@pytest.mark.parametrize("days_per_plan", (1, 3))
def test_a_lost_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, days_per_plan):
    cells, names = random_panel(34, days=9), ["T1", "T2", "T3", "T5"]
    prices, chosen = price_frame(spark, cells), ticker_frame(spark, names)
    spec, folder = backtest.Scenarios(n_sims=3, seed=6, days_per_plan=days_per_plan), str(tmp_path / "run")
    want = rows_of(backtest.backtest_moves(prices, chosen, spec))
    step, done = trading.DayStep.__call__, []

    def steps_until(n):
        def counted(self, start):
            if len(done) == n:
                raise Lost
            done.append(1)
            return step(self, start)
        return counted

    monkeypatch.setattr(trading.DayStep, "__call__", steps_until(5))
    with pytest.raises(Lost):
        backtest.backtest_moves(prices, chosen, spec, folder=folder)
    (tmp_path / "run" / "moves" / "000006-000006").mkdir(parents=True, exist_ok=True)  # begun, not finished
    n_finished = 5 // days_per_plan * days_per_plan
    done.clear()
    monkeypatch.setattr(trading.DayStep, "__call__", steps_until(99))
    assert rows_of(backtest.backtest_moves(prices, chosen, spec, folder=folder)) == want
    assert len(done) == 8 - n_finished
    done.clear()
    assert rows_of(backtest.backtest_moves(prices, chosen, spec, folder=folder)) == want and not done


def test_a_folder_of_another_run_is_an_error(spark, tmp_path):
    cells = random_panel(35, tickers=5, days=3, filled=1.1)
    prices, chosen, folder = price_frame(spark, cells), ticker_frame(spark, ["T1", "T2"]), str(tmp_path / "run")
    spec = backtest.Scenarios(n_sims=2, seed=1)
    want = rows_of(backtest.backtest_moves(prices, chosen, spec, folder=folder))
    for other in (backtest.Scenarios(n_sims=2, seed=2), backtest.Scenarios(n_sims=2, seed=1, policy=TakeProfit())):
        with pytest.raises(ValueError, match="another run"):
            backtest.backtest_moves(prices, chosen, other, folder=folder)
    with pytest.raises(ValueError, match="another run"):
        backtest.backtest_moves(price_frame(spark, [*cells, ("NEW", 2, 4)]), chosen, spec, folder=folder)
    assert rows_of(backtest.backtest_moves(prices.repartition(3), chosen, spec, folder=folder)) == want


def test_totals_with_carried_prices(spark):
    cells = [("A", 1, 10), ("A", 2, 10), ("B", 1, 3), ("B", 3, 3)]
    prices, chosen = price_frame(spark, cells), ticker_frame(spark, ["A"])
    spec = backtest.Scenarios(n_sims=1, money=100.0, universe=chosen, policy=Policy(mode="documented", plateau_delta=-1))
    moves, calendar = backtest.backtest_moves(prices, chosen, spec), panel.day_index(prices)
    plain = backtest.scenario_totals(moves, calendar, 1)
    assert {r.day: r.total for r in plain.collect()} == {day(2): 100.0, day(3): 0.0}
    carried = backtest.scenario_totals(moves, calendar, 1, panel.carried_prices(prices, calendar))
    assert {r.day: r.total for r in carried.collect()} == {day(2): 100.0, day(3): 100.0}
