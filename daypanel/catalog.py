"""Registered queries: each operator applied to the given tables.

The panel is built from `events` (ticker = user, day = date of the tick, price
from the day's last value). Queries on one holdings state use the opening
purchase of ten seeded tickers; where an operator works on rows of any kind it
runs over the whole panel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from daypanel import schema
from daypanel.functions import text
from daypanel.functions.policy import Policy
from daypanel.operators import allocation, panel, trading
from daypanel.plans import backtest, buy_and_hold as holding, report
from daypanel.session import durable, remove_folder, run_folder
from daypanel.sources import prices as price_source, snapshots, tickers as ticker_source, vendor, writers

# Fixed values shared with the SQL statements.
SEED = 7
N_SIMS = 30
N_TICKERS = 10
MONEY = 1000.0
ASKED_DAY = dt.date(2024, 1, 11)
LATER_DAY_IDX = 10
CUT_DAY = dt.date(2024, 1, 15)
CUT_RANGE = (dt.date(2024, 1, 5), dt.date(2024, 1, 20))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_source.prices_from_events(table(spark, sf_dir, "events"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per (ticker, day): the table before it is deduplicated."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        F.to_date("ts").alias("day"), F.col("value").alias("price"), "ts")


def stored_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel, worked out in one pass over the ticks and stored. Queries that
    need it for more than one thing (calendar, list, sample, prices) derive all
    of them from here; a panel row stands for a day's ticks of a ticker."""
    return durable(load_prices(spark, sf_dir))


def load_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight from the ticks: their map-side distinct leaves little to shuffle."""
    return ticks(spark, sf_dir).select("ticker").distinct()


def tickers_of(prices: DataFrame) -> DataFrame:
    return prices.select("ticker").distinct()


def chosen_of(prices: DataFrame) -> DataFrame:
    return allocation.sample_tickers(tickers_of(prices), N_TICKERS, seed=SEED)


def later_day(prices: DataFrame):
    """A day some time after the first, and its index: one row per calendar day
    comes to the driver."""
    days = sorted(row.day for row in prices.select("day").distinct().collect())
    at = min(LATER_DAY_IDX, len(days) - 1)
    return (days[at], at) if days else (ASKED_DAY, 0)


def opening_day(prices: DataFrame) -> Column:
    return prices.agg(F.min("day")).scalar()


def n_tickers(prices: DataFrame) -> Column:
    return prices.agg(F.count_distinct("ticker")).scalar()


def opening_holdings(prices: DataFrame, n_sims: int = N_SIMS) -> DataFrame:
    return allocation.initial_allocation(prices, chosen_of(prices), n_sims=n_sims, money=MONEY,
                                         day=opening_day(prices))


def whole_market_lots(prices: DataFrame) -> DataFrame:
    """One scenario that opens with an equal share of every ticker."""
    return allocation.initial_allocation(prices, tickers_of(prices), n_sims=1, money=MONEY,
                                         day=opening_day(prices))


def week_old_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every panel row as a position entered seven days before."""
    return load_prices(spark, sf_dir).select(
        "ticker", F.date_sub("day", 7).alias("entry_day"), "day")


def rounded(*names: str) -> list[Column]:
    return [F.round(n, 4).alias(n) for n in names]


# -- sources and sinks --------------------------------------------------------

@query
def scan_prices(spark, sf_dir):
    return load_prices(spark, sf_dir)


def vendor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel written the way vendor files look: (path, line_no, line)."""
    prices = load_prices(spark, sf_dir)
    path = F.concat(F.lit("store/daily/"), F.col("ticker"), F.lit(".csv"))
    header = load_tickers(spark, sf_dir).select(
        path.alias("path"), F.lit(0).alias("line_no"),
        F.lit("timestamp,open,high,low,close,adjusted_close,volume,dividend_amount,"
              "split_coefficient").alias("line"))
    line_no = F.row_number().over(Window.partitionBy("ticker").orderBy("day"))
    body = prices.select(
        path.alias("path"), line_no.alias("line_no"),
        F.concat_ws(",", F.date_format("day", "yyyy-MM-dd"), F.lit("0"), F.lit("0"), F.lit("0"),
                    F.lit("0"), F.col("price").cast("string"), F.col("volume").cast("string"),
                    F.lit("0.0"), F.lit("1.0")).alias("line"))
    return header.unionByName(body)


@query
def ingest_vendor_files(spark, sf_dir):
    return vendor.to_prices(vendor.vendor_rows(vendor_lines(spark, sf_dir)))


def history_and_update(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A history folder and an update folder that overlap by one day."""
    prices = vendor.to_prices(vendor.vendor_rows(vendor_lines(spark, sf_dir)))
    cut = F.lit(CUT_DAY).cast("date")
    return prices.where(F.col("day") <= cut), prices.where(F.col("day") >= cut)


@query
def merge_prices(spark, sf_dir):
    return vendor.merge_prices(*history_and_update(spark, sf_dir))


@query
def merge_prices_deduplicated(spark, sf_dir):
    """The update, half a unit higher, wins on the day both have."""
    history, update = history_and_update(spark, sf_dir)
    merged = vendor.merge_prices(history, update.withColumn("price", F.col("price") + 0.5), order="part")
    return panel.dedupe_keep_last(merged, "part")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed answers: plain texts, and pages whose markup holds braces."""
    texts = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("source_key"),
        F.col("text").alias("payload"))
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("source_key"),
        F.col("html").alias("payload"))
    return texts.unionByName(pages)


@query
def valid_payloads(spark, sf_dir):
    return (vendor.valid_payloads(payloads(spark, sf_dir))
            .select("source_key", F.length("payload").cast("long").alias("n_chars")))


@query
def rejected_payloads(spark, sf_dir):
    return (vendor.rejected_payloads(payloads(spark, sf_dir))
            .select("source_key", F.length("payload").cast("long").alias("n_chars")))


@query
def accepted_files(spark, sf_dir):
    """Lines of the answers, read as files: a brace on one line rejects all
    lines of its file."""
    lines = payloads(spark, sf_dir).select(
        F.col("source_key").alias("path"), F.explode(F.split("payload", "\n")).alias("line"))
    accepted = vendor.without_rejected(lines, vendor.rejected_files(lines))
    return accepted.groupBy("path").agg(F.count("*").alias("n_lines"))


@query
def ticker_list(spark, sf_dir):
    tickers = load_tickers(spark, sf_dir)
    body = tickers.select(
        F.lit(1).alias("line_no"),
        F.concat(F.lit(' "'), F.col("ticker"), F.lit('" , "Company '), F.col("ticker"),
                 F.lit('"')).alias("line"))
    header = spark.range(1).select(F.lit(0).alias("line_no"), F.lit('"Symbol","Name"').alias("line"))
    return ticker_source.ticker_list(header.unionByName(body))


@query
def scalar_formats(spark, sf_dir):
    line = F.concat_ws(",", "ticker", F.date_format("day", "yyyy-MM-dd"),
                       F.col("volume").cast("string"))
    path = F.concat(F.lit("/in/box/"), F.col("ticker"), F.lit(".csv"))
    return load_prices(spark, sf_dir).select(
        line.alias("line"),
        text.field(line, 0).alias("first_field"),
        text.ticker_from_path(path).alias("from_path"),
        text.unquoted(F.concat(F.lit(' "'), F.col("ticker"), F.lit('" '))).alias("unquoted"),
        F.to_date(text.field(line, 1), "yyyy-MM-dd").alias("parsed_day"),
        text.slash_day(F.col("day")).alias("slash_day"),
        text.compact_day(F.col("day")).alias("compact_day"),
        text.is_csv_payload(line).alias("is_csv"))


# -- through files ------------------------------------------------------------

@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder all executors reach, gone when the block ends."""
    folder = run_folder(spark, label)
    try:
        yield folder
    finally:
        remove_folder(spark, folder)


@query
def stored_prices_cut(spark, sf_dir):
    """Written by year, cut to days, read."""
    with scratch(spark, "prices") as folder:
        writers.write_prices(load_prices(spark, sf_dir), folder)
        return durable(panel.filter_by_date(price_source.read_prices(spark, folder), *CUT_RANGE))


@query
def merged_vendor_folder(spark, sf_dir):
    """Per-ticker files, merged; the second merge finds the table there."""
    with scratch(spark, "vendor") as folder:
        writers.write_vendor_folder(load_prices(spark, sf_dir), f"{folder}/daily")
        for _ in range(2):
            writers.merge_vendor_folder(spark, f"{folder}/daily", f"{folder}/merged", duplicates="last")
        return durable(price_source.read_prices(spark, f"{folder}/merged"))


@query
def merged_csv(spark, sf_dir):
    with scratch(spark, "csv") as folder:
        writers.write_prices_csv(load_prices(spark, sf_dir), folder)
        return durable(price_source.read_prices_csv(spark, folder))


@query
def updated_prices(spark, sf_dir):
    """The update, half a unit higher, put into the stored history."""
    history, update = history_and_update(spark, sf_dir)
    with scratch(spark, "updated") as folder:
        writers.write_prices(history, folder)
        writers.update_prices(spark, folder, update.withColumn("price", F.col("price") + 0.5))
        return durable(price_source.read_prices(spark, folder))


def faulty_vendor_folder(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Per-ticker files; a tenth of the tickers got an error message besides, and
    another tenth a line that breaks off."""
    prices = load_prices(spark, sf_dir)
    writers.write_vendor_folder(prices, folder)
    last = F.substring("ticker", -1, 1)
    header = ",".join(schema.VENDOR_HEADER)
    extra = F.when(last == "7", F.lit('{ "Note": "call limit reached" }')).when(last == "3", F.lit(f"{header}\n2024-01-05,1,2"))
    lines = load_tickers(spark, sf_dir).select("ticker", extra.alias("value")).where("value is not null")
    writers.by_ticker(lines).write.mode("append").partitionBy("ticker").text(folder)


@query
def accepted_prices(spark, sf_dir):
    """The merged table of the files without an error message."""
    with scratch(spark, "accepted") as folder:
        faulty_vendor_folder(spark, sf_dir, f"{folder}/daily")
        writers.merge_vendor_folder(spark, f"{folder}/daily", f"{folder}/merged", strict=False)
        return durable(price_source.read_prices(spark, f"{folder}/merged"))


@query
def quarantined_lines(spark, sf_dir):
    """What that merge set aside, and why."""
    with scratch(spark, "rejected") as folder:
        faulty_vendor_folder(spark, sf_dir, f"{folder}/daily")
        writers.merge_vendor_folder(spark, f"{folder}/daily", f"{folder}/merged", strict=False,
                                    quarantine=f"{folder}/rejected")
        rejected = spark.read.parquet(f"{folder}/rejected")
        return durable(rejected.select(text.ticker_from_path(F.col("path")).alias("ticker"), "reason", "n_lines", "line"))


@query
def replaced_result(spark, sf_dir):
    """Result lines, written over an older result and read."""
    totals = durable(portfolio_value(spark, sf_dir))
    with scratch(spark, "result") as folder:
        for rows in (totals.withColumn("total", F.lit(0.0)), totals):
            writers.write_result(rows, folder)
        return durable(report.read_result(spark, folder))


@query
def stored_snapshot(spark, sf_dir):
    """A snapshot of two portfolios, one range of its days written again with the
    units doubled; then some days of one portfolio are read back."""
    prices = stored_prices(spark, sf_dir)
    lots = whole_market_lots(prices)
    rows = durable(panel.holdings_snapshot(lots.unionByName(lots.withColumn("sim", F.lit(2).cast("long"))), prices))
    with scratch(spark, "snapshot") as folder:
        writers.write_snapshot(rows, folder)
        again = panel.filter_by_date(rows, *CUT_RANGE).withColumn("units", F.col("units") * 2)
        writers.write_snapshot(again, folder, mode="replace")
        back = durable(snapshots.read_snapshot(spark, folder, end=CUT_RANGE[1], sims=[2]))
    return back.select("sim", "day", "ticker", "price", *rounded("units"))


# -- panel --------------------------------------------------------------------

@query
def filter_by_date(spark, sf_dir):
    return panel.filter_by_date(load_prices(spark, sf_dir), *CUT_RANGE)


@query
def filter_by_ticker(spark, sf_dir):
    return panel.filter_by_ticker(load_prices(spark, sf_dir), "U3")


@query
def prices_on_day(spark, sf_dir):
    return panel.prices_on_day(load_prices(spark, sf_dir), ASKED_DAY)


@query
def trading_days(spark, sf_dir):
    return panel.trading_days(ticks(spark, sf_dir))


@query
def day_index(spark, sf_dir):
    return panel.day_index(ticks(spark, sf_dir))


@query
def dedupe_keep_last(spark, sf_dir):
    return panel.dedupe_keep_last(ticks(spark, sf_dir), "ts")


@query
def dedupe_keep_first(spark, sf_dir):
    return panel.dedupe_keep_first(ticks(spark, sf_dir), "ts")


@query
def price_lookup(spark, sf_dir):
    """The day after every panel row, traded or not."""
    prices = load_prices(spark, sf_dir)
    asked = prices.select("ticker", F.date_add("day", 1).alias("day"))
    return panel.price_lookup(asked, prices)


@query
def entry_vs_today(spark, sf_dir):
    return panel.entry_vs_today(week_old_positions(spark, sf_dir), load_prices(spark, sf_dir))


@query
def held_prices(spark, sf_dir):
    prices = stored_prices(spark, sf_dir)
    held = panel.held_prices(panel.prices_on_day(prices, later_day(prices)[0]), opening_holdings(prices),
                             max_holdings=N_SIMS * N_TICKERS)
    return held.select("ticker", "day", "price")


# -- choosing and opening -----------------------------------------------------

@query
def sample_tickers(spark, sf_dir):
    return allocation.sample_tickers(load_tickers(spark, sf_dir), N_TICKERS, seed=SEED)


@query
def initial_allocation(spark, sf_dir):
    return opening_holdings(stored_prices(spark, sf_dir)).select(
        "sim", "ticker", "entry_day", "entry_price", *rounded("units"))


@query
def buy_and_hold(spark, sf_dir):
    prices = stored_prices(spark, sf_dir)
    rows = holding.buy_and_hold(prices, chosen_of(prices), n_sims=N_SIMS, money=MONEY)
    return rows.select("sim", "day", "ticker", "price", *rounded("units"))


@query
def portfolio_value(spark, sf_dir):
    """The equal-share portfolio of the whole market, day by day."""
    prices = stored_prices(spark, sf_dir)
    totals = panel.portfolio_value(whole_market_lots(prices), prices, panel.trading_days(prices), n_sims=1)
    return totals.select("sim", "day", *rounded("total"))


@query
def carried_prices(spark, sf_dir):
    """The panel with its gaps filled by the last price."""
    prices = stored_prices(spark, sf_dir)
    return panel.carried_prices(prices, panel.day_index(prices))


@query
def portfolio_value_carried(spark, sf_dir):
    """The portfolio of the whole market, untraded holdings at their last price."""
    prices = stored_prices(spark, sf_dir)
    totals = panel.portfolio_value_carried(whole_market_lots(prices), prices, panel.day_index(prices), n_sims=1)
    return totals.select("sim", "day", *rounded("total"))


@query
def holdings_snapshot(spark, sf_dir):
    """The whole market portfolio on every day it trades."""
    prices = stored_prices(spark, sf_dir)
    snapshot = panel.holdings_snapshot(whole_market_lots(prices), prices)
    return snapshot.select("sim", "day", "ticker", "price", *rounded("units"))


# -- trading ------------------------------------------------------------------

@query
def stop_loss_signal(spark, sf_dir):
    positions = panel.entry_vs_today(week_old_positions(spark, sf_dir), load_prices(spark, sf_dir))
    flagged = trading.stop_loss_signal(positions, Policy(), "stop_loss")
    return trading.stop_loss_signal(flagged, Policy(mode="documented"), "stop_loss_documented")


@query
def gain_plateau_signal(spark, sf_dir):
    positions = panel.entry_vs_today(week_old_positions(spark, sf_dir), load_prices(spark, sf_dir))
    flagged = trading.gain_plateau_signal(positions, Policy(), "plateau")
    return trading.gain_plateau_signal(flagged, Policy(mode="documented"), "plateau_documented")


def _decisions(spark, sf_dir, policy):
    prices = stored_prices(spark, sf_dir)
    today = panel.prices_on_day(prices, later_day(prices)[0])
    return (trading.sell_decisions(whole_market_lots(prices), today, policy)
            .select("sim", "ticker", "entry_price", "price", "reason"))


@query
def sell_decisions(spark, sf_dir):
    return _decisions(spark, sf_dir, Policy())


@query
def sell_decisions_documented(spark, sf_dir):
    return _decisions(spark, sf_dir, Policy(mode="documented"))


@query
def sell_proceeds(spark, sf_dir):
    """Sell the whole market portfolio, as far as it trades."""
    prices = stored_prices(spark, sf_dir)
    lots = whole_market_lots(prices)
    today = panel.prices_on_day(prices, later_day(prices)[0])
    sold = trading.sell_proceeds(lots.select("sim", "ticker"), lots, today)
    return sold.select("sim", "ticker", "price", *rounded("units", "proceeds"))


@query
def buy_units(spark, sf_dir):
    """Spend 500 on every ticker of the panel, held before or not."""
    prices = stored_prices(spark, sf_dir)
    orders = tickers_of(prices).select(
        F.lit(1).cast("long").alias("sim"), "ticker", F.lit(500.0).alias("money"))
    today = panel.prices_on_day(prices, later_day(prices)[0])
    bought = trading.buy_units(orders, opening_holdings(prices, n_sims=1), today)
    return bought.select("sim", "ticker", *rounded("units"))


@query
def merge_lots(spark, sf_dir):
    """One lot per ticker and day, merged over the whole range."""
    lots = load_prices(spark, sf_dir).select(
        F.lit(1).cast("long").alias("sim"), "ticker", F.col("day").alias("entry_day"),
        F.col("price").alias("entry_price"), F.col("volume").cast("double").alias("units"))
    return allocation.merge_lots(lots)


@query
def unowned_tickers(spark, sf_dir):
    prices = stored_prices(spark, sf_dir)
    return trading.unowned_tickers(tickers_of(prices), opening_holdings(prices, n_sims=1))


@query
def tradable_candidates(spark, sf_dir):
    prices = stored_prices(spark, sf_dir)
    today = panel.prices_on_day(prices, later_day(prices)[0])
    return trading.tradable_candidates(tickers_of(prices), opening_holdings(prices, n_sims=1), today)


@query
def pick_replacement(spark, sf_dir):
    """Every scenario sells everything it holds."""
    prices = stored_prices(spark, sf_dir)
    holdings, (day, day_idx) = opening_holdings(prices), later_day(prices)
    return trading.pick_replacement(
        holdings.select("sim", "ticker"), holdings, prices, day=day, day_idx=day_idx, seed=SEED,
        n_universe=n_tickers(prices), max_lots=N_TICKERS)


@query
def pick_replacement_whole_market(spark, sf_dir):
    """One scenario of unbounded size: it owns every ticker of the opening day
    and sells those that trade later."""
    prices = stored_prices(spark, sf_dir)
    lots, (day, day_idx) = durable(whole_market_lots(prices)), later_day(prices)
    today = panel.prices_on_day(prices, day)
    sales = panel.held_prices(today, lots).select(F.lit(1).cast("long").alias("sim"), "ticker")
    return trading.pick_replacement(sales, lots, prices, day=day, day_idx=day_idx, seed=SEED,
                                    n_universe=n_tickers(prices))


@query
def rebalance_step(spark, sf_dir):
    prices = stored_prices(spark, sf_dir)
    day, day_idx = later_day(prices)
    after = trading.rebalance_step(
        opening_holdings(prices), prices, day=day, day_idx=day_idx, seed=SEED, n_universe=n_tickers(prices),
        max_lots=N_TICKERS, max_holdings=N_SIMS * N_TICKERS)
    return after.select("sim", "ticker", "entry_day", "entry_price", *rounded("units"))


# -- whole scenarios ----------------------------------------------------------

def _moves(prices, *, mode="code", sampled_universe=False, in_order=False, **more):
    chosen = chosen_of(prices)
    return backtest.backtest_moves(prices, chosen, backtest.Scenarios(
        n_sims=N_SIMS, money=MONEY, seed=SEED, policy=Policy(mode=mode), in_order=in_order,
        universe=chosen if sampled_universe else None, **more))


def _totals(spark, sf_dir, **kind):
    prices = stored_prices(spark, sf_dir)
    totals = backtest.scenario_totals(_moves(prices, **kind), panel.day_index(prices), N_SIMS)
    return totals.select("sim", "day", *rounded("total"))


@query
def scenario_backtest(spark, sf_dir):
    return _totals(spark, sf_dir)


@query
def scenario_backtest_stepped(spark, sf_dir):
    """Day by day, each step a plan and a write of its own: the way of scenarios
    too large for blocks of days."""
    return _totals(spark, sf_dir, days_per_plan=1)


@query
def scenario_backtest_carried(spark, sf_dir):
    """Untraded holdings count with their last price."""
    prices = stored_prices(spark, sf_dir)
    calendar = panel.day_index(prices)
    totals = backtest.scenario_totals(_moves(prices), calendar, N_SIMS, panel.carried_prices(prices, calendar))
    return totals.select("sim", "day", *rounded("total"))


@query
def scenario_backtest_sampled_universe(spark, sf_dir):
    """Replacements come from the ten chosen tickers only."""
    return _totals(spark, sf_dir, sampled_universe=True)


@query
def scenario_backtest_in_order(spark, sf_dir):
    """... and the sales of a day run one after another."""
    return _totals(spark, sf_dir, sampled_universe=True, in_order=True)


@query
def scenario_backtest_documented(spark, sf_dir):
    return _totals(spark, sf_dir, mode="documented")


@query
def trade_ledger(spark, sf_dir):
    ledger = backtest.trade_ledger(_moves(stored_prices(spark, sf_dir)))
    return ledger.select("sim", "day", "side", "ticker", "price", "reason",
                         *rounded("units", "money"))


@query
def scenario_snapshot(spark, sf_dir):
    snapshot = backtest.scenario_snapshot(_moves(stored_prices(spark, sf_dir)))
    return snapshot.select("sim", "day", "ticker", "price", *rounded("units"))


@query
def sim_output_lines(spark, sf_dir):
    return writers.result_lines(_totals(spark, sf_dir))


@query
def sim_chart_table(spark, sf_dir):
    return report.sim_chart_table(writers.result_lines(_totals(spark, sf_dir)))


@query
def sim_chart_tail(spark, sf_dir):
    return report.sim_chart_tail(writers.result_lines(_totals(spark, sf_dir)))
