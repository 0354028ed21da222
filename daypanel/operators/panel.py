"""Cuts, calendars and lookups of a price panel keyed by (ticker, day).

Lookups expect one row per key and join as they stand, so a key that occurs
twice doubles what is looked up; `dedupe_keep_last` and `dedupe_keep_first` make
keys unique."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from daypanel.functions.quotes import usable
from daypanel.operators.allocation import for_each_sim
from daypanel.session import broadcast_if_bounded


# The year a stored table is laid out by, as `sources.prices.read_prices` keeps it
# below the frame it returns.
STORED_YEAR = "__stored_year"


def filter_by_date(prices: DataFrame, start, end) -> DataFrame:
    """Rows from ``start`` to ``end``, both days included; None leaves a side open.
    The bounds reach the file scan, also through the aggregation that builds a
    panel from ticks. Of a table stored by year only the years between are read."""
    first, last = (None if d is None else F.lit(d).cast("date") for d in (start, end))
    kept, years = F.lit(True), F.lit(True)
    if first is not None:
        kept, years = kept & (F.col("day") >= first), years & (F.col(STORED_YEAR) >= F.year(first))
    if last is not None:
        kept, years = kept & (F.col("day") <= last), years & (F.col(STORED_YEAR) <= F.year(last))
    if first is None and last is None:
        return prices
    return _of_years(prices, years).where(kept)


def _of_years(prices: DataFrame, years: Column) -> DataFrame:
    """The rows whose stored year fits, where the year can still be seen: not
    above an aggregation or a join of the table, where all rows come back."""
    if not prices.schema["day"].metadata.get(STORED_YEAR):
        return prices
    try:
        return prices.where(years)
    except AnalysisException:
        return prices


def filter_by_ticker(prices: DataFrame, ticker: str) -> DataFrame:
    return prices.where(F.col("ticker") == ticker)


def prices_on_day(prices: DataFrame, day) -> DataFrame:
    day = F.lit(day).cast("date")
    return _of_years(prices, F.col(STORED_YEAR) == F.year(day)).where(F.col("day") == day)


def trading_days(rows: DataFrame) -> DataFrame:
    """Sorted distinct days of anything with a ``day`` column."""
    return rows.select("day").distinct().orderBy("day")


def day_index(rows: DataFrame) -> DataFrame:
    """Position of each trading day. The unpartitioned window sees one row per
    calendar day only, never the panel."""
    position = F.row_number().over(Window.orderBy("day")) - 1
    return rows.select("day").distinct().select("day", position.cast("long").alias("day_idx"))


def dedupe_keep_last(prices: DataFrame, order_col: str, value: str = "price") -> DataFrame:
    """One row per (ticker, day): the value with the greatest ``order_col``.
    Duplicates collapse map-side, so a hot key costs one row per task."""
    return prices.groupBy("ticker", "day").agg(F.max_by(value, order_col).alias(value))


def dedupe_keep_first(prices: DataFrame, order_col: str, value: str = "price") -> DataFrame:
    return prices.groupBy("ticker", "day").agg(F.min_by(value, order_col).alias(value))


def price_lookup(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Price of every (ticker, day) asked for, with a found flag; 0.0 when the
    ticker did not trade."""
    known = prices.select("ticker", "day", "price")
    return (positions.join(known, ["ticker", "day"], "left")
            .withColumn("found", F.col("price").isNotNull())
            .withColumn("price", F.coalesce("price", F.lit(0.0))))


def entry_vs_today(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Adds entry_price and price to positions (ticker, entry_day, day). Today
    comes first: positions made from a panel are already partitioned for it."""
    entry = prices.select("ticker", F.col("day").alias("entry_day"),
                          F.col("price").alias("entry_price"))
    today = prices.select("ticker", "day", "price")
    return (positions.join(today, ["ticker", "day"], "left")
            .join(entry, ["ticker", "entry_day"], "left"))


# Below, ``max_holdings`` is a row count of the holdings the caller can prove.
# Under it they are broadcast, and the prices are read in place.

def held_prices(day_prices: DataFrame, holdings: DataFrame, *,
                max_holdings: int | None = None) -> DataFrame:
    """Prices of tickers somebody holds. Holdings repeat a ticker once per
    scenario, so they are reduced to distinct tickers before the join."""
    held = broadcast_if_bounded(holdings.select("ticker").distinct(), max_holdings)
    return day_prices.join(held, "ticker", "left_semi")


def holdings_snapshot(holdings: DataFrame, prices: DataFrame, *,
                      max_holdings: int | None = None) -> DataFrame:
    """(sim, day, ticker, price, units) of held tickers on days they trade.
    Holdings may carry a ``day``; without one they stand for every day."""
    keys = ["ticker", "day"] if "day" in holdings.columns else ["ticker"]
    held = broadcast_if_bounded(holdings.select("sim", "units", *keys), max_holdings)
    return (prices.where(usable(F.col("price"))).select("ticker", "day", "price").join(held, keys)
            .select("sim", "day", "ticker", "price", "units"))


def zero_totals(calendar: DataFrame, n_sims: int) -> DataFrame:
    """A total of 0 for each scenario on each calendar day."""
    return for_each_sim(calendar.select("day", F.lit(0.0).alias("total")), n_sims)


def portfolio_value(holdings: DataFrame, prices: DataFrame, calendar: DataFrame,
                    n_sims: int, max_holdings: int | None = None) -> DataFrame:
    """Value of fixed holdings on each calendar day; a holding that does not
    trade that day counts as 0, and a scenario without any value gets 0.

    The zero rows are appended instead of joined, so one aggregation does
    both, with its partial sums before the shuffle."""
    held = broadcast_if_bounded(holdings.select("sim", "ticker", "units"), max_holdings)
    worth = (prices.where(usable(F.col("price"))).select("ticker", "day", "price").join(held, "ticker")
             .select("sim", "day", (F.col("units") * F.col("price")).alias("total")))
    return (worth.unionByName(zero_totals(calendar, n_sims))
            .groupBy("sim", "day").agg(F.sum("total").alias("total")))


# -- values across gaps -------------------------------------------------------

DAYS_PER_SHELF = 64


def carried_prices(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """(ticker, day, price, quoted_day): for each calendar day from a ticker's first
    usable price on, its last usable price at or before that day.

    ``calendar`` has ``day`` and ``day_idx`` (see `day_index`). Each quote holds
    until the ticker's next one. The next one is looked for among the ticker's
    quotes of the same `DAYS_PER_SHELF` days, and from the last of these by the
    first quote of the ticker's next such shelf, so no window holds more rows of a
    ticker than a shelf has days or the calendar has shelves."""
    days = calendar.where(F.col("day").isNotNull()).select("day", F.col("day_idx").cast("long").alias("day_idx"))
    n_days = days.agg(F.max("day_idx") + 1).scalar()
    quotes = (prices.where(usable(F.col("price")) & F.col("ticker").isNotNull()).select("ticker", "day", "price")
              .join(days, "day").withColumn("shelf", F.floor(F.col("day_idx") / DAYS_PER_SHELF)))
    shelf = Window.partitionBy("ticker", "shelf")
    marked = quotes.select("*", F.lead("day_idx").over(shelf.orderBy("day_idx")).alias("next_idx"))
    heads = quotes.groupBy("ticker", "shelf").agg(F.min("day_idx").alias("first_idx"))
    heads = heads.select("ticker", "shelf", F.lead("first_idx").over(
        Window.partitionBy("ticker").orderBy("shelf")).alias("next_shelf_idx"))
    until = F.coalesce("next_idx", "next_shelf_idx", n_days)
    held = (marked.join(heads, ["ticker", "shelf"])
            .select("ticker", "price", F.col("day").alias("quoted_day"),
                    F.explode(F.sequence("day_idx", F.greatest(F.col("day_idx"), until - 1))).alias("day_idx")))
    return held.join(days, "day_idx").select("ticker", "day", "price", "quoted_day")


def portfolio_value_carried(holdings: DataFrame, prices: DataFrame, calendar: DataFrame, n_sims: int,
                            max_holdings: int | None = None) -> DataFrame:
    """Like `portfolio_value`, but a holding that does not trade on a day counts
    with its last usable price; before its first one it counts as 0. Only prices
    of held tickers are carried."""
    mine = broadcast_if_bounded(holdings.select("ticker").distinct(), max_holdings)
    carried = carried_prices(prices.join(mine, "ticker", "left_semi"), calendar)
    return portfolio_value(holdings, carried, calendar, n_sims, max_holdings)
