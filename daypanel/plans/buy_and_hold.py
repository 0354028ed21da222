"""Opening purchase, then no trading."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from daypanel import schema
from daypanel.operators import allocation


def buy_and_hold(prices: DataFrame, chosen: DataFrame, *, n_sims: int = 1,
                 money: float = schema.MONEY) -> DataFrame:
    """(sim, day, ticker, price, units) of every holding on each day it
    trades, the purchase day included. Bought on the first day on which any
    chosen ticker trades. All scenarios are alike, so the rows are worked out
    once; ``n_sims`` above 1 asks for a copy of them per scenario."""
    # Cut to the chosen tickers first. A semi join on a grouping key moves below
    # the aggregation that may have built the panel.
    offers = (prices.select("ticker", "day", "price")
              .join(chosen.select("ticker"), "ticker", "left_semi"))
    lots = allocation.opening_lots(offers, chosen, money=money, first_day="chosen")
    rows = (offers.join(lots.select("ticker", "entry_day", "units"), "ticker")
            .where(F.col("day") >= F.col("entry_day"))
            .select("day", "ticker", "price", "units"))
    return allocation.for_each_sim(rows, n_sims)
