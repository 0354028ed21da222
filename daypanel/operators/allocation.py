"""Choosing tickers and the opening purchase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daypanel import schema
from daypanel.functions import draws
from daypanel.functions.quotes import usable

SIMS_PER_BLOCK = 4096


def sample_tickers(tickers: DataFrame, n: int = schema.N_TICKERS, *, seed: int) -> DataFrame:
    """Exactly ``n`` tickers without replacement (all, when there are fewer):
    the smallest seeded hashes, a top-n that keeps n rows per task."""
    return (tickers.select("ticker")
            .orderBy(draws.seeded_key(seed, F.col("ticker")), "ticker").limit(n))


def opening_lots(prices: DataFrame, chosen: DataFrame, *, money: float = schema.MONEY,
                 day=None, first_day: str = "panel") -> DataFrame:
    """Equal-weight purchase, one row per chosen ticker that trades on the
    opening day. A ticker without a price that day gets nothing, and its share
    of the money is lost.

    The opening day is ``day`` (a date, or a column such as a scalar subquery),
    or the first day of the panel, or with ``first_day='chosen'`` the first day
    on which any chosen ticker trades."""
    offers = (prices.select("ticker", "day", "price")
              .join(chosen.select("ticker"), "ticker", "left_semi"))
    n_chosen = chosen.agg(F.count(F.lit(1))).scalar()
    if day is None:
        rows = offers.where(usable(F.col("price"))) if first_day == "chosen" else prices
        opening = rows.agg(F.min("day")).scalar()
    else:
        opening = day if isinstance(day, Column) else F.lit(day).cast("date")
    return (offers.where((F.col("day") == opening) & usable(F.col("price")))
            .select("ticker", F.col("day").alias("entry_day"),
                    F.col("price").alias("entry_price"),
                    (F.lit(money) / n_chosen / F.col("price")).alias("units")))


def for_each_sim(rows: DataFrame, n_sims: int = schema.N_SIMS) -> DataFrame:
    """``rows`` once for each scenario id 1..n_sims.

    Every scenario starts from the same lots: they are worked out once and then
    repeated, so no join depends on the number of scenarios. Many scenarios are
    repeated in blocks, so that the few input rows do not leave it to one task."""
    n_blocks = -(-n_sims // SIMS_PER_BLOCK)
    first, last = F.lit(1).cast("long"), F.lit(n_sims).cast("long")
    columns = rows.columns
    if n_blocks > 1:
        blocks = F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))
        rows = rows.select("*", F.explode(blocks).alias("block")).repartition(n_blocks, "block")
        first = F.col("block") * SIMS_PER_BLOCK + 1
        last = F.least(first + SIMS_PER_BLOCK - 1, last)
    return rows.select(F.explode(F.sequence(first, last)).alias("sim"), *columns)


def initial_allocation(prices: DataFrame, chosen: DataFrame, *,
                       n_sims: int = schema.N_SIMS, money: float = schema.MONEY,
                       day=None) -> DataFrame:
    """Opening holdings of every scenario."""
    return for_each_sim(opening_lots(prices, chosen, money=money, day=day), n_sims)


def lot_sums(prefix: str = "") -> list[Column]:
    """What lots of one ticker come to: units add up, entry is the latest one."""
    day, price, units = (prefix + name for name in ("entry_day", "entry_price", "units"))
    return [F.max(day).alias("entry_day"), F.max_by(price, day).alias("entry_price"), F.sum(units).alias("units")]


def merge_lots(lots: DataFrame, *extra: str) -> DataFrame:
    """One holding per (sim, ticker) (see `lot_sums`). ``extra`` columns are the
    same for all lots of a ticker."""
    return lots.groupBy("sim", "ticker").agg(*lot_sums(), *[F.max(c).alias(c) for c in extra])
