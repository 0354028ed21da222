"""Signals, sales, purchases, and one day of rebalancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daypanel import schema, session
from daypanel.functions.policy import Policy, fired, sell_reason
from daypanel.functions.quotes import usable
from daypanel.operators.allocation import merge_lots
from daypanel.operators.panel import prices_on_day
from daypanel.operators.ranking import (
    CHAIN_IN_ROW, in_row_columns, position_draw, ranked_prices, through_later_sales, with_pick_rank)
from daypanel.session import lookup

DEFAULT_POLICY = Policy()


def stop_loss_signal(positions: DataFrame, policy: Policy = DEFAULT_POLICY,
                     name: str = "stop_loss") -> DataFrame:
    """Flags positions (entry_price, price) the stop-loss rule sells."""
    return positions.withColumn(
        name, fired(policy.stop_loss(F.col("entry_price"), F.col("price"))))


def gain_plateau_signal(positions: DataFrame, policy: Policy = DEFAULT_POLICY,
                        name: str = "plateau") -> DataFrame:
    """Flags positions (entry_price, price) the plateau rule sells."""
    return positions.withColumn(
        name, fired(policy.plateau(F.col("entry_price"), F.col("price"))))


def sell_decisions(holdings: DataFrame, day_prices: DataFrame,
                   policy: Policy = DEFAULT_POLICY, *,
                   max_holdings: int | None = None) -> DataFrame:
    """Holdings with today's price and the ``reason`` to sell: stop-loss, else
    plateau, NULL to keep. A holding without a price today is kept."""
    today = day_prices.where(usable(F.col("price"))).select("ticker", "price")
    return (lookup(holdings, today, "ticker", max_rows=max_holdings)
            .withColumn("reason", sell_reason(policy, F.col("entry_price"), F.col("price"))))


def sell_proceeds(sales: DataFrame, holdings: DataFrame, day_prices: DataFrame) -> DataFrame:
    """Money from selling (sim, ticker) in full at today's price. Selling what
    is not held fails the job."""
    today = day_prices.where(usable(F.col("price"))).select("ticker", "price")
    held = holdings.select("sim", "ticker", "units")
    missing = F.raise_error(F.concat(F.lit("sale of a ticker not held: "), F.col("ticker")))
    units = F.when(F.col("units").isNull(), missing.cast("double")).otherwise(F.col("units"))
    return (sales.select("sim", "ticker").join(held, ["sim", "ticker"], "left")
            .withColumn("units", units)
            .join(today, "ticker")
            .withColumn("proceeds", F.col("price") * F.col("units")))


def buy_units(orders: DataFrame, holdings: DataFrame, day_prices: DataFrame) -> DataFrame:
    """Units owned after spending ``money`` on (sim, ticker) today, those held
    before included; 0 when the ticker does not trade."""
    today = day_prices.where(usable(F.col("price"))).select("ticker", "price")
    held = holdings.select("sim", "ticker", F.col("units").alias("held_units"))
    bought = F.coalesce(F.col("held_units"), F.lit(0.0)) + F.col("money") / F.col("price")
    return (orders.join(held, ["sim", "ticker"], "left")
            .join(today, "ticker", "left")
            .withColumn("units", F.coalesce(bought, F.lit(0.0))))


def unowned_tickers(universe: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Tickers of the universe one portfolio does not hold."""
    return universe.select("ticker").join(portfolio.select("ticker"), "ticker", "left_anti")


def tradable_candidates(universe: DataFrame, portfolio: DataFrame,
                        day_prices: DataFrame) -> DataFrame:
    """Tickers one portfolio may buy today: those it does not hold, or the
    whole universe when it holds all of them, as far as they trade."""
    owned = portfolio.select("ticker", F.lit(True).alias("owned")).distinct()
    marked = universe.select("ticker").join(owned, "ticker", "left")
    n_unowned = marked.agg(F.count_if(F.col("owned").isNull())).scalar()
    pool = marked.where(F.col("owned").isNull() | (n_unowned == 0)).select("ticker")
    return pool.join(day_prices.where(usable(F.col("price"))).select("ticker", "price"), "ticker")


def universe_size(prices: DataFrame, universe: DataFrame | None) -> Column:
    """Tickers of ``universe``, or of the panel as far as it has usable prices."""
    tickers = prices.where(usable(F.col("price"))) if universe is None else universe
    return tickers.agg(F.count_distinct("ticker")).scalar()


def pick_replacement(sales: DataFrame, holdings: DataFrame, prices: DataFrame, *, day,
                     day_idx: int, seed: int, universe: DataFrame | None = None,
                     n_universe: Column | None = None, max_lots: int | None = None) -> DataFrame:
    """The ticker each sale (sim, ticker) is reinvested in, with its price.
    ``universe`` must cover the tickers held; ``n_universe`` is its size where
    the caller knows it, ``max_lots`` a proven bound on one scenario's tickers."""
    quotes = ranked_prices(prices_on_day(prices, day), universe)
    selling = sales.select("sim", "ticker", F.lit(True).alias("selling"))
    state = (holdings.select("sim", "ticker").join(selling, ["sim", "ticker"], "left")
             .join(quotes.select("ticker", "rank"), "ticker", "left")
             .withColumn("n_traded", quotes.agg(F.max("n_traded")).scalar()))
    drawn = with_pick_rank(state, F.col("selling").isNotNull(), seed=seed, day_idx=day_idx,
                           n_universe=universe_size(prices, universe) if n_universe is None
                           else n_universe, max_lots=max_lots)
    picked = quotes.select(F.col("rank").alias("pick_rank"),
                           F.col("ticker").alias("replacement"), "price")
    return (drawn.select("sim", "ticker", "pick_rank").join(picked, "pick_rank")
            .select("sim", "ticker", "replacement", "price"))


class DayStep:
    """A day of rebalancing: from holdings that carry ``day_idx`` and ``day`` to what
    becomes of them (see `rebalance_moves`, also for the parameters). Its columns
    and its tables of quotes are made once and serve any number of days, if the
    quotes have a ``day_idx`` to tell them apart."""

    _HELD = ("sim", "ticker", "entry_day", "entry_price", "units", "day_idx", "day")

    def __init__(self, quotes: DataFrame, *, seed: int, n_universe: Column, policy: Policy = DEFAULT_POLICY,
                 in_order: bool = False, max_lots: int | None = None, max_holdings: int | None = None,
                 max_quotes: int | None = None, keep: tuple[str, ...] = ()):
        self.bounds = {"max_rows": max_holdings, "max_table": max_quotes}
        self.seed, self.n_universe, self.in_order, self.max_lots = seed, n_universe, in_order, max_lots
        self.of_day = [name for name in ("day_idx",) if name in quotes.columns]
        self.today = quotes.select(*self.of_day, "ticker", "price", "rank", "n_traded")
        self.picked = quotes.where(F.col("rank").isNotNull()).select(
            *self.of_day, F.col("rank").alias("pick_rank"), F.col("ticker").alias("choice"),
            F.col("price").alias("choice_price"))
        self.held = [*keep, *self._HELD]
        self.wish = sell_reason(policy, F.col("entry_price"), F.col("price")).alias("wish")
        self.in_rows = None
        if max_lots is not None and max_lots <= CHAIN_IN_ROW and not in_order:
            self.in_rows = in_row_columns(F.col("wish").isNotNull(), position_draw(seed, F.col("day_idx")), n_universe)
        # Positions that stay look up a number no ticker has; a spread of them, so
        # that a shuffled join does not send them all to one task.
        nowhere = -1 - F.pmod(F.xxhash64("sim", "ticker"), F.lit(1 << 20))
        self.pick_rank = F.coalesce("pick_rank", nowhere)
        moved = F.col("choice").isNotNull()
        self.moves = [
            *keep, "sim", "day_idx", "day", "ticker", "units", "price",
            F.when(moved, F.col("wish")).alias("reason"),
            F.coalesce("choice", "ticker").alias("new_ticker"),
            F.when(moved, F.col("choice_price")).otherwise(F.col("price")).alias("new_price"),
            F.when(moved, F.col("units") * F.col("price") / F.col("choice_price"))
            .otherwise(F.col("units")).alias("new_units"),
            F.when(moved, F.col("day")).otherwise(F.col("entry_day")).alias("new_entry_day"),
            F.when(moved, F.col("choice_price")).otherwise(F.col("entry_price"))
            .alias("new_entry_price")]

    def __call__(self, start: DataFrame) -> DataFrame:
        state = lookup(start, self.today, [*self.of_day, "ticker"], **self.bounds)
        if self.in_rows is not None:
            counts, picked = self.in_rows
            drawn = state.select("*", self.wish, *counts).select(*self.held, "price", "wish", *picked)
        else:
            drawn = with_pick_rank(state.select("*", self.wish), F.col("wish").isNotNull(), seed=self.seed,
                                   day_idx=F.col("day_idx"), n_universe=self.n_universe, max_lots=self.max_lots)
        if self.in_order:
            drawn = through_later_sales(drawn, self.max_lots)
        if not self.bounds["max_table"] or self.bounds["max_table"] > session.BROADCAST_ROWS:
            drawn = drawn.withColumn("pick_rank", self.pick_rank)
        return lookup(drawn, self.picked, [*self.of_day, "pick_rank"], **self.bounds).select(*self.moves)


def rebalance_moves(holdings: DataFrame, quotes: DataFrame, *, day, day_idx: int, keep: tuple[str, ...] = (),
                    **step) -> DataFrame:
    """What becomes of every holding on one day (see `schema.MOVES`).

    All sales are decided from the start-of-day state. By default they then
    happen at once. ``in_order`` runs them one after another in rank order, so
    money put into a ticker that is sold later the same day moves on with it;
    a move then names the ticker the money is in at the end of the day.
    ``quotes`` is one day of `ranked_prices`, or several that have a ``day_idx`` to
    tell them apart. ``day`` and ``day_idx`` may be columns of the holdings: a step
    that is repeated for every day then has the same plan each time, and Spark its
    compiled code at hand. ``keep`` names more columns of the holdings to pass on.

    Bounds the caller can prove make it cheaper: ``max_lots`` on one scenario's
    holdings (see `ranking.with_pick_rank`), ``max_holdings`` and ``max_quotes``
    on the rows of either table (see `session.lookup`). All of ``step`` is in
    `DayStep`."""
    today = day if isinstance(day, Column) else F.lit(day).cast("date")
    day_idx = day_idx if isinstance(day_idx, Column) else F.lit(day_idx)
    start = holdings.select("sim", "ticker", "entry_day", "entry_price", "units",
                            day_idx.cast("long").alias("day_idx"), today.alias("day"), *keep)
    return DayStep(quotes, keep=keep, **step)(start)


def lots_after(moves: DataFrame) -> DataFrame:
    """Lots at the end of the day, still one per start-of-day holding."""
    return moves.select("sim", "day_idx", "day", F.col("new_ticker").alias("ticker"),
                        F.col("new_entry_day").alias("entry_day"),
                        F.col("new_entry_price").alias("entry_price"),
                        F.col("new_units").alias("units"), F.col("new_price").alias("price"))


def rebalance_step(holdings: DataFrame, prices: DataFrame, *, day, universe: DataFrame | None = None,
                   n_universe: Column | None = None, **step) -> DataFrame:
    """Holdings of all scenarios after one day of trading, with today's price.
    ``step`` goes to `rebalance_moves`."""
    quotes = ranked_prices(prices_on_day(prices, day), universe)
    moves = rebalance_moves(
        holdings, quotes, day=day,
        n_universe=universe_size(prices, universe) if n_universe is None else n_universe, **step)
    return merge_lots(lots_after(moves), "price")
