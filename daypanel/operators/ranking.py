"""Numbering a day's tradable tickers, and drawing from those not owned.

"Choose one ticker this scenario does not own" looks like scenarios x tickers
rows per day. It is not needed: the day's tickers are numbered once for all
scenarios, and the k-th *free* number is found by stepping over the scenario's
own few numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from daypanel.functions import draws
from daypanel.functions.quotes import usable
from daypanel.session import broadcast_if_bounded, durable

# Hash order is cut into this many hex digits' worth of shelves (256). Each
# (day, shelf) is a separate window group, so a day holding a third of the
# panel still spreads over 256 groups.
SHELF_DIGITS = 2

# Numbers of one scenario are cut into shelves of this many, unless the caller
# can prove that no scenario has more lots than that.
LOTS_PER_SHELF = 1 << 16

# Up to this many lots, a scenario's numbers and its later sales may travel in
# each of its rows.
CHAIN_IN_ROW = 256


def running_sums(rows: DataFrame, values: dict[str, Column], group: str, order: list, *,
                 max_offsets: int | None = None) -> DataFrame:
    """Adds ``<name>_sum`` (running, own row included) and ``<name>_total``
    for each value, per ``group`` in the order of (shelf, *order).

    No task sees a whole group: sums run within one shelf, and each shelf's
    offset comes from a table with a row per group and shelf."""
    rows = rows.select("*", *[v.alias(name) for name, v in values.items()])
    below = (Window.partitionBy(group).orderBy("shelf")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (rows.groupBy(group, "shelf").agg(*[F.sum(n).alias(n) for n in values])
               .select(group, "shelf",
                       *[F.coalesce(F.sum(n).over(below), F.lit(0)).alias(f"{n}_below")
                         for n in values],
                       *[F.sum(n).over(Window.partitionBy(group)).alias(f"{n}_total")
                         for n in values]))
    upto = (Window.partitionBy(group, "shelf").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.select("*", *[F.sum(n).over(upto).alias(f"{n}_sum") for n in values])
            .drop(*values)
            .join(broadcast_if_bounded(offsets, max_offsets), [group, "shelf"])
            .withColumns({f"{n}_sum": F.col(f"{n}_sum") + F.col(f"{n}_below") for n in values})
            .drop("shelf", *[f"{n}_below" for n in values]))


def ranked_prices(prices: DataFrame, universe: DataFrame | None = None, *,
                  max_days: int | None = None) -> DataFrame:
    """Rows with a usable price as (day, ticker, price, rank, n_traded).

    ``rank`` counts 0..n_traded-1 in hash order within a day over the tickers
    of ``universe`` (all when None); it is NULL for tickers outside of it.
    ``max_days`` is a proven bound on the days, if there is one."""
    traded = (prices.where(usable(F.col("price")) & F.col("day").isNotNull()
                           & F.col("ticker").isNotNull())
              .select("day", "ticker", "price"))
    if universe is None:
        traded = traded.withColumn("in_pool", F.lit(True))
    else:
        pool = universe.select("ticker", F.lit(True).alias("in_pool")).distinct()
        traded = (traded.join(pool, "ticker", "left")
                  .withColumn("in_pool", F.coalesce("in_pool", F.lit(False))))
    # A shelf that cannot be NULL keeps the planner from adding a filter to one
    # of the two uses of these rows, so both read the same shuffle.
    key = draws.shelf_key(F.col("ticker"))
    shelved = (traded.withColumn("key", key)
               .withColumn("shelf", F.coalesce(F.substring("key", 1, SHELF_DIGITS), F.lit(""))))
    numbered = running_sums(
        shelved, {"pool": F.col("in_pool").cast("long")}, "day", ["key", "ticker"],
        max_offsets=None if max_days is None else max_days * 16 ** SHELF_DIGITS)
    return numbered.select("day", "ticker", "price",
                           F.when(F.col("in_pool"), F.col("pool_sum") - 1).alias("rank"),
                           F.col("pool_total").alias("n_traded"))


def _shelf_of(number: Column, spread_by: str) -> Column:
    """Shelf of a number; rows without one come first, spread over many."""
    nowhere = -1 - F.pmod(F.xxhash64(spread_by), F.lit(1 << 10))
    return F.coalesce(F.shiftright(number, 16), nowhere)


def position_draw(seed: int, day_idx: Column) -> Column:
    return draws.seeded_draw(seed, F.col("sim"), day_idx, F.col("ticker"))


def with_pick_rank(positions: DataFrame, wanted: Column, *, seed: int, day_idx: Column | int,
                   n_universe: Column, max_lots: int | None = None) -> DataFrame:
    """Adds ``pick_rank``: the number of the ticker drawn for each position
    with ``wanted``, NULL when there is nothing to draw from; and ``owns_all``.

    Positions need (sim, ticker, rank, n_traded), one row per ticker a scenario
    owned at the start of the day; rank is NULL for a ticker without a price.
    The draw is uniform over the tradable tickers the scenario does not own, or
    over all tradable tickers when it owns the whole universe. ``max_lots`` is
    a proven bound on the positions of one scenario, if there is one."""
    day_idx = day_idx if isinstance(day_idx, Column) else F.lit(day_idx)
    draw = position_draw(seed, day_idx)
    if max_lots is not None and max_lots <= CHAIN_IN_ROW:
        return _drawn_in_rows(positions, wanted, draw, n_universe)
    if max_lots is not None and max_lots <= LOTS_PER_SHELF:
        return _drawn_in_place(positions, wanted, draw, n_universe)
    numbered = running_sums(
        positions.withColumn("shelf", _shelf_of(F.col("rank"), "ticker")),
        {"held": F.lit(1), "own": F.col("rank").isNotNull().cast("long")}, "sim", ["rank", "ticker"])
    numbered = numbered.select(
        *positions.columns, (F.col("held_total") >= n_universe).alias("owns_all"),
        *_marks(wanted, draw, n_universe, F.col("held_total"), F.col("own_sum"), F.col("own_total")))
    return (_step_over_by_join(numbered)
            .withColumn("pick_rank", F.col("k") + F.when(F.col("owns_all"), F.lit(0))
                        .otherwise(F.col("stepped_over")))
            .drop("free_below", "k", "stepped_over"))


def _marks(wanted: Column, draw: Column, n_universe: Column, held: Column, own_upto: Column,
           own: Column) -> tuple[Column, Column]:
    """``free_below``: free numbers below a position's own number; ``k``: which
    of the free numbers is drawn."""
    n_free = F.when(held >= n_universe, F.col("n_traded")).otherwise(F.col("n_traded") - own)
    return (F.when(F.col("rank").isNotNull(), F.col("rank") - own_upto + 1).alias("free_below"),
            F.when(wanted & (n_free > 0), draw % F.nullif(n_free, F.lit(0))).alias("k"))


# The k-th free number is k plus the owned numbers with at most k free ones
# below them: a running count, once the marks of owned numbers (at free_below)
# and of draws (at k) are in one order. That is a sort within the scenario, not
# a comparison of all its pairs.

def in_row_columns(wanted: Column, draw: Column, n_universe: Column) -> tuple[list[Column], list[Column]]:
    """For small scenarios: each row carries the scenario's own numbers, and one
    window does it all. The j-th of them, from 0, has its value less j free numbers
    below it. The first columns are to be selected beside the positions, the second
    ones (``owns_all``, ``pick_rank``) from what that gives."""
    every = Window.partitionBy("sim")
    counts = [F.count(F.lit(1)).over(every).alias("held"), F.collect_list("rank").over(every).alias("own"),
              n_universe.alias("n_universe")]
    owns_all = F.col("held") >= F.col("n_universe")
    n_free = F.when(owns_all, F.col("n_traded")).otherwise(F.col("n_traded") - F.size("own"))
    k = F.when(wanted & (n_free > 0), draw % F.nullif(n_free, F.lit(0)))
    free_below = F.transform(F.array_sort("own"), lambda number, j: number - j)
    # An array of one holds k, so that it is worked out once.
    picked = F.transform(F.array(k), lambda k: k + F.when(owns_all, F.lit(0)).otherwise(
        F.size(F.filter(free_below, lambda n: n <= k))))
    return counts, [owns_all.alias("owns_all"), picked[0].alias("pick_rank")]


def _drawn_in_rows(positions: DataFrame, wanted: Column, draw: Column, n_universe: Column) -> DataFrame:
    counts, picked = in_row_columns(wanted, draw, n_universe)
    return positions.select("*", *counts).select(*positions.columns, *picked)


def _drawn_in_place(positions: DataFrame, wanted: Column, draw: Column, n_universe: Column) -> DataFrame:
    """For scenarios of bounded size: both marks of a row stay with the row, and
    the partitioning by scenario it already has serves all windows."""
    every = Window.partitionBy("sim")
    upto = (every.orderBy(F.col("rank").asc_nulls_first(), "ticker")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = positions.select(
        *positions.columns, F.count(F.lit(1)).over(every).alias("held_all"),
        F.count("rank").over(every).alias("own_all"), F.count("rank").over(upto).alias("own_upto"))
    free_below, k = _marks(wanted, draw, n_universe, F.col("held_all"), F.col("own_upto"), F.col("own_all"))
    marks = F.array(F.struct(free_below.alias("at"), F.lit(0).alias("is_draw")),
                    F.struct(k.alias("at"), F.lit(1).alias("is_draw")))
    before = (every.orderBy(F.col("mark.at").asc_nulls_first(), "mark.is_draw")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A position without a number has no mark to count; its draw stays.
    counts = F.col("mark.is_draw").eqNullSafe(0) & F.col("mark.at").isNotNull()
    return (counted.select(*positions.columns, (F.col("held_all") >= n_universe).alias("owns_all"),
                           F.explode(marks).alias("mark"))
            .select(*positions.columns, "owns_all", "mark", F.count_if(counts).over(before).alias("stepped_over"))
            .where("mark.is_draw = 1")
            .select(*positions.columns, "owns_all", (F.col("mark.at") + F.when(F.col("owns_all"), F.lit(0)).otherwise(
                F.col("stepped_over"))).alias("pick_rank")))


def _step_over_by_join(numbered: DataFrame) -> DataFrame:
    """For scenarios of any size: equal marks collapse before the shuffle, and
    the counts come back by (sim, k)."""
    owned = (numbered.where(F.col("free_below").isNotNull())
             .groupBy("sim", F.col("free_below").alias("at")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("is_draw", F.lit(0)))
    drawn = (numbered.where(F.col("k").isNotNull()).select("sim", F.col("k").alias("at")).distinct()
             .withColumns({"n": F.lit(0).cast("long"), "is_draw": F.lit(1)}))
    counted = running_sums(
        owned.unionByName(drawn).withColumn("shelf", F.shiftright("at", 16)),
        {"marks": F.col("n")}, "sim", ["at", "is_draw"])
    steps = counted.where(F.col("is_draw") == 1).select(
        "sim", "at", F.col("marks_sum").alias("stepped_over"))
    # Positions without a draw match nothing, spread over many keys.
    nowhere = -1 - F.pmod(F.xxhash64("ticker"), F.lit(1 << 20))
    return (numbered.withColumn("at", F.coalesce("k", nowhere))
            .join(steps, ["sim", "at"], "left").drop("at"))


def through_later_sales(drawn: DataFrame, max_lots: int | None = None) -> DataFrame:
    """Where each draw's money ends when sales run one after another in rank
    order: a ticker bought and then sold itself later that day passes it on.

    Only a scenario that owns its whole universe can draw a ticker it is about
    to sell; every other row keeps its draw."""
    if max_lots is not None and max_lots <= CHAIN_IN_ROW:
        return _pass_on_in_rows(drawn)
    return _pass_on_by_doubling(drawn)


def _pass_on_in_rows(drawn: DataFrame) -> DataFrame:
    """For small scenarios: each row carries the later sales. Following them in
    rising order visits each link of the chain at most once."""
    sale = F.when(F.col("owns_all") & F.col("pick_rank").isNotNull(),
                  F.struct("rank", "pick_rank"))
    later = (Window.partitionBy("sim").orderBy(F.col("rank").desc_nulls_last(), "ticker")
             .rowsBetween(Window.unboundedPreceding, -1))
    return (drawn.withColumn("later", F.reverse(F.collect_list(sale).over(later)))
            .withColumn("pick_rank", F.aggregate(
                "later", F.col("pick_rank"),
                lambda at, sold: F.when(at == sold["rank"], sold["pick_rank"]).otherwise(at)))
            .drop("later"))


def _pass_on_by_doubling(drawn: DataFrame) -> DataFrame:
    """For scenarios of any size: links (rank -> drawn rank) of the scenarios
    that own everything. Each round follows twice as many links as the one
    before, so the longest chain takes its logarithm of joins; the rows of all
    other scenarios are not touched."""
    keys = ("sim", "rank")
    sales = drawn.where(F.col("owns_all") & F.col("pick_rank").isNotNull())
    links = durable(sales.select(*keys, F.col("pick_rank").alias("pick")))
    later = links.select(F.col("sim").alias("n_sim"), F.col("rank").alias("n_rank"))
    # A purchase moves on if what was bought is sold later that day; the last
    # sale of such a chain is its root.
    on = (F.col("sim") == F.col("n_sim")) & (F.col("pick") == F.col("n_rank")) & (F.col("n_rank") > F.col("rank"))
    roots = durable(links.join(later, on, "left").select(
        *keys, F.coalesce("n_rank", "rank").alias("root"), F.col("n_rank").isNotNull().alias("moved")))
    while roots.where("moved").limit(1).count():
        ahead = roots.select(F.col("sim").alias("n_sim"), F.col("rank").alias("n_rank"), F.col("root").alias("n_root"))
        on = (F.col("sim") == F.col("n_sim")) & (F.col("root") == F.col("n_rank"))
        roots = durable(roots.join(ahead, on).select(
            *keys, F.col("n_root").alias("root"), (F.col("n_root") != F.col("root")).alias("moved")))
    on = (F.col("sim") == F.col("n_sim")) & (F.col("root") == F.col("n_rank"))
    ends = roots.join(links.select(F.col("sim").alias("n_sim"), F.col("rank").alias("n_rank"), "pick"), on).select(
        F.col("sim").alias("e_sim"), F.col("rank").alias("e_rank"), "pick")
    # Rows without a rank match nothing, spread over many keys.
    nowhere = -1 - F.pmod(F.xxhash64("ticker"), F.lit(1 << 20))
    on = (F.col("sim") == F.col("e_sim")) & (F.coalesce("rank", nowhere) == F.col("e_rank"))
    return (drawn.join(ends, on, "left").withColumn("pick_rank", F.coalesce("pick", "pick_rank"))
            .select(*drawn.columns))
