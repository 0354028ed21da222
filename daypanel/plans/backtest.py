"""Running many seeded scenarios over a date range.

Each scenario opens with the same lots and rebalances day by day; only its draws
differ. A day depends on the day before, so days are the sequential part; within
a day all scenarios and lots are rows of one distributed step. The panel is
numbered and laid out by day once.

Steps of several days are unrolled into one plan where scenarios are small: the
state passes from step to step inside a task, carrying what it did on the way, and
only the block of days is written to the shared folder. The next block reads its
state from there, so lineage stays short, and a lost executor or driver costs at
most one block.

The steps give `schema.MOVES`; totals, holdings and the ledger derive from it."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from daypanel import schema, session
from daypanel.functions.policy import Policy
from daypanel.functions.quotes import usable
from daypanel.operators import allocation, panel, ranking, trading


@dataclass(frozen=True)
class Scenarios:
    """What to run. ``in_order`` lets the sales of a day run one after another
    (see `trading.rebalance_moves`). ``universe`` limits replacements to the
    tickers of that frame (None: all tickers with a usable price); chosen
    tickers always belong. ``days_per_plan`` is the most days whose steps go into
    one plan: a step is about ten operators, and the planner's time for a block
    grows faster than its size."""

    n_sims: int = schema.N_SIMS
    money: float = schema.MONEY
    seed: int = 0
    policy: Policy = Policy()
    in_order: bool = False
    universe: DataFrame | None = None
    days_per_plan: int = 8


def backtest_moves(prices: DataFrame, chosen: DataFrame, spec: Scenarios,
                   calendar: DataFrame | None = None, folder: str | None = None) -> DataFrame:
    """Moves of every scenario on every day after the first.

    ``prices`` has one row per (ticker, day), already cut to the date range; two
    usable prices for one key are an error. Rows without a ticker, a day or a
    usable price (see `quotes.usable`) are no quotes; a day on which only such
    rows stand is still a trading day. ``prices`` may hold just the universe if
    ``calendar`` has the ``day`` of all trading.

    This runs the scenarios when it is called. Without ``folder`` the run's files go
    when it ends, and the result is read from the checkpoint folder. With ``folder``,
    on storage all executors reach, they stay: called again after a run that was
    lost, it goes on behind the last finished block of days, and after a finished
    one it reads the result. A folder that holds another run (other prices, days,
    tickers or parameters) is an error."""
    if folder is not None:
        return _run(prices, chosen, spec, calendar, folder.rstrip("/"), resume=True)
    folder = session.run_folder(prices.sparkSession, "backtest")
    try:
        return session.durable(_run(prices, chosen, spec, calendar, folder))
    finally:
        session.remove_folder(prices.sparkSession, folder)


# A step's rows: moves whose days are indexes.
_STEP = T.StructType([T.StructField(f.name, T.LongType()) if f.dataType == T.DateType() else f for f in schema.MOVES])


def _laid_out(quotes: DataFrame, days: list, folder: str) -> tuple[DataFrame, dict]:
    """Numbered quotes, stored by day, and how many there are on each day. The
    index of the day is a column of the files: a join on the folders' own column
    would have the planner look into the other side, and that is all steps before."""
    spark = quotes.sparkSession
    if not session.is_there(spark, f"{folder}/quotes"):
        calendar = spark.createDataFrame(list(enumerate(days)), "day_idx long, day date")
        (ranking.ranked_prices(quotes, max_days=len(days))
         .join(session.broadcast_if_bounded(calendar, len(days)), "day").hint("rebalance", "day")
         .write.mode("overwrite").partitionBy("day").parquet(f"{folder}/quotes"))
    stored = spark.read.schema(
        "day_idx long, ticker string, price double, rank long, n_traded long, day date").parquet(f"{folder}/quotes")
    # Copies of a key have the same ticker, so they number differently but share
    # a name; one row per key is left after their partial aggregation.
    keys = stored.groupBy("day", "ticker").agg(F.count("*").alias("n"))
    counts = {row.day: row for row in keys.groupBy("day").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("n") > 1, F.col("ticker"))).alias("twice")).collect()}
    for row in counts.values():
        if row.twice is not None:
            raise ValueError(f"{row.twice} has more than one usable price on {row.day}; "
                             "panel.dedupe_keep_last or dedupe_keep_first keeps one")
    return stored, {day: row.n for day, row in counts.items()}


def _run(prices: DataFrame, chosen: DataFrame, spec: Scenarios, calendar: DataFrame | None,
         folder: str, resume: bool = False) -> DataFrame:
    spark = prices.sparkSession
    chosen = session.durable(chosen.select("ticker").distinct())
    days = sorted(row.day for row in (prices if calendar is None else calendar)
                  .select("day").where(F.col("day").isNotNull()).distinct().collect())
    if len(days) < 2:
        return spark.createDataFrame([], schema.MOVES)
    quotes = prices.select("ticker", "day", "price").where(usable(F.col("price")))
    n_universe = pool = None
    if spec.universe is not None:
        # Nothing outside of the universe is ever held, so nothing else is read.
        pool = session.durable(spec.universe.select("ticker").unionByName(chosen).distinct())
        n_universe = pool.count()
        quotes = quotes.join(session.broadcast_if_bounded(pool, n_universe), "ticker", "left_semi")
    if resume:
        _same_run(spark, folder, _fingerprint(quotes, chosen, pool, days, spec))
    quotes, n_quotes = _laid_out(quotes, days, folder)
    if n_universe is None:
        n_universe = quotes.select("ticker").distinct().count()

    # All scenarios open alike with at most one lot per chosen ticker, and trading
    # never adds one: that bounds every later state.
    max_lots = chosen.count()
    max_holdings = max_lots * spec.n_sims
    # A state that fits one shelf is one task's work and is not shuffled at all; a
    # scenario that fits one is kept together, and merged, numbered and drawn for
    # after one shuffle. Lots of larger ones spread by ticker.
    if max_holdings <= ranking.LOTS_PER_SHELF:
        settled = lambda rows: rows.coalesce(1)
    elif max_lots <= ranking.LOTS_PER_SHELF:
        settled = lambda rows: rows.repartition("sim")
    else:
        settled = lambda rows: rows
    step = {"seed": spec.seed, "n_universe": F.lit(n_universe), "policy": spec.policy, "in_order": spec.in_order,
            "max_lots": max_lots, "max_holdings": max_holdings}

    # Within the run days are their indexes, kept as columns: each step then has
    # the plan of the one before, and its compiled code is used again.
    finished = _finished_blocks(spark, folder)
    at = finished[-1][1] + 1 if finished else 1
    while at < len(days):
        if not finished:
            lots = allocation.opening_lots(quotes, chosen, money=spec.money, day=days[0])
            holdings = settled(allocation.for_each_sim(lots, spec.n_sims).withColumns(
                {"entry_day": F.lit(0).cast("long"), "now": F.lit(1).cast("long")}))
        else:
            done = spark.read.schema(_STEP).parquet(_block_folder(folder, *finished[-1])).where(F.col("day_idx") == at - 1)
            holdings = allocation.merge_lots(settled(trading.lots_after(done)), "day_idx").withColumn(
                "now", F.col("day_idx") + 1)
        size = _block_size([n_quotes.get(day, 0) for day in days[at:at + spec.days_per_plan]], max_lots)
        block = days[at:at + size]
        n_rows = sum(n_quotes.get(day, 0) for day in block)
        if size == 1:
            clock = F.col("now")
            moves = trading.rebalance_moves(holdings, panel.prices_on_day(quotes, block[0]).drop("day", "day_idx"),
                                            day=clock, day_idx=clock, max_quotes=n_rows, **step)
        else:
            moves = _unrolled(holdings, panel.filter_by_date(quotes, block[0], block[-1]), size, max_quotes=n_rows, **step)
        finished.append((at, at + size - 1))
        moves.write.mode("overwrite").parquet(_block_folder(folder, *finished[-1]))
        at += size
    date = lambda index: F.element_at(F.lit(days), index.cast("int") + 1)
    return (spark.read.schema(_STEP).parquet(*[_block_folder(folder, *block) for block in finished])
            .withColumns({"day": date(F.col("day_idx")), "new_entry_day": date(F.col("new_entry_day"))})
            .select(*schema.MOVES.fieldNames()))


def _block_size(n_quotes: list[int], max_lots: int) -> int:
    """Days of the next block. Scenarios whose numbers do not fit a row, and days
    whose quotes cannot be broadcast, go one by one."""
    if max_lots > ranking.CHAIN_IN_ROW:
        return 1
    size = len(n_quotes)
    while size > 1 and sum(n_quotes[:size]) > session.BROADCAST_ROWS:
        size -= 1
    return size


def _unrolled(holdings: DataFrame, quotes: DataFrame, n_days: int, **step) -> DataFrame:
    """Steps of ``n_days`` days in one plan. A holding carries the moves that led to
    it; a move leads to one holding only, so in the end all of them are there once."""
    history, clock = T.ArrayType(_STEP), (F.max("day_idx") + 1)
    past = F.array_append("past", F.struct(*_STEP.fieldNames()))
    held = [*allocation.lot_sums("new_"), clock.alias("day_idx"), clock.alias("day"),
            F.flatten(F.collect_list(past)).alias("past")]
    owner = [F.col("sim"), F.col("new_ticker").alias("ticker")]
    a_day = trading.DayStep(quotes, keep=("past",), **step)
    rows = holdings.select("sim", "ticker", "entry_day", "entry_price", "units", F.col("now").alias("day_idx"),
                           F.col("now").alias("day"), F.array().cast(history).alias("past"))
    for _ in range(n_days - 1):
        rows = a_day(rows).groupBy(*owner).agg(*held)
    return a_day(rows).select(F.inline(past))


# -- going on with a run ------------------------------------------------------

def _block_folder(folder: str, first: int, last: int) -> str:
    return f"{folder}/moves/{first:06d}-{last:06d}"


def _finished_blocks(spark, folder: str) -> list[tuple[int, int]]:
    """Blocks (first and last day_idx) a run has written, as far as they follow
    each other from day 1; whatever else lies there is removed."""
    found = []
    for name in session.names_in(spark, f"{folder}/moves"):
        first, last = (int(part) for part in name.split("-"))
        if first == (found[-1][1] + 1 if found else 1) and session.is_there(spark, f"{folder}/moves/{name}"):
            found.append((first, last))
        else:
            session.remove_folder(spark, f"{folder}/moves/{name}")
    return found


def _fingerprint(quotes: DataFrame, chosen: DataFrame, pool: DataFrame | None, days: list, spec: Scenarios) -> str:
    """What a run's rows depend on, in one line."""
    def digest(rows: DataFrame) -> list:
        return list(rows.agg(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)"))).head())

    parts = [spec.n_sims, spec.money, spec.seed, type(spec.policy).__qualname__, spec.policy, spec.in_order,
             *digest(quotes), *digest(chosen), *(digest(pool) if pool is not None else ["all"]), len(days), days[0], days[-1],
             hashlib.sha256("".join(map(str, days)).encode()).hexdigest()]
    return "|".join(map(str, parts))


def _same_run(spark, folder: str, fingerprint: str) -> None:
    note = f"{folder}/run"
    if session.is_there(spark, note):
        if [row.value for row in spark.read.text(note).collect()] != [fingerprint]:
            raise ValueError(f"{folder} holds another run")
        return
    if session.names_in(spark, f"{folder}/moves") or session.names_in(spark, f"{folder}/quotes"):
        raise ValueError(f"{folder} holds other files")
    spark.createDataFrame([(fingerprint,)], "value string").coalesce(1).write.mode("overwrite").text(note)


# -- results ----------------------------------------------------------------

def scenario_totals(moves: DataFrame, calendar: DataFrame, n_sims: int,
                    carried: DataFrame | None = None) -> DataFrame:
    """(sim, day, total) for each day of ``calendar`` (see `panel.day_index`)
    after the first, days without any value included as 0. Holdings that do not
    trade on a day count as 0, or with ``carried`` (see `panel.carried_prices`) with
    their last usable price."""
    if carried is not None:
        last = carried.select(F.col("ticker").alias("new_ticker"), "day", F.col("price").alias("last_price"))
        moves = moves.join(last, ["new_ticker", "day"], "left").withColumn("new_price", F.coalesce("new_price", "last_price"))
    worth = moves.select(
        "sim", "day", (F.col("new_units") * F.coalesce("new_price", F.lit(0.0))).alias("total"))
    later = calendar.where(F.col("day_idx") >= 1)
    return (worth.unionByName(panel.zero_totals(later, n_sims))
            .groupBy("sim", "day").agg(F.sum("total").alias("total")))


def scenario_backtest(prices: DataFrame, chosen: DataFrame, spec: Scenarios) -> DataFrame:
    """Total portfolio value by scenario and day."""
    return scenario_totals(backtest_moves(prices, chosen, spec),
                           panel.day_index(prices.where(F.col("day").isNotNull())), spec.n_sims)


def scenario_snapshot(moves: DataFrame) -> DataFrame:
    """(sim, day, ticker, price, units) at the end of each day after the first,
    for holdings that trade that day. The moves carry the price already, so
    nothing is joined."""
    return (trading.lots_after(moves).where(F.col("price").isNotNull())
            .groupBy("sim", "day", "ticker")
            .agg(F.max("price").alias("price"), F.sum("units").alias("units")))


def trade_ledger(moves: DataFrame) -> DataFrame:
    """Two rows per executed sale: the SELL and the BUY it paid for."""
    money = F.col("units") * F.col("price")
    sides = F.array(
        F.struct(F.lit("SELL").alias("side"), F.col("ticker").alias("ticker"),
                 F.col("units").alias("units"), F.col("price").alias("price")),
        F.struct(F.lit("BUY").alias("side"), F.col("new_ticker").alias("ticker"),
                 F.col("new_units").alias("units"), F.col("new_price").alias("price")))
    return (moves.where(F.col("reason").isNotNull())
            .select("sim", "day", "reason", money.alias("money"), F.explode(sides).alias("trade"))
            .select("sim", "day", "trade.side", "trade.ticker", "trade.units", "trade.price",
                    "money", "reason"))
