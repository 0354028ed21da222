"""The registered queries as DuckDB SQL.

Written from the definitions, not from the Spark plans: candidates for a
replacement are listed scenario by scenario, and the days of a scenario are
walked by a recursive common table expression."""

from __future__ import annotations

# Fixed values shared with the catalog.
SEED = 7
N_SIMS = 30
N_TICKERS = 10
MONEY = "1000::DOUBLE"
DAY_ASKED = "DATE '2024-01-11'"
LATER_DAY_IDX = "least(10, (SELECT max(day_idx) FROM cal))"
LATER_DAY = f"(SELECT day FROM cal WHERE day_idx = {LATER_DAY_IDX})"
CUT_DAY = "DATE '2024-01-15'"

PANEL = """
p AS (
  SELECT 'U' || user_id AS ticker, CAST(ts AS DATE) AS day,
         50 + arg_max(value, ts) / 10 AS price, count(*) AS volume
  FROM events GROUP BY 1, 2),
ticks AS (
  SELECT 'U' || user_id AS ticker, CAST(ts AS DATE) AS day, value AS price, ts FROM events),
universe AS (SELECT DISTINCT ticker FROM p),
cal AS (
  SELECT day, row_number() OVER (ORDER BY day) - 1 AS day_idx
  FROM (SELECT DISTINCT day FROM p))"""

CHOSEN = f"""
chosen AS (
  SELECT ticker FROM universe
  ORDER BY md5('{SEED}|' || ticker), ticker LIMIT {N_TICKERS}),
sims AS (SELECT unnest(range(1, {N_SIMS} + 1))::BIGINT AS sim)"""

OPENING = f"""
opening AS (
  SELECT s.sim, p.ticker, p.day AS entry_day, p.price AS entry_price,
         {MONEY} / (SELECT count(*) FROM chosen) / p.price AS units
  FROM sims s CROSS JOIN chosen c JOIN p USING (ticker)
  WHERE p.day = (SELECT min(day) FROM p) AND p.price > 0)"""

WHOLE_MARKET = f"""
lots AS (
  SELECT 1::BIGINT AS sim, ticker, day AS entry_day, price AS entry_price,
         {MONEY} / (SELECT count(*) FROM universe) / price AS units
  FROM p WHERE day = (SELECT min(day) FROM p) AND price > 0),
today AS (SELECT ticker, price FROM p WHERE day = {LATER_DAY})"""

POSITIONS = """
positions AS (
  SELECT a.ticker, a.day - 7 AS entry_day, a.day, e.price AS entry_price, t.price
  FROM p a
  LEFT JOIN p e ON e.ticker = a.ticker AND e.day = a.day - 7
  LEFT JOIN p t ON t.ticker = a.ticker AND t.day = a.day)"""

STOP = {"code": "entry_price - 2::DOUBLE < price", "documented": "price < entry_price - 2::DOUBLE"}
PLATEAU = {"code": "entry_price + 0.1::DOUBLE < price",
           "documented": "abs(price - entry_price) <= 0.1::DOUBLE"}


def reason(mode: str) -> str:
    return (f"CASE WHEN {STOP[mode]} THEN 'STOP_LOSS' "
            f"WHEN {PLATEAU[mode]} THEN 'PLATEAU' END")


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n"


def hops(count: int) -> str:
    """From `drawn_moves` to `moved` when sales run one after another in hash
    order: the money of a sale follows its ticker into the next, later sale."""
    parts = ["hop0 AS (SELECT *, ticker AS seller, new_ticker AS spot FROM drawn_moves)"]
    for i in range(1, count + 1):
        parts.append(f"""
hop{i} AS (
  SELECT r.* REPLACE (coalesce(n.ticker, r.seller) AS seller,
                      coalesce(n.new_ticker, r.spot) AS spot)
  FROM hop{i - 1} r
  LEFT JOIN drawn_moves n ON r.reason IS NOT NULL AND n.reason IS NOT NULL
    AND n.sim = r.sim AND n.day_idx = r.day_idx AND n.ticker = r.spot
    AND md5(n.ticker) > md5(r.seller))""")
    parts.append(f"""
moved AS (
  SELECT r.sim, r.day_idx, r.day, r.ticker, r.units, r.price, r.reason, r.spot AS new_ticker,
         CASE WHEN r.reason IS NULL THEN r.new_price ELSE q.price END AS new_price,
         CASE WHEN r.reason IS NULL THEN r.new_units
              ELSE r.units * r.price / q.price END AS new_units,
         r.new_entry_day,
         CASE WHEN r.reason IS NULL THEN r.new_entry_price ELSE q.price END AS new_entry_price
  FROM hop{count} r LEFT JOIN p q ON q.ticker = r.spot AND q.day = r.day)""")
    return ",".join(parts)


def step_parts(held: str, mode: str, universe: str, in_order: bool = False) -> str:
    """CTEs from `held` (sim, day_idx, day, ticker, entry_day, entry_price,
    units; the state a day starts with) to `moved`, one row per holding."""
    if in_order:
        at_once = step_parts(held, mode, universe).replace("\nmoved AS", "\ndrawn_moves AS")
        return at_once + ",\n" + hops(N_TICKERS - 1)
    return f"""
h AS (
  SELECT s.*, q.price FROM {held} s
  LEFT JOIN p q ON q.ticker = s.ticker AND q.day = s.day AND q.price > 0),
decided AS (
  SELECT *, {reason(mode)} AS wish,
         CAST('0x' || substr(md5('{SEED}|' || sim || '|' || day_idx || '|' || ticker), 1, 8)
              AS BIGINT) AS draw
  FROM h),
traders AS (SELECT DISTINCT sim, day_idx, day FROM h),
unowned AS (
  SELECT t.sim, t.day_idx, t.day, u.ticker FROM traders t CROSS JOIN {universe} u
  WHERE NOT EXISTS (SELECT 1 FROM h
    WHERE h.sim = t.sim AND h.day_idx = t.day_idx AND h.ticker = u.ticker)),
pool AS (
  SELECT * FROM unowned
  UNION ALL
  SELECT t.sim, t.day_idx, t.day, u.ticker FROM traders t CROSS JOIN {universe} u
  WHERE NOT EXISTS (SELECT 1 FROM unowned o
    WHERE o.sim = t.sim AND o.day_idx = t.day_idx)),
cand AS (
  SELECT w.sim, w.day_idx, w.ticker, q.price,
         row_number() OVER (PARTITION BY w.sim, w.day_idx
                            ORDER BY md5(w.ticker), w.ticker) - 1 AS pos,
         count(*) OVER (PARTITION BY w.sim, w.day_idx) AS n
  FROM pool w JOIN p q ON q.ticker = w.ticker AND q.day = w.day AND q.price > 0),
moved AS (
  SELECT d.sim, d.day_idx, d.day, d.ticker, d.units, d.price,
         CASE WHEN c.ticker IS NOT NULL THEN d.wish END AS reason,
         coalesce(c.ticker, d.ticker) AS new_ticker,
         CASE WHEN c.ticker IS NULL THEN d.price ELSE c.price END AS new_price,
         CASE WHEN c.ticker IS NULL THEN d.units ELSE d.units * d.price / c.price END AS new_units,
         CASE WHEN c.ticker IS NULL THEN d.entry_day ELSE d.day END AS new_entry_day,
         CASE WHEN c.ticker IS NULL THEN d.entry_price ELSE c.price END AS new_entry_price
  FROM decided d
  LEFT JOIN cand c ON d.wish IS NOT NULL AND c.sim = d.sim AND c.day_idx = d.day_idx
    AND c.pos = d.draw % c.n)"""


MERGED = """
SELECT sim, day_idx, new_ticker AS ticker, max(new_entry_day) AS entry_day,
       arg_max(new_entry_price, new_entry_day) AS entry_price, sum(new_units) AS units
FROM moved GROUP BY sim, day_idx, new_ticker"""


def scenario(mode: str = "code", universe: str = "universe", in_order: bool = False) -> str:
    """CTEs up to `state` (holdings at the end of each day) and `moved`."""
    start = """SELECT s.sim, c.day_idx, c.day, s.ticker, s.entry_day, s.entry_price, s.units
    FROM state s JOIN cal c ON c.day_idx = s.day_idx + 1"""
    walk = f"""
state AS (
  SELECT sim, 0::BIGINT AS day_idx, ticker, entry_day, entry_price, units FROM opening
  UNION ALL
  (WITH started AS ({start}), {step_parts('started', mode, universe, in_order)}
  {MERGED}))"""
    return with_(PANEL, CHOSEN, OPENING, walk, f"\nstarted AS ({start})",
                 step_parts("started", mode, universe, in_order), recursive=True)


TOTALS = """
totals AS (
  SELECT z.sim, z.day, round(coalesce(v.total, 0), 4) AS total
  FROM (SELECT sim, day, day_idx FROM sims CROSS JOIN cal WHERE day_idx >= 1) z
  LEFT JOIN (
    SELECT s.sim, s.day_idx, sum(s.units * coalesce(q.price, 0)) AS total
    FROM state s JOIN cal c USING (day_idx)
    LEFT JOIN p q ON q.ticker = s.ticker AND q.day = c.day
    GROUP BY s.sim, s.day_idx) v USING (sim, day_idx))"""


def totals(mode: str = "code", universe: str = "universe", in_order: bool = False) -> str:
    return scenario(mode, universe, in_order).rstrip() + "," + TOTALS + "\n"


SAME_PANEL = with_(PANEL) + "SELECT ticker, day, price, volume FROM p"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    for same in ("scan_prices", "ingest_vendor_files"):
        sql[same] = SAME_PANEL
    sql["merge_prices"] = with_(PANEL) + f"""
SELECT ticker, day, price, volume FROM p
WHERE day <= {CUT_DAY}
UNION ALL
SELECT ticker, day, price, volume FROM p
WHERE day >= {CUT_DAY}"""
    sql["merge_prices_deduplicated"] = with_(PANEL) + (
        f"SELECT ticker, day, price + CASE WHEN day >= {CUT_DAY} THEN 0.5::DOUBLE ELSE 0 END AS price FROM p")
    both = """
WITH answers AS (
  SELECT 'doc-' || doc_id AS source_key, text AS payload FROM documents
  UNION ALL SELECT 'page-' || page_id, html FROM pages)
SELECT source_key, length(payload) AS n_chars FROM answers WHERE """
    sql["valid_payloads"] = both + "coalesce(NOT contains(payload, '{'), false)"
    sql["rejected_payloads"] = both + "coalesce(contains(payload, '{'), true)"
    sql["accepted_files"] = both.replace("SELECT source_key, length(payload) AS n_chars", """
SELECT source_key AS path, len(string_split(payload, chr(10))) AS n_lines""") + "NOT contains(payload, '{')"
    sql["ticker_list"] = with_(PANEL) + "SELECT ticker FROM universe"
    sql["scalar_formats"] = with_(PANEL) + """
SELECT ticker || ',' || strftime(day, '%Y-%m-%d') || ',' || volume AS line,
       ticker AS first_field, ticker AS from_path, ticker AS unquoted, day AS parsed_day,
       strftime(day, '%Y/%m/%d') AS slash_day, strftime(day, '%Y%m%d') AS compact_day,
       NOT contains(ticker || ',' || strftime(day, '%Y-%m-%d') || ',' || volume, '{') AS is_csv FROM p"""

    # Through files and back.
    cut = "day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
    sql["merged_vendor_folder"] = sql["merged_csv"] = SAME_PANEL
    sql["stored_prices_cut"] = SAME_PANEL + f" WHERE {cut}"
    sql["updated_prices"] = with_(PANEL) + (
        f"SELECT ticker, day, price + CASE WHEN day >= {CUT_DAY} THEN 0.5::DOUBLE ELSE 0 END AS price, volume FROM p")
    sql["accepted_prices"] = SAME_PANEL + " WHERE NOT ends_with(ticker, '7')"
    sql["quarantined_lines"] = with_(PANEL) + """
SELECT ticker, 'error message' AS reason, count(*) AS n_lines, '{ "Note": "call limit reached" }' AS line
FROM p WHERE ends_with(ticker, '7') GROUP BY ticker
UNION ALL SELECT ticker, 'unreadable line', 1, '2024-01-05,1,2' FROM universe WHERE ends_with(ticker, '3')"""
    sql["stored_snapshot"] = with_(PANEL, WHOLE_MARKET) + f"""
SELECT 2::BIGINT AS sim, q.day, q.ticker, q.price, round(l.units * CASE WHEN {cut.replace("day", "q.day")} THEN 2 ELSE 1 END, 4) AS units
FROM lots l JOIN p q USING (ticker) WHERE q.day <= DATE '2024-01-20'"""

    sql["filter_by_date"] = SAME_PANEL + " WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
    sql["filter_by_ticker"] = SAME_PANEL + " WHERE ticker = 'U3'"
    sql["prices_on_day"] = SAME_PANEL + f" WHERE day = {DAY_ASKED}"
    sql["trading_days"] = with_(PANEL) + "SELECT day FROM cal ORDER BY day"
    sql["day_index"] = with_(PANEL) + "SELECT day, day_idx FROM cal"
    sql["dedupe_keep_last"] = with_(PANEL) + (
        "SELECT ticker, day, arg_max(price, ts) AS price FROM ticks GROUP BY ticker, day")
    sql["dedupe_keep_first"] = with_(PANEL) + (
        "SELECT ticker, day, arg_min(price, ts) AS price FROM ticks GROUP BY ticker, day")
    sql["price_lookup"] = with_(PANEL) + """
SELECT a.ticker, a.day + 1 AS day, coalesce(b.price, 0) AS price, b.price IS NOT NULL AS found
FROM p a LEFT JOIN p b ON b.ticker = a.ticker AND b.day = a.day + 1"""
    sql["entry_vs_today"] = with_(PANEL, POSITIONS) + (
        "SELECT ticker, entry_day, day, entry_price, price FROM positions")
    sql["held_prices"] = with_(PANEL, CHOSEN, OPENING) + f"""
SELECT ticker, day, price FROM p
WHERE day = {LATER_DAY} AND ticker IN (SELECT ticker FROM opening)"""

    sql["sample_tickers"] = with_(PANEL, CHOSEN) + "SELECT ticker FROM chosen"
    sql["initial_allocation"] = with_(PANEL, CHOSEN, OPENING) + (
        "SELECT sim, ticker, entry_day, entry_price, round(units, 4) AS units FROM opening")
    sql["buy_and_hold"] = with_(PANEL, CHOSEN) + f"""
, offers AS (SELECT p.* FROM p JOIN chosen USING (ticker)),
bought AS (
  SELECT ticker, day AS entry_day, {MONEY} / (SELECT count(*) FROM chosen) / price AS units
  FROM offers WHERE day = (SELECT min(day) FROM offers) AND price > 0)
SELECT s.sim, o.day, o.ticker, o.price, round(b.units, 4) AS units
FROM sims s CROSS JOIN bought b JOIN offers o USING (ticker) WHERE o.day >= b.entry_day"""
    sql["portfolio_value"] = with_(PANEL, WHOLE_MARKET) + """
SELECT l.sim, c.day, round(sum(coalesce(l.units * q.price, 0)), 4) AS total
FROM lots l CROSS JOIN cal c LEFT JOIN p q ON q.ticker = l.ticker AND q.day = c.day
GROUP BY l.sim, c.day"""

    sql["carried_prices"] = with_(PANEL) + """
SELECT u.ticker, c.day, q.price, q.day AS quoted_day
FROM (universe u CROSS JOIN cal c) ASOF JOIN (SELECT * FROM p WHERE price > 0) q ON q.ticker = u.ticker AND q.day <= c.day"""
    sql["portfolio_value_carried"] = with_(PANEL, WHOLE_MARKET) + """
SELECT sim, day, round(sum(worth), 4) AS total FROM (
  SELECT l.sim, c.day, coalesce(l.units * q.price, 0) AS worth
  FROM (lots l CROSS JOIN cal c) ASOF LEFT JOIN (SELECT * FROM p WHERE price > 0) q
  ON q.ticker = l.ticker AND q.day <= c.day) GROUP BY sim, day"""
    sql["replaced_result"] = with_(PANEL, WHOLE_MARKET) + """
SELECT l.sim, strftime(c.day, '%Y/%m/%d') AS day, round(sum(coalesce(l.units * q.price, 0)), 4) AS total
FROM lots l CROSS JOIN cal c LEFT JOIN p q ON q.ticker = l.ticker AND q.day = c.day
GROUP BY l.sim, c.day"""

    sql["holdings_snapshot"] = with_(PANEL, WHOLE_MARKET) + """
SELECT l.sim, q.day, q.ticker, q.price, round(l.units, 4) AS units
FROM lots l JOIN p q USING (ticker)"""

    for name, column, rule in (("stop_loss_signal", "stop_loss", STOP),
                               ("gain_plateau_signal", "plateau", PLATEAU)):
        sql[name] = with_(PANEL, POSITIONS) + f"""
SELECT ticker, entry_day, day, entry_price, price,
       coalesce({rule['code']}, false) AS {column},
       coalesce({rule['documented']}, false) AS {column}_documented FROM positions"""
    for name, mode in (("sell_decisions", "code"), ("sell_decisions_documented", "documented")):
        sql[name] = with_(PANEL, WHOLE_MARKET) + f"""
SELECT sim, ticker, entry_price, price, {reason(mode)} AS reason
FROM lots LEFT JOIN today USING (ticker)"""
    sql["sell_proceeds"] = with_(PANEL, WHOLE_MARKET) + """
SELECT sim, ticker, price, round(units, 4) AS units, round(price * units, 4) AS proceeds
FROM lots JOIN today USING (ticker)"""
    sql["buy_units"] = with_(PANEL, CHOSEN, OPENING) + f"""
SELECT 1::BIGINT AS sim, u.ticker,
       round(CASE WHEN q.price IS NULL THEN 0
             ELSE coalesce(o.units, 0) + 500::DOUBLE / q.price END, 4) AS units
FROM universe u
LEFT JOIN p q ON q.ticker = u.ticker AND q.day = {LATER_DAY}
LEFT JOIN opening o ON o.ticker = u.ticker AND o.sim = 1"""
    sql["merge_lots"] = with_(PANEL) + """
SELECT 1::BIGINT AS sim, ticker, max(day) AS entry_day, arg_max(price, day) AS entry_price,
       sum(volume)::DOUBLE AS units FROM p GROUP BY ticker"""
    owned = "(SELECT ticker FROM opening WHERE sim = 1)"
    sql["unowned_tickers"] = with_(PANEL, CHOSEN, OPENING) + (
        f"SELECT ticker FROM universe WHERE ticker NOT IN {owned}")
    sql["tradable_candidates"] = with_(PANEL, CHOSEN, OPENING) + f"""
SELECT ticker, price FROM p
WHERE day = {LATER_DAY} AND price > 0
  AND (ticker NOT IN {owned}
       OR (SELECT count(*) FROM universe WHERE ticker NOT IN {owned}) = 0)"""

    on_later_day = f"""
started AS (
  SELECT sim, ({LATER_DAY_IDX})::BIGINT AS day_idx, {LATER_DAY} AS day, ticker, entry_day,
         entry_price, units FROM opening)"""
    one_day = with_(PANEL, CHOSEN, OPENING, on_later_day, step_parts("started", "code", "universe"))
    sql["pick_replacement"] = one_day + """
SELECT d.sim, d.ticker, c.ticker AS replacement, c.price
FROM decided d JOIN cand c ON c.sim = d.sim AND c.pos = d.draw % c.n"""
    whole_market = f"""
started AS (
  SELECT sim, ({LATER_DAY_IDX})::BIGINT AS day_idx, {LATER_DAY} AS day, ticker, entry_day,
         entry_price, units FROM lots)"""
    sql["pick_replacement_whole_market"] = with_(
        PANEL, WHOLE_MARKET, whole_market, step_parts("started", "code", "universe")) + """
SELECT d.sim, d.ticker, c.ticker AS replacement, c.price
FROM decided d JOIN cand c ON c.sim = d.sim AND c.pos = d.draw % c.n
WHERE d.price IS NOT NULL"""
    sql["rebalance_step"] = one_day + f"""
SELECT sim, ticker, entry_day, entry_price, round(units, 4) AS units FROM ({MERGED})"""

    shown = "SELECT sim, day, total FROM totals"
    sql["scenario_backtest"] = sql["scenario_backtest_stepped"] = totals() + shown
    sql["scenario_backtest_sampled_universe"] = totals(universe="chosen") + shown
    sql["scenario_backtest_in_order"] = totals(universe="chosen", in_order=True) + shown
    sql["scenario_backtest_documented"] = totals("documented") + shown
    carried = TOTALS.replace("LEFT JOIN p q ON q.ticker = s.ticker AND q.day = c.day",
                             "ASOF LEFT JOIN (SELECT * FROM p WHERE price > 0) q ON q.ticker = s.ticker AND q.day <= c.day")
    sql["scenario_backtest_carried"] = scenario().rstrip() + "," + carried + "\n" + shown
    sql["trade_ledger"] = scenario() + """
SELECT sim, day, 'SELL' AS side, ticker, price, reason, round(units, 4) AS units,
       round(units * price, 4) AS money FROM moved WHERE reason IS NOT NULL
UNION ALL
SELECT sim, day, 'BUY', new_ticker, new_price, reason, round(new_units, 4),
       round(units * price, 4) FROM moved WHERE reason IS NOT NULL"""
    sql["scenario_snapshot"] = scenario() + """
SELECT s.sim, c.day, s.ticker, q.price, round(s.units, 4) AS units
FROM state s JOIN cal c USING (day_idx) JOIN p q ON q.ticker = s.ticker AND q.day = c.day
WHERE s.day_idx >= 1"""
    sql["sim_output_lines"] = totals() + (
        "SELECT sim, strftime(day, '%Y/%m/%d') AS day, total FROM totals")
    chart = 'SELECT sim AS "SIM", day AS "DAY", total AS "TOTAL" FROM totals '
    sql["sim_chart_table"] = totals() + chart + "ORDER BY day, sim"
    sql["sim_chart_tail"] = totals() + chart + "ORDER BY day DESC, sim DESC LIMIT 5"
    return sql
