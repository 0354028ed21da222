"""Column layouts and default parameters shared by every operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

PRICES = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

# A vendor file is addressed by position: 0 = day, 5 = adjusted price,
# 6 = volume. Everything else is carried only so that positions line up.
VENDOR_WIDTH = 9
VENDOR_HEADER = ("timestamp", "open", "high", "low", "close", "adjusted_close", "volume", "dividend_amount",
                 "split_coefficient")
VENDOR_LINES = T.StructType(
    [T.StructField(f"c{i}", T.StringType()) for i in range(VENDOR_WIDTH)])

HOLDINGS = T.StructType([
    T.StructField("sim", T.LongType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("entry_day", T.DateType()),
    T.StructField("entry_price", T.DoubleType()),
    T.StructField("units", T.DoubleType()),
])

# One row per lot held at the start of a day. `reason` is set when the lot was
# sold; the new_* columns say what the money sits in after that day's trading.
MOVES = T.StructType([
    T.StructField("sim", T.LongType()),
    T.StructField("day_idx", T.LongType()),
    T.StructField("day", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("units", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("reason", T.StringType()),
    T.StructField("new_ticker", T.StringType()),
    T.StructField("new_price", T.DoubleType()),
    T.StructField("new_units", T.DoubleType()),
    T.StructField("new_entry_day", T.DateType()),
    T.StructField("new_entry_price", T.DoubleType()),
])

SNAPSHOT = T.StructType([
    T.StructField("sim", T.LongType()),
    T.StructField("day", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("units", T.DoubleType()),
])

RESULT_TEXT = T.StructType([
    T.StructField("sim", T.LongType()),
    T.StructField("day", T.StringType()),
    T.StructField("total", T.DoubleType()),
])

# The default job parameters.
N_SIMS = 30
MONEY = 1000.0
N_TICKERS = 10
RANGE_START = dt.date(2018, 3, 1)
RANGE_END = dt.date(2018, 3, 31)
STOP_LOSS_DELTA = 2.0
PLATEAU_DELTA = 0.1
