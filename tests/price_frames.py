"""Small frames of prices, holdings and tickers."""

import datetime as dt

from daypanel import schema


def day(number: int) -> dt.date:
    """Day `number` of the fixture month."""
    return dt.date(2018, 3, number)


def price_frame(spark, cells):
    """cells: (ticker, day number, price)."""
    rows = [(t, day(d), float(p), 1) for t, d, p in cells]
    return spark.createDataFrame(rows, schema.PRICES)


def holding_frame(spark, cells):
    """cells: (sim, ticker, entry day number, entry price, units)."""
    rows = [(s, t, day(d), float(p), float(u)) for s, t, d, p, u in cells]
    return spark.createDataFrame(rows, schema.HOLDINGS)


def ticker_frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "ticker string")
