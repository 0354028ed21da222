"""Reading the merged price table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daypanel import schema
from daypanel.functions import text
from daypanel.operators import panel


def read_prices_csv(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    """Headerless ``ticker,day,price,volume`` lines. ``strict`` stops at the
    first bad line, whichever columns are used; otherwise what cannot be read
    comes back as NULL."""
    rows = spark.read.schema("ticker string, day string, price string, volume string").csv(path)
    columns = {name: F.expr(f"try_cast(trim({name}) AS {kind})") for name, kind in (
        ("ticker", "string"), ("day", "date"), ("price", "double"), ("volume", "bigint"))}
    if not strict:
        return rows.select(*[c.alias(name) for name, c in columns.items()])
    complete = F.lit(True)
    for column in columns.values():
        complete = complete & column.isNotNull()
    message = F.concat(F.lit("unreadable line: "), F.concat_ws(",", *columns))
    return rows.select(*text.checked(columns, complete, message))


def read_prices(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The table as `writers.write_prices` stores it (Parquet, by year), from
    ``start`` to ``end`` where they are given.

    Only the files of the years between are opened. The same holds for
    `panel.filter_by_date` and `panel.prices_on_day` on this frame: the year stays
    below it under a name of its own, and ``day`` says so in its metadata."""
    stored = (spark.read.schema(T.StructType([*schema.PRICES.fields, T.StructField("year", T.IntegerType())]))
              .parquet(path).withColumnRenamed("year", panel.STORED_YEAR))
    rows = stored.select(*[F.col(name).alias(name, metadata={panel.STORED_YEAR: True}) if name == "day" else name
                           for name in schema.PRICES.fieldNames()])
    return panel.filter_by_date(rows, start, end)


def read_years(spark: SparkSession, path: str, years: list[int]) -> DataFrame:
    """Whole years of the stored table; no file of another one is opened."""
    return read_prices(spark, path).where(F.col(panel.STORED_YEAR).isin(years))


def prices_from_events(events: DataFrame) -> DataFrame:
    """Daily panel of a tick table: the day's last value per user is the price.

    Grouping is on the derived keys and ``max_by`` keeps fixed-width buffers,
    so a user with a third of all ticks shrinks to one row per day before the
    shuffle."""
    return (events
            .groupBy(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
                     F.to_date("ts").alias("day"))
            .agg(F.max_by("value", "ts").alias("last_value"),
                 F.count(F.lit(1)).alias("volume"))
            .select("ticker", "day",
                    (F.lit(50.0) + F.col("last_value") / 10).alias("price"), "volume"))
