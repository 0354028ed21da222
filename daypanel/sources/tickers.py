"""Reading the ticker list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daypanel.functions import text


def read_ticker_list(spark: SparkSession, path: str) -> DataFrame:
    """First field of a quoted CSV with a header line."""
    rows = (spark.read.schema("ticker string, name string").option("header", True)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True).csv(path))
    return rows.select(text.unquoted(F.col("ticker")).alias("ticker"))


def ticker_list(lines: DataFrame) -> DataFrame:
    """The same from a table of (line_no, line); line 0 is the header."""
    return (lines.where(F.col("line_no") > 0)
            .select(text.unquoted(text.field(F.col("line"), 0)).alias("ticker")))
