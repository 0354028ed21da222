"""Tables behind the chart of totals by day, one line per scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daypanel import schema


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``sim,yyyy/MM/dd,total`` files; the first row is data."""
    return spark.read.schema(schema.RESULT_TEXT).csv(path)


def sim_chart_table(result: DataFrame) -> DataFrame:
    """SIM, DAY, TOTAL with a real date, sorted by day."""
    return (result.select(F.col("sim").alias("SIM"),
                          F.to_date("day", "yyyy/MM/dd").alias("DAY"),
                          F.col("total").alias("TOTAL"))
            .orderBy("DAY", "SIM"))


def sim_chart_tail(result: DataFrame, n: int = 5) -> DataFrame:
    """The last rows of the chart table: a top-n, not a full sort."""
    table = sim_chart_table(result)
    return table.orderBy(F.desc("DAY"), F.desc("SIM")).limit(n)
