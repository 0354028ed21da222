"""Reading holdings snapshots back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daypanel import schema
from daypanel.functions import text


def read_snapshot(spark: SparkSession, path: str, start=None, end=None, sims: list[int] | None = None) -> DataFrame:
    """Rows (`schema.SNAPSHOT`) as `writers.write_snapshot` stores them, from
    ``start`` to ``end`` and of the scenarios ``sims`` where they are given.

    Folders of other days are not opened, and of each file only the row groups that
    may hold one of the scenarios: files are sorted by it."""
    key = T.StructField("day_key", T.StringType())
    rows = spark.read.schema(T.StructType([*schema.SNAPSHOT.fields, key])).parquet(path)
    # yyyyMMdd sorts like the day.
    if start is not None:
        rows = rows.where(F.col("day_key") >= text.compact_day(F.lit(start).cast("date")))
    if end is not None:
        rows = rows.where(F.col("day_key") <= text.compact_day(F.lit(end).cast("date")))
    if sims is not None:
        rows = rows.where(F.col("sim").isin(sims))
    return rows.drop("day_key")
