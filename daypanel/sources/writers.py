"""Writing price tables, scenario results and holdings snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daypanel import schema
from daypanel.functions import text
from daypanel.operators import panel
from daypanel.session import durable, is_there, many_files, remove_folder, run_folder
from daypanel.sources import prices, vendor


def write_prices(rows: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Parquet by year. The rebalance hint lets adaptive execution split a
    crowded year over several files and join thin ones. Besides Spark's own modes,
    "replace" replaces the years among the rows and leaves all others."""
    (_replacing(rows.select(*schema.PRICES.fieldNames(), F.year("day").alias("year")).hint("rebalance", "year"), mode)
     .partitionBy("year").parquet(path))


def _replacing(rows: DataFrame, mode: str):
    """A writer; "replace" overwrites just the partitions there are rows for."""
    if mode != "replace":
        return rows.write.mode(mode)
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


# An update is first written beside the years it will replace, and only then put
# in their place. A run that is lost between leaves this folder, finished; the
# next one starts by putting it in place, which may be done any number of times.
_UPDATE = "_update"


def update_prices(spark: SparkSession, path: str, update: DataFrame) -> None:
    """Put rows into a stored table by (ticker, day): a key's rows of the table
    give way to the row of ``update``, all others stay. Only the years ``update``
    touches are read and written; files of other years are left alone.

    ``update`` needs a ticker and a day in each row and no key twice (see
    `panel.dedupe_keep_last`). What a lost run left unfinished is finished first."""
    staged = f"{path.rstrip('/')}/{_UPDATE}"
    _finish_update(spark, path, staged)
    rows = durable(update.select(*schema.PRICES.fieldNames()))
    if rows.where(F.col("ticker").isNull() | F.col("day").isNull()).limit(1).count():
        raise ValueError("an update needs a ticker and a day in each row")
    twice = rows.groupBy("ticker", "day").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two rows for {twice[0].ticker} on {twice[0].day}; panel.dedupe_keep_last keeps one")
    years = sorted(row.year for row in rows.select(F.year("day").alias("year")).distinct().collect())
    if not years:
        return
    touched = prices.read_years(spark, path, years)
    kept = touched.join(rows.select("ticker", "day"), ["ticker", "day"], "left_anti")
    write_prices(kept.unionByName(rows), staged, mode="overwrite")
    _finish_update(spark, path, staged)


def _finish_update(spark: SparkSession, path: str, staged: str) -> None:
    if is_there(spark, staged):
        write_prices(prices.read_prices(spark, staged), path, mode="replace")
    remove_folder(spark, staged)


def write_prices_csv(rows: DataFrame, path: str, *, mode: str = "errorifexists",
                     single_file: bool = False) -> None:
    """Headerless ``ticker,day,price,volume``. ``single_file`` funnels the
    output through one task; it is for hand-over of small tables only."""
    rows = rows.select(*schema.PRICES.fieldNames())
    (rows.repartition(1) if single_file else rows).write.mode(mode).csv(path)


def merge_vendor_folder(spark: SparkSession, folder: str, target: str, *, strict: bool = True,
                        duplicates: str | None = None, quarantine: str | None = None, update: bool = False) -> None:
    """Build the merged price table from a vendor folder, unless it is there; an
    unfinished one is replaced. ``duplicates``: "last" or "first" keeps one row
    per (ticker, day), by their order in the file; None keeps all. ``update`` puts
    the folder's rows into a finished table by (ticker, day) instead of leaving it.

    The folder is read once. ``quarantine`` names a folder for what was left out:
    the path, the reason and the line (see `vendor.quarantined`)."""
    there = is_there(spark, target)
    if there and not update:
        return
    stage = run_folder(spark, "vendor-lines")
    try:
        with many_files(spark):
            vendor.read_tagged_lines(spark, folder).write.parquet(stage)
        lines = spark.read.parquet(stage)
        files = durable(vendor.file_verdicts(lines))
        n_files = files.count()
        rows = vendor.accepted_prices(lines, files, strict=strict, max_files=n_files)
        if duplicates is not None:
            keep = {"last": panel.dedupe_keep_last, "first": panel.dedupe_keep_first}[duplicates]
            one = keep(rows.withColumn("row", F.struct("price", "volume")), "source_order", "row")
            rows = one.select("ticker", "day", "row.price", "row.volume")
        if quarantine is not None:
            vendor.quarantined(lines, files, max_files=n_files).write.mode("overwrite").parquet(quarantine)
        if there:
            update_prices(spark, target, rows)
        else:
            write_prices(rows, target, mode="overwrite")
    finally:
        remove_folder(spark, stage)


# Writing a ticker's few lines costs a task more than the lines do: tasks are cut by
# files, not by bytes.
FILES_PER_TASK = 250
LINES_PER_FILE = 1_000_000


def write_vendor_folder(rows: DataFrame, folder: str) -> None:
    """Vendor files of a price table: ``ticker=<ticker>/``, one or more CSV files
    with a header and the nine columns a vendor sends. A ticker of many rows is
    several files, written by several tasks."""
    unused = F.lit("0")
    cells = {0: F.date_format("day", "yyyy-MM-dd"), 5: F.col("price").cast("string"), 6: F.col("volume").cast("string")}
    lines = rows.select("ticker", *[cells.get(i, unused).alias(name) for i, name in enumerate(schema.VENDOR_HEADER)])
    by_ticker(lines).write.partitionBy("ticker").option("header", True).csv(folder)


def by_ticker(lines: DataFrame, *, lines_per_file: int = LINES_PER_FILE) -> DataFrame:
    """Lines laid out for a write by ticker: a ticker's lines in one task, or, of more
    than ``lines_per_file``, spread over as many as they fill; and no task has many
    more than `FILES_PER_TASK` files. The lines are stored first."""
    lines = durable(lines)
    parts = F.ceil(F.count(F.lit(1)) / lines_per_file)
    files = lines.groupBy("ticker").agg(parts.alias("__parts"))
    n_files = files.agg(F.sum("__parts")).first()[0] or 0
    n_tasks = max(lines.sparkSession.sparkContext.defaultParallelism, -(-n_files // FILES_PER_TASK))
    long = files.where(F.col("__parts") > 1)  # few: each stands for many lines
    part = F.coalesce(F.pmod(F.xxhash64(*[c for c in lines.columns if c != "ticker"]), "__parts"), F.lit(0).cast("long"))
    return (lines.join(long, "ticker", "left").withColumn("__part", part)
            .repartition(n_tasks, "ticker", "__part").select(*lines.columns))


def result_lines(totals: DataFrame) -> DataFrame:
    """(sim, day as yyyy/MM/dd, total)."""
    return totals.select("sim", text.slash_day(F.col("day")).alias("day"), "total")


def write_result(totals: DataFrame, path: str) -> None:
    """Replace the scenario result at ``path``."""
    result_lines(totals).write.mode("overwrite").csv(path)


def write_snapshot(snapshot: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Holdings under ``day_key=<yyyyMMdd>``, in one job. The scenario is a
    column, and files are sorted by it, so one scenario reads few row groups.
    "replace" replaces the days among the rows and leaves all others: what a
    retried or continued run writes again."""
    rows = (snapshot.select(*schema.SNAPSHOT.fieldNames(), text.compact_day(F.col("day")).alias("day_key"))
            .hint("rebalance", "day_key").sortWithinPartitions("day_key", "sim"))
    _replacing(rows, mode).partitionBy("day_key").parquet(path)
