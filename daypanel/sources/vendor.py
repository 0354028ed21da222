"""Reading a folder of per-ticker vendor files (``<ticker>.csv``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F

from daypanel import schema
from daypanel.functions import text
from daypanel.session import broadcast_if_bounded


def _file_path() -> Column:
    """The path as the folder lists it; the metadata column percent-encodes."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _files(spark: SparkSession) -> DataFrameReader:
    """All files of a folder and of the folders in it, whatever these are called:
    left to find partitions, the reader would pass over files beside them."""
    return spark.read.option("recursiveFileLookup", True)


def vendor_file(path: Column) -> Column:
    """The vendor file a stored file belongs to: itself, or the folder
    ``ticker=...`` that holds a ticker's parts."""
    return F.regexp_replace(path, "(/ticker=[^/]*)/[^/]*$", "$1")


def _source_order() -> Column:
    """A file's blocks are read by one task each, and its lines in order."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("line")).alias("source_order")


def read_vendor_folder(spark: SparkSession, folder: str, *, ordered: bool = False) -> DataFrame:
    """Rows of all files as (path, c0..c8) strings, header lines dropped;
    ``ordered`` adds source_order, which grows with the place in the file.

    Files are read as splittable CSV, so one very long history is shared by
    many tasks; no file is ever held as a single value."""
    return (_files(spark).schema(schema.VENDOR_LINES).option("header", True).csv(folder)
            .select(vendor_file(_file_path()).alias("path"), *schema.VENDOR_LINES.fieldNames(),
                    *([_source_order()] if ordered else [])))


def vendor_rows(lines: DataFrame) -> DataFrame:
    """The same layout from a table of (path, line_no, line); line 0 is the
    header of its file."""
    cells = [text.field(F.col("line"), i).alias(f"c{i}") for i in range(schema.VENDOR_WIDTH)]
    return lines.where(F.col("line_no") > 0).select("path", *cells)


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*",
        F.expr("try_cast(trim(c0) AS date)").alias("day"),
        F.expr("try_cast(c5 AS double)").alias("price"),
        F.expr("try_cast(c6 AS bigint)").alias("volume"))


def _complete() -> Column:
    return F.col("day").isNotNull() & F.col("price").isNotNull() & F.col("volume").isNotNull()


def to_prices(rows: DataFrame, *, strict: bool = True) -> DataFrame:
    """Project vendor rows to the price table. ``strict`` fails the job on a
    short or unreadable line; otherwise such lines are left to
    `malformed_rows`."""
    kept = [c for c in rows.columns if c == "source_order"]
    typed = _typed(rows)
    columns = {"ticker": text.ticker_from_path(F.col("path")),
               **{name: F.col(name) for name in ("day", "price", "volume")}}
    if strict:
        message = F.concat(F.lit("unreadable line in "), F.col("path"))
        return typed.select(*text.checked(columns, _complete(), message), *kept)
    return typed.where(_complete()).select(*[c.alias(name) for name, c in columns.items()], *kept)


def malformed_rows(rows: DataFrame) -> DataFrame:
    """The lines `to_prices(strict=False)` leaves out."""
    return _typed(rows).where(~_complete()).select(*rows.columns)


def read_payload_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lines with the file they came from, for checks on whole files."""
    return _files(spark).text(folder).select(
        vendor_file(_file_path()).alias("path"), F.col("value").alias("line"))


# -- one reading for rows and rejects -----------------------------------------
#
# What a file is worth shows only when its last line has been seen. So lines are
# read, parsed and stored once; verdicts on files come from there, and so do the
# rows of the files that pass and the lines of those that do not.

ERROR_MESSAGE, UNREADABLE = "error message", "unreadable line"


def read_tagged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of a vendor folder, parsed: (file, block, line_id, day, price,
    volume, brace, line). Lines of a block come in the order of ``line_id``;
    ``line`` is kept where it holds a brace or cannot be read. Store this before
    it is used more than once."""
    lines = (_files(spark).text(folder).where(F.trim("value") != "")
             .select(_file_path().alias("file"), _source_order(), F.col("value").alias("line")))
    cells = [text.field(F.col("line"), i).alias(f"c{i}") for i in range(schema.VENDOR_WIDTH)]
    brace = ~text.is_csv_payload(F.col("line"))
    return (_typed(lines.select("file", "source_order", "line", *cells))
            .select("file", "source_order.block", F.col("source_order.line").alias("line_id"), "day", "price", "volume",
                    brace.alias("brace"), F.when(brace | ~_complete(), F.col("line")).alias("line")))


def file_verdicts(lines: DataFrame) -> DataFrame:
    """A row for each stored file: (file, path, header, rejected, n_lines).
    ``header`` is the line_id of its first line, ``n_lines`` counts those below it; a
    brace in any file of a vendor file rejects them all."""
    files = lines.groupBy("file").agg(
        F.min(F.when(F.col("block") == 0, F.col("line_id"))).alias("header"),
        F.max("brace").alias("brace"), (F.count(F.lit(1)) - 1).alias("n_lines"))
    return files.select("file", vendor_file(F.col("file")).alias("path"), "header", "brace", "n_lines").withColumn(
        "rejected", F.max("brace").over(Window.partitionBy("path"))).drop("brace")


def _judged(lines: DataFrame, files: DataFrame, max_files: int | None) -> DataFrame:
    """Lines without the header, with their file's verdict."""
    verdicts = broadcast_if_bounded(files.select("file", "path", "header", "rejected"), max_files)
    return lines.join(verdicts, "file").where((F.col("block") != 0) | (F.col("line_id") != F.col("header")))


def accepted_prices(lines: DataFrame, files: DataFrame, *, strict: bool = True, max_files: int | None = None) -> DataFrame:
    """The price table of the files that pass, with the ``source_order`` of its
    rows. ``strict`` as in `to_prices`; ``max_files`` is a proven bound."""
    rows = _judged(lines, files, max_files).where(~F.col("rejected"))
    order = F.struct("file", "block", F.col("line_id").alias("line")).alias("source_order")
    columns = {"ticker": text.ticker_from_path(F.col("path")),
               **{name: F.col(name) for name in ("day", "price", "volume")}}
    if strict:
        message = F.concat(F.lit("unreadable line in "), F.col("path"))
        return rows.select(*text.checked(columns, _complete(), message), order)
    return rows.where(_complete()).select(*[c.alias(name) for name, c in columns.items()], order)


def quarantined(lines: DataFrame, files: DataFrame, *, max_files: int | None = None) -> DataFrame:
    """What did not pass, as (path, reason, n_lines, line): each vendor file with a
    brace, its number of lines below headers and the first one that holds a brace;
    and each unreadable line of the other files."""
    sizes = files.where("rejected").groupBy("path").agg(F.sum("n_lines").alias("n_lines"))
    first = (lines.where("brace").groupBy(vendor_file(F.col("file")).alias("path"))
             .agg(F.min_by("line", F.struct("file", "block", "line_id")).alias("line")))
    whole = sizes.join(first, "path").select("path", F.lit(ERROR_MESSAGE).alias("reason"), "n_lines", "line")
    single = (_judged(lines.where(~_complete()), files, max_files).where(~F.col("rejected"))
              .select("path", F.lit(UNREADABLE).alias("reason"), F.lit(1).cast("long").alias("n_lines"), "line"))
    return whole.unionByName(single)


def rejected_files(lines: DataFrame) -> DataFrame:
    """Paths of files with a brace anywhere: error messages, not data."""
    return lines.where(~text.is_csv_payload(F.col("line"))).select("path").distinct()


def without_rejected(rows: DataFrame, rejected: DataFrame, *,
                     max_rejected: int | None = None) -> DataFrame:
    """Rows of the files that passed the check. With a proven bound on the
    rejected files the rows stay where they are; otherwise the planner decides."""
    return rows.join(broadcast_if_bounded(rejected, max_rejected), "path", "left_anti")


def valid_payloads(payloads: DataFrame) -> DataFrame:
    """Answers held one per row in ``payload``: the usable ones."""
    return payloads.where(text.is_csv_payload(F.col("payload")))


def rejected_payloads(payloads: DataFrame) -> DataFrame:
    """... and the quarantined ones."""
    return payloads.where(~text.is_csv_payload(F.col("payload")))


def merge_prices(*parts: DataFrame, order: str | None = None) -> DataFrame:
    """Bag union of price tables: no row is dropped, no order is promised.
    ``order`` names a column for the number of the part a row came from, by
    which `panel.dedupe_keep_last` and `dedupe_keep_first` can choose."""
    if order is not None:
        parts = tuple(part.withColumn(order, F.lit(i)) for i, part in enumerate(parts))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
