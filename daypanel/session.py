"""Facts taken from the running session: where shared files go, and which
frames are small enough to broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows, not bytes: every frame this is asked about has at most 8 narrow columns
# (well under 200 bytes a row), so the limit keeps a broadcast below 100 MB.
BROADCAST_ROWS = 500_000


def broadcast_if_bounded(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Hint a broadcast only under a proven row bound; otherwise leave the join
    strategy to the planner."""
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def lookup(rows: DataFrame, table: DataFrame, key: str | list[str], *, max_rows: int | None = None,
           max_table: int | None = None) -> DataFrame:
    """Left join of ``rows`` to ``table`` on ``key``, unique in ``table``.

    A row bound, where the caller can prove one, picks the way: a small table
    is broadcast; a large table is first cut down in place to the keys of a
    small ``rows``, which are broadcast; with neither, both sides shuffle."""
    if max_table is not None and max_table <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), key, "left")
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        wanted = F.broadcast(rows.select(key).distinct())
        return rows.join(F.broadcast(table.join(wanted, key, "left_semi")), key, "left")
    return rows.join(table, key, "left")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder on the storage every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``. A private
    temporary folder is used only by a local master that names none."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="daypanel-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """The rows, written to the checkpoint folder and read from there: later
    steps neither repeat what led to them nor depend on the executors that did
    it. Spark removes the files with the frame where its cleaner is set to."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(run_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


# What opening a file counts for when files are put together for a task. At Spark's own
# 4 MB a task opens 32 files, and a folder of a few lines a file takes more time for
# starting tasks than for reading.
OPEN_COST = "256k"


@contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """Small files read in this block, hundreds to a task; large ones are split as ever."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_COST)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _hadoop(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    files, path = _hadoop(spark, folder)
    files.delete(path, True)


def is_there(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` has finished: its success marker is there."""
    files, path = _hadoop(spark, f"{folder.rstrip('/')}/_SUCCESS")
    return files.exists(path)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, sorted; nothing if it is not there."""
    files, path = _hadoop(spark, folder)
    return sorted(status.getPath().getName() for status in files.listStatus(path)) if files.exists(path) else []
