"""Helpers the operators share."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def ship() -> None:
    """Let Python tasks run where this package is not installed."""
    cloudpickle.register_pickle_by_value(sys.modules["daypanel.llm"])


# An Arrow batch is held several times over outside the heap: as vectors that double
# as they grow, as the bytes to send, and in the Python worker. By rows alone (10,000)
# a batch of texts is as large as its texts, and executors keep what it took.
BATCH_BYTES = "4m"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python tasks in Arrow batches that end with the row that reaches
    BATCH_BYTES. This stays set, as frames run after their operator has returned; a
    session that names a value of its own keeps it. No result depends on it."""
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)


def durable(df: DataFrame) -> DataFrame:
    """The rows, written to the folder that ``spark.checkpoint.dir`` names and
    read from there from now on: lineage ends here, a lost executor costs
    nothing, and rows that several later steps read are worked out once. A
    folder of its own is used only where the session names none."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            base = tempfile.mkdtemp(prefix="daypanel-llm-")
        sc.setCheckpointDir(base)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str) -> Column:
    """A text, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def row_key(doc_id: str, text: str) -> Column:
    """32 bytes that name a row by its id and its text. Rows that agree in both
    share the key, and every result depends on nothing else of a row."""
    return F.unhex(F.sha2(F.concat_ws("\n", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
                                      whole(text)), 256))


def salt(n: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def salted_lookup(rows: DataFrame, key: str, spread: str, table: DataFrame, table_key: str,
                  salts: int = 64) -> DataFrame:
    """Left join of ``rows`` to ``table``, whose ``table_key`` is unique, where a
    third of the rows may ask for one key and others for none.

    Rows without a key ask for nothing. Of the others a hash of ``spread`` makes
    the salt; each (key, salt) asked for looks its row up once, and rows then join
    by both, so a key's rows are spread over ``salts`` groups. ``rows`` and
    ``table`` are read several times."""
    mark = "__salt"
    some = rows.filter(F.col(key).isNotNull()).withColumn(mark, salt(salts, spread))
    asked = some.select(F.col(key).alias("__asked"), F.col(mark).alias("__part")).distinct()
    found = asked.join(table, F.col("__asked") == F.col(table_key))
    columns = [*rows.columns, *table.columns]
    joined = some.join(found, (F.col(key) == F.col("__asked")) & (F.col(mark) == F.col("__part")), "left")
    nothing = rows.filter(F.col(key).isNull()).select("*", *[
        F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.columns])
    return joined.select(columns).unionByName(nothing)


def smallest_hashes(rows: DataFrame, n: int, *columns: str) -> DataFrame:
    """At most ``n`` rows, those with the smallest hashes of the columns: a sample
    that any rerun repeats. All but about twice as many are dropped where they
    are, so little of a large table meets in the final sort."""
    total = rows.count()
    if total > 4 * n:
        share = max(1, int(2 * n / total * (1 << 40)))
        rows = rows.filter(F.shiftrightunsigned(F.xxhash64(*columns), 24) < share)
    return rows.orderBy(F.when(F.xxhash64(*columns) < 0, 1).otherwise(0), F.xxhash64(*columns), *columns).limit(n)


def unused_name(df: DataFrame, label: str) -> str:
    """A column name that cannot clash with the caller's."""
    return f"__{label}_{uuid.uuid4().hex[:12]}"


def without_keys(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose row_key is not in the column ``key`` of ``keys``,
    with all their columns."""
    name = unused_name(docs, "key")
    dropped = keys.select(F.col("key").alias(name)).distinct()
    return docs.join(dropped, row_key(doc_id, text) == F.col(name), "left_anti")


def hex_digest(column: Column) -> Column:
    return F.lower(F.hex(column))
