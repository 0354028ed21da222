"""Documents through the operators of daypanel.llm, one stage after another.

Each stage reads all that the one before it kept; what it decides takes effect.
Stages are written as Parquet in the folder that ``spark.checkpoint.dir`` names
and read again, so each starts from files that every executor can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daypanel.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from daypanel.session import remove_folder, run_folder


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, rejects go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest stays."""
    return exact_dedup.keep_best(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return simhash.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a benchmark passage makes up a twentieth or more go."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [("toxicity", toxic), ("exact dedup", exact), ("simhash near-dedup", near),
          ("benchmark decontamination", benchmark), ("best-fit packing", pack)]

# Tokenising, packing and learned scores have no SQL form; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one. A stage's files go
    when the next one has read them; those of the last stay, for the result."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES):
        folder = run_folder(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        if before is not None:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return docs
