"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from daypanel.llm import common


def _pairs(links: DataFrame) -> DataFrame:
    return links.filter("u <> v").distinct()


def _state(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for each node of the links (a, b), whose root is the
    smallest node that can be reached. Alternating large and small stars halve
    distances to the root, so a few rounds do; each is written out. Minima are
    combined before they are shuffled, so a node with a third of all links is no
    hot group. Links of a node with itself say nothing and are left out."""
    links = common.durable(_pairs(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))))
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("y")).select("x", F.least("x", "y").alias("m"))
        large = _pairs(both.filter("v > u").join(least, F.col("u") == F.col("x"))
                       .select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = common.durable(_pairs(small.unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))))
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
