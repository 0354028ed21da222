"""Exact duplicates by skew-safe combining.

Texts are equal when they agree after every character of ``[\\x20\\x09-\\x0D]``
is deleted. Three stages find each group's best row, and the whole normalised
text is part of the grouping key in each of them, so texts that merely share a
digest never merge:

1. locally: the partial aggregation of a task leaves one row per text and salt;
2. salted: rows meet by (digest, salt), the salt being a hash of the row's id,
   so copies of a text that makes up a third of the corpus spread evenly;
3. globally: the at most ``salts`` winners of a text meet by digest.

Rows that agree in id, text and code points cannot be told apart and travel as a
count: they look their salted group up by (digest, salt), which is as even as
stage 2, and come back as so many rows, of which one stays. Only where two texts
share a digest - which is checked on the finished groups - does that lookup compare
texts as well."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from daypanel.llm import common

SALTS = 64
WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    for character in WHITE_SPACE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


# A row's rank as one fixed-width number, so that the aggregation stays in
# Tungsten's hash map: code points first, then the smaller id, a null id last.
_ID_SPAN = "36893488147419103232"  # 2^65


def _rank(points: Column, doc_id: Column) -> Column:
    span = F.lit(_ID_SPAN).cast("decimal(20,0)")
    from_top = F.lit("9223372036854775808").cast("decimal(20,0)") - doc_id.cast("decimal(20,0)")
    return (points.cast("decimal(10,0)") * span
            + F.coalesce(from_top, F.lit(0).cast("decimal(20,0)"))).cast("decimal(38,0)")


def _ranked_id(rank: Column) -> Column:
    from_top = rank % F.lit(_ID_SPAN).cast("decimal(20,0)")
    return F.when(from_top > 0, (F.lit("9223372036854775808").cast("decimal(20,0)")
                                 - from_top).cast("long"))


def _ranked_points(rank: Column) -> Column:
    return F.floor(rank / F.lit(_ID_SPAN).cast("decimal(20,0)")).cast("int")


def _counted(docs: DataFrame, doc_id: str, text: str, salts: int, digest: Callable[[Column], Column]) -> DataFrame:
    """Distinct (doc_id, points, digest) with ``n``, the number of rows, keep_id,
    group_size, and whether they are the ``best`` of their group."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.whole(text).alias("text"))
    rows = rows.select("doc_id", F.length("text").alias("points"), normalised(F.col("text")).alias("norm"),
                       F.coalesce(common.salt(salts, "doc_id"), F.lit(0)).alias("salt"))
    rows = rows.withColumn("digest", digest(F.col("norm")))

    # 1 and 2: combined in the task, then by digest and salt.
    salted = (rows.groupBy("digest", "salt", "norm")
              .agg(F.max(_rank(F.col("points"), F.col("doc_id"))).alias("rank"), F.count("*").alias("size")))
    # 3: the winners of the salts; at most `salts` rows of a text.
    same_text, same_digest = Window.partitionBy("digest", "norm"), Window.partitionBy("digest")
    groups = (salted.repartition("digest")
              .withColumn("rank", F.max("rank").over(same_text))
              .withColumn("size", F.sum("size").over(same_text))
              .withColumn("shared", F.min("norm").over(same_digest) != F.max("norm").over(same_digest)))
    groups = common.durable(groups.select(
        F.col("digest").alias("g_digest"), F.col("salt").alias("g_salt"),
        F.when(F.col("shared"), F.col("norm")).alias("g_norm"), _ranked_id(F.col("rank")).alias("keep_id"),
        _ranked_points(F.col("rank")).alias("keep_points"), F.col("size").alias("group_size")))

    found = (F.col("digest") == F.col("g_digest")) & (F.col("salt") == F.col("g_salt"))
    alike = ["digest", "salt", "doc_id", "points"]
    if groups.filter(F.col("g_norm").isNotNull()).limit(1).count():
        found &= F.col("g_norm").isNull() | (F.col("g_norm") == F.col("norm"))
        alike.append("norm")
    rows = rows.groupBy(*alike).agg(F.count("*").alias("n"))
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    return rows.join(groups, found).select("doc_id", "points", "digest", "n", "keep_id", "group_size", best.alias("best"))


# Rows of one count are written out by as many tasks as it takes.
_WRITTEN_OUT = 1 << 16


def exact_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS,
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_digest.

    Of equal texts one row stays: one with the most code points, then with the
    smallest doc_id; of rows that agree in both, one of them. A null text is empty,
    and empty texts are equal to each other. Rows without an id lose to rows with
    one of as many code points; keep_id is null where one without stays. Ids are
    integers; other columns of ``docs`` are not read.
    ``digest`` may be any function of the normalised text, even a constant:
    results stay the same."""
    # Stored, or each of the two uses below would read the texts again.
    counted = common.durable(_counted(docs, doc_id, text, salts, digest))
    ends = F.least(F.col("n"), F.col("low") + _WRITTEN_OUT - 1)
    few = counted.filter(F.col("n") <= _WRITTEN_OUT).withColumn("low", F.lit(1).cast("long"))
    many = counted.filter(F.col("n") > _WRITTEN_OUT).withColumn(
        "low", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(_WRITTEN_OUT).cast("long"))))
    each = few.unionByName(many.repartition("digest", "doc_id", "low")).withColumn("i", F.explode(F.sequence("low", ends)))
    return each.select("doc_id", "keep_id", "group_size", (F.col("best") & (F.col("i") == 1)).alias("kept"),
                       F.col("digest").alias("text_digest"))


def keep_best(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    A row is found again by its id, its code points and its digest. Only rows that
    agree in all of these meet once more to leave one: the one with the smallest
    text, or any of those with the same text; each task passes on one at most."""
    counted = common.durable(_counted(docs, doc_id, text, salts, sha256).filter(~F.col("best") | (F.col("n") > 1))
                             .select("doc_id", "points", "digest", "best"))
    names = [common.unused_name(docs, name) for name in ("id", "points", "digest")]
    own = [F.col(doc_id).cast("long"), F.length(common.whole(text)), sha256(normalised(common.whole(text)))]
    asked = lambda rows: rows.select(*(F.col(c).alias(n) for c, n in zip(("doc_id", "points", "digest"), names)))
    same = F.col(names[0]).eqNullSafe(own[0]) & (F.col(names[1]) == own[1]) & (F.col(names[2]) == own[2])
    kept = docs.join(asked(counted.filter(~F.col("best"))), same, "left_anti")
    repeated = asked(counted.filter("best"))
    if not repeated.limit(1).count():
        return kept
    place, keys = common.unused_name(docs, "place"), [common.unused_name(docs, f"k{i}") for i in range(3)]
    alike = kept.join(repeated, same, "left_semi").withColumns(dict(zip(keys, own)))
    one = alike.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(text))).filter(F.col(place) == 1)
    return kept.join(repeated, same, "left_anti").unionByName(one.drop(place, *keys))
