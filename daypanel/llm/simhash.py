"""Near duplicates by SimHash and vantage-point trees.

Distinct fingerprints are the points. A tree of vantage points, fitted on a
bounded sample, partitions them by Hamming distance: a point goes inside a
node's ball if its distance to the vantage point is at most the radius, else
outside. By the triangle inequality two points within ``r`` bits differ by at
most ``r`` in that distance, so a pair that a node separates has its inner point
in the last ``r`` rings of the ball. Copies of those points - the boundary
overlap - go outside too; every other branch is pruned. Every linked pair thus
meets in some leaf.

A leaf is a shard. Its task splits it on by the same rule, with vantage points
of its own, then compares what is left exactly. It returns links to one point of
each group it finds, never all pairs, so a group of any size costs its own
number of rows. Components of those links are the near-duplicate groups."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from daypanel.llm import common
from daypanel.llm.components import components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
SHARD, SAMPLE, LEAF = 20_000, 65_536, 1024


# ---- fingerprints ------------------------------------------------------------

def bit_counts(digests: bytes) -> np.ndarray:
    """How often each of 64 bits is set in big-endian 8-byte hashes."""
    bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64)
    whole = len(bits) // 255 * 255
    # 255 ones still fit a byte, so most of the sum runs on bytes.
    sums = bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return sums + bits[whole:].sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text: the majority of its shingles' XXH64 in
    each bit. Words are split at [\\x20\\x09-\\x0D], A-Z become a-z."""
    words = text.lower().split()  # of bytes: ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-shingle] + 1].tolist()
    digest, counts, step = xxhash.xxh64_digest, np.zeros(64, np.int64), 100_000
    ends = ends[shingle - 1:].tolist()
    for at in range(0, len(starts), step):  # long texts in pieces, for memory's sake
        counts += bit_counts(b"".join([digest(joined[s:e], seed) for s, e in zip(
            starts[at:at + step], ends[at:at + step], strict=True)]))
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """Rows (doc_id, key, fingerprint), the fingerprint as a signed long; key is
    common.row_key's. Null and empty texts have fingerprint 0."""
    common.ship()
    common.bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(2)), np.uint64,
                                 batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))],
                                             ["doc_id", "key", "fingerprint"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), common.row_key(doc_id, text).alias("key"),
                       common.whole(text).cast("binary").alias("text"))
    return rows.mapInArrow(work, T.StructType([*rows.schema.fields[:2], T.StructField("fingerprint", T.LongType())]))


# ---- vantage-point trees -----------------------------------------------------

@dataclass
class Node:
    """A ball, or a leaf where ``shard`` is not -1."""
    vantage: int = 0
    radius: int = 0
    inside: int = -1
    outside: int = -1
    shard: int = -1


def _distance(points: np.ndarray, vantage: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(vantage))


def choose_ball(points: np.ndarray, bits: int, rng: np.random.Generator) -> tuple[int, int] | None:
    """The vantage point and radius, of some random ones, that copy the fewest
    points for what they split; None if no ball splits the points."""
    best, n = None, len(points)
    for vantage in rng.choice(points, min(n, 8), replace=False).tolist():
        within = np.cumsum(np.bincount(_distance(points, vantage), minlength=65))
        for radius in range(64):
            share = within[radius] / n
            if not 0.1 <= share <= 0.9:
                continue
            copied = (within[radius] - (within[radius - bits] if radius >= bits else 0)) / n
            if 1 - share + copied > 0.95:
                continue
            gain = -(share * np.log(share) + (1 - share) * np.log(1 - share))
            cost = np.log1p(copied) / gain
            if best is None or cost < best[0]:
                best = cost, vantage, radius
    return best and best[1:]


def split(points: np.ndarray, vantage: int, radius: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The points inside, and those outside with the inner points near the edge."""
    distance = _distance(points, vantage).astype(np.int16)
    return points[distance <= radius], points[distance > radius - bits]


def build_tree(sample: np.ndarray, leaf: int, bits: int, seed: int = SEED) -> list[Node]:
    """A tree whose leaves hold at most ``leaf`` of the sample, where it can be
    split that far."""
    rng, nodes, todo, shards = np.random.default_rng(seed), [Node()], [(0, sample)], 0
    while todo:
        at, points = todo.pop()
        ball = choose_ball(points, bits, rng) if len(points) > max(leaf, 16) else None
        if ball is None:
            nodes[at] = Node(shard=shards)
            shards += 1
            continue
        nodes[at] = Node(*ball, len(nodes), len(nodes) + 1)
        nodes += [Node(), Node()]
        todo += list(zip((nodes[at].inside, nodes[at].outside), split(points, *ball, bits), strict=True))
    return nodes


def route(nodes: list[Node], points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, its points): each point's own shard and those across a boundary."""
    todo = [(0, points)]
    while todo:
        at, here = todo.pop()
        node = nodes[at]
        if node.shard >= 0:
            yield node.shard, here
        elif len(here):
            todo += list(zip((node.inside, node.outside), split(here, node.vantage, node.radius, bits), strict=True))


def link_leaf(points: np.ndarray, bits: int, few: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same points as all pairs within ``bits`` do.

    A few points are compared with each other, and their pairs are the links
    unless most points are near most others. Many points, which no ball could
    split, are gathered group by group: those reached from a group are compared
    with the points not reached yet, so a group empties quickly and gives one
    link for each of its points."""
    if len(points) <= few:
        near = np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= bits, 1)
        rows, columns = np.nonzero(near)
        if len(rows) <= 8 * len(points):
            return points[rows], points[columns]
    link_a, link_b, left = [points[:0]], [points[:0]], points
    while len(left):
        group, left = left[:1], left[1:]
        while len(group) and len(left):
            block, group = group[:64], group[64:]
            near = np.bitwise_count(block[:, None] ^ left[None, :]) <= bits
            hit = near.any(axis=0)
            link_a.append(block[near[:, hit].argmax(axis=0)])
            link_b.append(left[hit])
            group, left = np.r_[group, left[hit]], left[~hit]
    return np.concatenate(link_a), np.concatenate(link_b)


def link_shard(points: np.ndarray, bits: int, leaf: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The links of a shard: split on by balls, then compared in its leaves."""
    points = np.unique(points)
    nodes = build_tree(points, leaf, bits, seed)
    links = [link_leaf(here, bits, leaf) for _, here in route(nodes, points, bits) if len(here) > 1]
    a = np.concatenate([x for x, _ in links] or [points[:0]])
    b = np.concatenate([y for _, y in links] or [points[:0]])
    if len(a):
        a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return a, b


def near_links(points: DataFrame, *, max_bits: int = MAX_BITS, shard: int = SHARD, sample: int = SAMPLE,
               leaf: int = LEAF) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fingerprint``) that
    connect whatever pairs of at most ``max_bits`` differing bits connect.

    The tree is fitted on at most ``sample`` fingerprints, those with the
    smallest hashes; every fingerprint is routed through it. Shards hold about
    ``shard`` points while the sample can tell them apart; larger ones are split
    in their task."""
    common.ship()
    total = points.count()
    known = (common.smallest_hashes(points.select("fingerprint"), sample, "fingerprint")
             .toArrow()["fingerprint"].to_numpy().view(np.uint64))
    nodes = build_tree(known, max(16, int(len(known) * shard / max(total, 1))), max_bits)
    n_shards = sum(node.shard >= 0 for node in nodes)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, here in route(nodes, batch.column(0).to_numpy().view(np.uint64), max_bits):
                if len(here):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(here), number, np.int32)),
                                                      pa.array(here.view(np.int64))], ["shard", "fingerprint"])

    def link(table: pa.Table) -> pa.Table:
        a, b = link_shard(table["fingerprint"].to_numpy().view(np.uint64), max_bits, leaf)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    dealt = points.select("fingerprint").mapInArrow(deal, "shard int, fingerprint long")
    return dealt.repartition(max(1, min(n_shards, 100_000)), "shard").groupBy("shard").applyInArrow(
        link, "a long, b long")


def near_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS, **index) -> DataFrame:
    """One row per document: doc_id, key, fingerprint (signed long), component_id,
    the smallest doc_id that links of at most ``max_bits`` differing bits reach, its
    own included, and root, a fingerprint that names the group.

    Texts without words share fingerprint 0 and are linked like any others. Rows
    that repeat an id are members each; a null id is no component's id unless
    all ids of a group are null. Other columns are not read."""
    rows = common.durable(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle))
    classes = common.durable(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    roots = common.durable(components(near_links(classes, max_bits=max_bits, **index)))
    members = roots.join(classes, F.col("node") == F.col("fingerprint")).select("node", "root", "first_id")
    firsts = members.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("linked_id"))
    moved = members.join(firsts, F.col("root") == F.col("r")).select("node", "root", "linked_id")
    named = common.durable(classes.join(moved, F.col("fingerprint") == F.col("node"), "left").select(
        F.col("fingerprint").alias("f"), F.coalesce("linked_id", "first_id").alias("component_id"),
        F.coalesce("root", "fingerprint").alias("root")))
    return rows.join(named, F.col("fingerprint") == F.col("f")).select(
        "doc_id", "key", "fingerprint", "component_id", "root")


def keep_first(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is their group's, one of each group, with all
    their columns. Where several rows of a group have this id, the text with the
    smallest digest stays, and one of the rows that repeat it."""
    groups = common.durable(near_groups(docs, doc_id=doc_id, text=text, **how).select("doc_id", "component_id", "key", "root"))
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    firsts, moved = groups.filter(is_first).select("root", "key"), groups.filter(~is_first).select("key")
    repeated = firsts.groupBy("root").count().filter("count > 1").select("root")
    if not repeated.limit(1).count():
        return common.without_keys(docs, moved, doc_id, text)
    again = firsts.join(repeated, "root").groupBy("root", "key").count()
    best = again.groupBy("root").agg(F.min("key").alias("key"))
    kept = common.without_keys(docs, moved.unionByName(again.select("key").join(best.select("key"), "key", "left_anti")), doc_id, text)
    # Of rows that agree in id and text each task passes on one at most.
    name, place = common.unused_name(docs, "key"), common.unused_name(docs, "place")
    keys = again.filter("count > 1").select(F.col("key").alias(name))
    same = common.row_key(doc_id, text) == F.col(name)
    one = (kept.withColumn(name, common.row_key(doc_id, text)).join(keys, name, "left_semi")
           .withColumn(place, F.row_number().over(Window.partitionBy(name).orderBy(text)))
           .filter(F.col(place) == 1).drop(place, name))
    return kept.join(keys, same, "left_anti").unionByName(one)
