"""Repeated passages, by a suffix array over anchors.

Each string of ``length`` bytes is anchored at the smallest hash of the short
strings in it, so equal strings have equal anchors at equal places, and one
anchor stands for all the strings around it. Anchors whose hash occurs once are
dropped; the others' neighbourhoods meet by hash. There their suffixes and, read
backwards, their prefixes are sorted (see ``suffix``); neighbours' common
extensions tell, for every string around an anchor, whether another one equals
it. What comes back per anchor is the stretch of bytes such strings cover.

Nothing meets in one task without bound. Copies of a whole text count as one text
here and are removed as wholes. An anchor of more than ``hot`` occurrences is
dealt over salted groups; strings that find no partner in theirs are looked up
among those of the other groups by a 128-bit digest of their bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daypanel.llm import common
from daypanel.llm.suffix import Hashes, mixed, sort_suffixes
from daypanel.session import remove_folder, run_folder

LENGTH = 200
ANCHOR = 32
HOT = 4096
SEGMENT = 1 << 20
GROUP_ROWS = 16_384

_PLACE_BITS, _RANK_BITS = 24, 40


def anchors(buffer: np.ndarray, ends: np.ndarray, length: int, anchor: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, least, most, hash) of the anchors of all strings of ``length``
    bytes that lie within one text, texts ending at ``ends``. An anchor's strings
    begin ``least`` to ``most`` bytes before it."""
    strings = len(buffer) - length + 1
    if strings <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    hashes = mixed(Hashes(buffer).every(anchor))
    # The rank is the hash's upper bits, then the place: of equals the first.
    keys = (hashes >> np.uint64(64 - _RANK_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    window, have = length - anchor + 1, 1
    while 2 * have <= window:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    keys = np.minimum(keys[:strings], keys[window - have:window - have + strings])
    place = (keys & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    end = np.repeat(ends, np.diff(ends, prepend=0))[:strings]
    begin = np.flatnonzero(np.arange(strings) + length <= end)
    if not len(begin):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    place = place[begin]
    new = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(begin) != 1)])
    last = np.r_[new[1:] - 1, len(begin) - 1]
    at = place[new]
    return at, at - begin[last], at - begin[new], hashes[at]


def _segments(texts: Iterator[tuple[int, bytes]], length: int) -> Iterator[tuple[np.ndarray, list]]:
    """Buffers of about SEGMENT bytes and their parts: (text, offset in the text,
    start in the buffer, end). Long texts are cut into parts that overlap, so
    each string lies in exactly one of them."""
    parts, pieces, size = [], [], 0
    for text, content in texts:
        for at in range(0, max(1, len(content) - length + 1), SEGMENT):
            piece = content[at:at + SEGMENT + length - 1]
            if len(piece) >= length:
                parts.append((text, at, size, size + len(piece)))
                pieces.append(piece)
                size += len(piece)
            if size >= SEGMENT:
                yield np.frombuffer(b"".join(pieces), np.uint8), parts
                parts, pieces, size = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(pieces), np.uint8), parts


def _packed(place: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    return place << 20 | least << 10 | most


def _unpacked(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 20, packed >> 10 & 1023, packed & 1023


def _all_anchors(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """Rows (hash, t1, t2, place): the anchors of every text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for buffer, parts in _segments(((i, c.as_py()) for i, c in enumerate(batch.column(2))), length):
                text, offset, start, end = map(np.array, zip(*parts, strict=True))
                place, least, most, hashes = anchors(buffer, end, length, anchor)
                part = np.searchsorted(end, place, "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(t1[text[part]]), pa.array(t2[text[part]]),
                     pa.array(_packed(place - start[part] + offset[part], least, most))], ["hash", "t1", "t2", "place"])

    return texts.mapInArrow(work, "hash long, t1 long, t2 long, place long")


def _neighbourhoods(texts: DataFrame, length: int) -> DataFrame:
    """Rows (hash, salt, hot, t1, t2, place, bytes) from texts with the list of
    their repeated anchors."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hash", "salt", "hot", "t1", "t2", "place", "bytes"]
        kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            rows, held = [], 0
            for row in range(batch.num_rows):
                t1, t2, content = (batch.column(i)[row].as_py() for i in range(3))
                for a in batch.column(3)[row].as_py():
                    place, least, most = a["place"] >> 20, a["place"] >> 10 & 1023, a["place"] & 1023
                    around = content[place - most:place - least + length]
                    rows.append((a["hash"], a["salt"], a["hot"], t1, t2, a["place"], around))
                    held += len(around)
                if held >= 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds,
                                                                                     strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds,
                                                                                 strict=True)], names)

    return texts.mapInArrow(work, "hash long, salt int, hot boolean, t1 long, t2 long, place long, bytes binary")


def match_groups(group: np.ndarray, least: np.ndarray, most: np.ndarray, around: list[bytes], length: int,
                 alone: np.ndarray | None = None
                 ) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """(lowest, highest, rest): for each anchor the least and the largest number
    of bytes before it at which a string begins that equals another one of its
    group; lowest > highest where there is none.

    ``rest``: for the anchors flagged in ``alone``, (bytes before it, anchors,
    whether matched) with one anchor for each set of equal strings."""
    # Most neighbourhoods of a repeated anchor are the same; one of each is sorted.
    seen: dict = {}
    member = np.fromiter((seen.setdefault(key, len(seen)) for key in zip(
        group.tolist(), least.tolist(), most.tolist(), around, strict=True)), np.int64, len(group))
    first = np.unique(member, return_index=True)[1]
    copies = np.bincount(member)
    group, least, most, around = group[first], least[first], most[first], [around[i] for i in first.tolist()]
    n = len(group)
    sizes = np.fromiter(map(len, around), np.int64, n)
    starts = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(around), np.uint8)
    # The suffix from the anchor on, and the prefix before it read backwards.
    order_r, common_r = sort_suffixes(buffer, starts + most, sizes - most, group)
    order_l, common_l = sort_suffixes(buffer[::-1].copy(), len(buffer) - starts - most, most, group)
    lowest, highest = np.full(n, length + 1), np.full(n, -1)
    rest: list[tuple[int, np.ndarray, np.ndarray]] = []
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for before in range(int(least.min(initial=length)), int(most.max(initial=-1)) + 1):
        active = np.flatnonzero((least <= before) & (before <= most))
        if not len(active):
            continue
        class_r[order_r] = np.cumsum(common_r < length - before)
        class_l[order_l] = np.cumsum(common_l < before)
        both = class_r[active] * (n + 1) + class_l[active]
        by_class = np.argsort(both, kind="stable")
        new = np.r_[True, np.diff(both[by_class]) != 0]
        size = np.add.reduceat(copies[active[by_class]], np.flatnonzero(new))
        matched = active[by_class[(size > 1)[np.cumsum(new) - 1]]]
        lowest[matched] = np.minimum(lowest[matched], before)
        highest[matched] = np.maximum(highest[matched], before)
        if alone is not None:
            shown = first[active[by_class[new]]]
            rest.append((before, shown[alone[shown]], size[alone[shown]] > 1))
    return lowest[member], highest[member], rest


_FOUND = "t1 long, t2 long, start long, stop long, digest binary, matched boolean"


def _matched(neighbourhoods: DataFrame, length: int) -> DataFrame:
    """Stretches (t1, t2, start, stop) that repeat; and, with a digest, strings of
    hot anchors to be looked up among those of other salts."""
    def batch_of(t1, t2, start, stop, digest, matched) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip((t1, t2, start, stop, digest, matched), kinds, strict=True)],
            ["t1", "t2", "start", "stop", "digest", "matched"])

    def solve(rows: list) -> Iterator[pa.RecordBatch]:
        key, t1, t2, place, around, hot = zip(*rows, strict=True)
        numbers: dict = {}
        group = np.fromiter((numbers.setdefault(k, len(numbers)) for k in key), np.int64, len(rows))
        t1, t2, hot = np.array(t1, np.int64), np.array(t2, np.int64), np.array(hot, bool)
        place, least, most = _unpacked(np.array(place, np.int64))
        lowest, highest, rest = match_groups(group, least, most, around, length, hot if hot.any() else None)
        i = np.flatnonzero(lowest <= highest)
        nothing = [None] * len(i)
        yield batch_of(t1[i], t2[i], place[i] - highest[i], place[i] - lowest[i] + length, nothing, nothing)
        for before, i, matched in rest:
            digests = [hashlib.blake2b(around[j][at:at + length], digest_size=16).digest()
                       for j, at in zip(i.tolist(), (most[i] - before).tolist(), strict=True)]
            yield batch_of(t1[i], t2[i], place[i] - before, place[i] - before + length, digests, matched)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []  # of groups that are not solved yet, in order
        for batch in batches:
            h, salt, hot, t1, t2, place, around = (batch.column(i).to_pylist() for i in range(7))
            rows += zip(zip(h, salt, strict=True), t1, t2, place, around, hot, strict=True)
            while len(rows) > GROUP_ROWS and rows[0][0] != rows[-1][0]:
                # The last group may go on in the next batch.
                cut = next(i for i in range(len(rows) - 1, -1, -1) if rows[i][0] != rows[-1][0]) + 1
                upto = min(cut, GROUP_ROWS)
                while upto < cut and rows[upto][0] == rows[upto - 1][0]:
                    upto += 1
                yield from solve(rows[:upto])
                rows = rows[upto:]
        if rows:
            yield from solve(rows)

    near = neighbourhoods.repartition("hash", "salt").sortWithinPartitions("hash", "salt")
    return near.mapInArrow(work, _FOUND)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that overlap or touch, as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _cut(texts: DataFrame, keep_text: bool) -> DataFrame:
    """What is left of texts after their spans are removed."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in range(batch.num_rows):
                content = batch.column(2)[row].as_py()
                spans = merged([(s["start"], s["stop"]) for s in batch.column(3)[row].as_py()])
                cuts = [0, *(at for span in spans for at in span), len(content)]
                kept = b"".join(content[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                rows.append((batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), len(content) - len(kept),
                             [{"start": a, "stop": b} for a, b in spans], hashlib.sha256(kept).hexdigest(),
                             kept if keep_text else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
                     pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                             ["k1", "k2", "n_removed", "spans", "kept_sha256", "kept"])

    return texts.mapInArrow(work, "k1 long, k2 long, n_removed long, spans array<struct<start:long,stop:long>>, "
                                  "kept_sha256 string, kept binary")


def _halves(content: Column) -> list[Column]:
    """The first 128 bits of a text's SHA-256 as two longs: its name."""
    digest = F.sha2(content, 256)
    return [F.conv(F.substr(digest, F.lit(at), F.lit(16)), 16, -10).cast("long").alias(name)
            for at, name in ((1, "t1"), (17, "t2"))]


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, hot: int = HOT, keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, spans (the maximal
    removed stretches, start and stop in UTF-8 bytes), kept_sha256 and, with
    ``keep_text``, kept: the bytes that remain.

    A byte goes if it lies in a string of ``length`` bytes that also starts
    anywhere else, in the same text or another one, overlaps included. Nulls are
    empty; texts shorter than ``length`` stay as they are. Rows that repeat,
    under whatever id, are copies like any others. Other columns are not read.
    ``length`` may exceed ``anchor`` by 1023 at most."""
    if not 0 <= length - anchor <= 1023:  # an anchor's two distances are kept in ten bits each
        raise ValueError(f"length must be {anchor} to {anchor + 1023} with anchors of {anchor} bytes, not {length}")
    common.ship()
    content = common.whole(text).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), *_halves(content), content.alias("text"))
    long = rows.filter(F.octet_length("text") >= length).select("t1", "t2", "text")

    # Anchors found in one place only (copies of a text being one) lead nowhere.
    found = _all_anchors(long, length, anchor)
    places = F.xxhash64("t1", "t2", "place")
    # Written out, the few repeated hashes are a table of their own, and the join
    # may split the anchors of one hash that a third of the texts hold.
    repeated = common.durable(
        found.groupBy("hash").agg(F.min(places).alias("a"), F.max(places).alias("b"), F.count("*").alias("n"))
        .filter("a <> b").select(F.col("hash").alias("h"), F.ceil(F.col("n") / hot).cast("int").alias("salts")))
    found = found.join(repeated, F.col("hash") == F.col("h")).select(
        "t1", "t2", F.struct("place", "hash", F.pmod(places, F.col("salts")).cast("int").alias("salt"),
                             (F.col("salts") > 1).alias("hot")).alias("anchor"))
    folder = run_folder(docs.sparkSession, "anchors")  # as Parquet: rows of numbers shrink to a third
    (found.groupBy(F.col("t1").alias("l1"), F.col("t2").alias("l2")).agg(F.collect_set("anchor").alias("anchors"))
     .write.parquet(folder))
    lists = docs.sparkSession.read.parquet(folder)

    # Each distinct text meets its anchors, and later what is cut out of it.
    texts = long.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    same = lambda a, b: (F.col("t1") == F.col(a)) & (F.col("t2") == F.col(b))
    near = _neighbourhoods(texts.join(lists, same("l1", "l2")).select("t1", "t2", "text", "anchors"), length)
    matched = common.durable(_matched(near, length))
    remove_folder(docs.sparkSession, folder)

    # Strings of hot anchors that met no partner under their own salt.
    rest = matched.filter(F.col("digest").isNotNull())
    again = rest.groupBy(F.col("digest").alias("d")).agg(F.count("*").alias("n")).filter("n > 1").select("d")
    late = rest.filter("not matched").join(again, F.col("digest") == F.col("d"), "left_semi")
    stretches = matched.filter(F.col("digest").isNull()).unionByName(late).select("t1", "t2", "start", "stop")
    spans = stretches.groupBy(F.col("t1").alias("l1"), F.col("t2").alias("l2")).agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"))
    cut = _cut(texts.join(spans, same("l1", "l2")).select("t1", "t2", "text", "spans"), keep_text)

    copies = long.groupBy(F.col("t1").alias("c1"), F.col("t2").alias("c2")).agg(F.count("*").alias("n")).filter("n > 1")
    # One row per text that is copied or cut, written out: rows then look it up
    # by a join that may split the copies of one text.
    facts = common.durable(
        copies.join(cut, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")), "full")
        .select(F.coalesce("c1", "k1").alias("f1"), F.coalesce("c2", "k2").alias("f2"), "n", "n_removed", "spans",
                "kept_sha256", *(["kept"] if keep_text else [])))
    copied = F.col("n").isNotNull()
    columns = ["doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"),
               F.sha2("text", 256).alias("sha256"), *(["text"] if keep_text else [])]
    whole_span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    no_span = F.array().cast("array<struct<start:long,stop:long>>")
    result = rows.select(*columns).join(facts, same("f1", "f2"), "left")
    return result.select(
        "doc_id", "n_bytes", F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, whole_span).otherwise(F.coalesce("spans", no_span)).alias("spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        *([F.when(copied, F.lit("").cast("binary")).otherwise(F.coalesce("kept", "text")).alias("kept")] if keep_text else []))
