"""Benchmark passages in documents, by a prefix-filtered set join.

An item's windows are the sets to be contained; their tokens are shingles of a
few words. Shingles are ordered by how rare they are in the corpus. Containment
asks for every shingle of a window, so one necessary prefix token per window -
its rarest - is enough to find it, and everything else a document holds is never
shuffled. A document's occurrence of a prefix token must leave room for the
window before and after it (positional and length bounds), and the words around
it are then compared with the window's, so results are exact.

Two passes read the corpus: one counts the benchmark's shingles, one looks for
prefix tokens. Both skip other shingles by a bit table whose size is a
parameter; it passes false candidates, which the joins drop, but no false
results."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from daypanel.llm import common

WINDOW = 13
SHINGLE = 3
TABLE_BITS = 24
WORDS_AT_ONCE = 200_000

# Words are runs of ASCII digits and letters and of all non-ASCII characters;
# A-Z become a-z.
_LETTERS = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
                 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_LETTERS).split() if text else []


def _mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return codes ^ (codes >> np.uint64(29))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, by its first word."""
    codes = np.fromiter(map(crc32, words), np.uint64, len(words))
    n = max(0, len(words) - size + 1)
    hashes = np.full(n, size, np.uint64)
    for i in range(size):
        hashes = _mixed(hashes * np.uint64(0xD6E8FEB86659FD93) + codes[i:i + n])
    return hashes


def _groups(texts: Iterator[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words of several texts at once, and where each text's words end."""
    words, ends = [], []
    for text in texts:
        words += words_of(text)
        ends.append(len(words))
        if len(words) >= WORDS_AT_ONCE:
            yield words, np.array(ends)
            words, ends = [], []
    if ends:
        yield words, np.array(ends)


def _occurrences(words, ends, sizes, table, bits) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, positions, hashes) of the shingles within one text that may be in
    the bit table."""
    for size in sizes:
        hashes = shingle_hashes(words, size)
        slot = hashes & np.uint64((1 << bits) - 1)
        maybe = np.flatnonzero((table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)))
                               & np.uint64(1))
        one_text = np.searchsorted(ends, maybe, "right") == np.searchsorted(ends, maybe + size - 1, "right")
        yield size, maybe[one_text], hashes[maybe[one_text]]


def _bit_table(tokens: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits with those of the tokens set. The driver gets at most
    2**(bits-6) rows of 16 bytes, however many tokens there are."""
    slot = F.col("token").bitwiseAND((1 << bits) - 1)
    rows = (tokens.select(F.shiftright(slot, 6).alias("at"),
                          F.expr("shiftleft(1L, cast(token & 63 as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return table


def item_windows(items: DataFrame, *, item_id: str = "item_id", text: str = "text", window: int = WINDOW,
                 shingle: int = SHINGLE) -> DataFrame:
    """Rows (item_id, words, n, token, at): the windows of each item with each of
    their shingles. An item of fewer words is one window, one without words has
    none."""
    common.ship()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(content)
                n = min(window, len(words))
                hashes = shingle_hashes(words, min(shingle, n)).view(np.int64).tolist()
                for start in range(len(words) - n + 1 if n else 0):
                    joined = b" ".join(words[start:start + n]).decode()
                    rows += [(name, joined, n, hashes[start + i], i) for i in range(n - min(shingle, n) + 1)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (batch.schema.field(0).type, pa.string(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["item_id", "words", "n", "token", "at"])

    schema = T.StructType([T.StructField("item_id", items.schema[item_id].dataType),
                           T.StructField("words", T.StringType()), T.StructField("n", T.IntegerType()),
                           T.StructField("token", T.LongType()), T.StructField("at", T.IntegerType())])
    return items.select(F.col(item_id), F.col(text).cast("binary")).mapInArrow(cut, schema).distinct()


def _token_counts(texts: DataFrame, sizes: list[int], table: np.ndarray, bits: int) -> DataFrame:
    """How often the corpus holds each shingle of the bit table."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, ends in _groups(content.as_py() for content in batch.column(0)):
                for _, _, hashes in _occurrences(words, ends, sizes, shared.value, bits):
                    tokens, counts = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts)],
                                                     ["token", "count"])

    return (texts.mapInArrow(count, "token long, count long")
            .groupBy("token").agg(F.sum("count").alias("frequency")))


def _candidates(texts: DataFrame, sizes: list[int], table: np.ndarray, bits: int, window: int) -> DataFrame:
    """One row per document: its id, key, number of words, and the occurrences of
    possible prefix tokens with the words around them."""
    shared = texts.sparkSession.sparkContext.broadcast(table)
    place = pa.struct([("token", pa.int64()), ("position", pa.int64()), ("before", pa.int32()), ("around", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for words, ends in _groups(content.as_py() for content in batch.column(2)):
                starts = np.r_[0, ends[:-1]]
                found = [[] for _ in ends]
                for size, positions, hashes in _occurrences(words, ends, sizes, shared.value, bits):
                    text = np.searchsorted(ends, positions, "right").tolist()
                    for i, at, token in zip(text, positions.tolist(), hashes.view(np.int64).tolist(), strict=True):
                        first = max(int(starts[i]), at - window + size)
                        around = words[first:min(int(ends[i]), at + window)]
                        found[i].append({"token": token, "position": at - int(starts[i]), "before": at - first,
                                         "around": b" ".join(around).decode()})
                part = slice(done, done + len(ends))
                done += len(ends)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], batch.column(1)[part], pa.array(ends - starts, pa.int64()),
                     pa.array(found, pa.list_(place))], ["doc_id", "key", "n_words", "found"])

    schema = T.StructType([texts.schema["doc_id"], texts.schema["key"], T.StructField("n_words", T.LongType()),
                           T.StructField("found", T.ArrayType(T.StructType([
                               T.StructField("token", T.LongType()), T.StructField("position", T.LongType()),
                               T.StructField("before", T.IntegerType()), T.StructField("around", T.StringType())])))])
    return texts.mapInArrow(search, schema)


def contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  table_bits: int = TABLE_BITS) -> DataFrame:
    """One row per document: doc_id, key, n_words, n_hit (words within any
    occurrence of an item's window) and items (the ids of those items, sorted as
    text). ``key`` is common.row_key's.

    Null and empty texts have no words and no hits; the same holds for every
    document if no item has words. Rows that repeat an id are judged one by one;
    items that repeat a text are all reported. Other columns are not read."""
    common.ship()
    common.bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("doc_id"), common.row_key(doc_id, text).alias("key"),
                        F.col(text).cast("binary").alias("text"))
    windows = common.durable(item_windows(items, item_id=item_id, text=item_text, window=window, shingle=shingle))
    sizes = [r.size for r in windows.select(F.least("n", F.lit(shingle)).alias("size")).distinct().collect()]

    tokens = windows.select("words", "n", "token", "at").distinct()
    frequency = _token_counts(texts.select("text"), sizes, _bit_table(tokens, table_bits), table_bits)
    rarest = (tokens.join(frequency, "token", "left").fillna(0, ["frequency"])
              .groupBy("words", "n").agg(F.min(F.struct("frequency", "token", "at")).alias("prefix")))
    prefixes = common.durable(rarest.select("words", "n", "prefix.token", "prefix.at"))

    rows = common.durable(_candidates(texts, sizes, _bit_table(prefixes, table_bits), table_bits, window)
                          .withColumn("row", F.monotonically_increasing_id()))
    found = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    start = F.col("before") - F.col("at")  # of the window, among the words around
    around = F.split("around", " ")
    fits = (start >= 0) & (start + F.col("n") <= F.size(around))
    same = F.when(fits, F.array_join(F.slice(around, F.greatest(start, F.lit(0)) + 1, F.col("n")), " ")
                  == F.col("words"))
    hits = common.durable(found.join(prefixes, "token").filter(same)
                          .select("row", (F.col("position") - F.col("at")).alias("start"), "n", "words"))

    spans = hits.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("spans"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("end")),
        lambda had, span: F.struct(
            (had.words + F.greatest(F.lit(0), span.start + span.n - F.greatest(span.start, had.end))).alias("words"),
            F.greatest(had.end, span.start + span.n).alias("end")), lambda had: had.words)
    named = (hits.select("row", "words").distinct()
             .join(windows.select("words", F.col("item_id").cast("string").alias("item")).distinct(), "words")
             .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    # Rows with hits are few; all others pass through without a match.
    return (rows.select("row", "doc_id", "key", "n_words")
            .join(spans.select("row", covered.alias("n_hit")), "row", "left").join(named, "row", "left")
            .select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def contaminated(found: DataFrame, one_in: int = 20):
    """The decision: some words hit, and at least one in ``one_in`` of them."""
    return (F.col("n_hit") > 0) & (F.lit(one_in) * F.col("n_hit") >= F.col("n_words"))


def without_contaminated(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                         one_in: int = 20, **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = contamination(docs, items, doc_id=doc_id, text=text, **how)
    return common.without_keys(docs, found.filter(contaminated(found, one_in)), doc_id, text)
