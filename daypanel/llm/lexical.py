"""Ranked lexical search over deduplicated bags of words.

Items are short queries, documents the corpus. Items are taken in blocks whose
vocabulary has a known bound, and for each block:

1. one pass over the documents restricts each to the block's vocabulary: a bag of
   term numbers and frequencies, with the count of all its terms;
2. counts of documents and terms give the terms' weights and each document's
   length norm ``m``;
3. documents with the same bag and the same ``m`` score alike for every item: they
   are grouped by a hash of both, with bag and ``m`` themselves in the key, so
   that classes are verified and a class of any size leaves one row per task;
4. each class is scored once against all items of the block, and a task keeps its
   best classes for each item;
5. winning classes are expanded to their members by ascending document id.

A class is ranked by its score and its smallest id, so the best documents of an
item are among its as many best classes, and of a class no more members than
places are ever needed."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from daypanel.llm import common
from daypanel.session import broadcast_if_bounded

TOP = 20
BLOCK_TERMS = 200_000  # (item, term) pairs of a block: a few MB in each task
CELLS = 1 << 21  # scores a task holds at a time
_BEYOND = np.iinfo(np.int64).max  # null ids come last

# Bytes of terms are ASCII letters, in lower case, digits and all beyond ASCII.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return text.translate(_TERM_BYTES).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_no, term, times) of numbered items."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = Counter(terms_of(text))
                if counts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(counts), pa.int64()), pa.array(counts.keys(), pa.binary()),
                         pa.array(counts.values(), pa.int64())], ["item_no", "term", "times"])

    return items.select("item_no", "text").mapInArrow(work, "item_no long, term binary, times long")


def _blocks(pairs: DataFrame, most: int) -> int:
    """Into how many blocks items are dealt by hash, so that no block of several
    items has more than twice ``most`` pairs."""
    sizes = common.durable(pairs.groupBy("item_no").count())
    total = sizes.agg(F.sum("count")).head()[0] or 0
    n = max(1, -(-total // most))
    while True:
        largest = (sizes.groupBy(_block(n).alias("block")).agg(F.sum("count").alias("pairs"), F.count("*").alias("items"))
                   .filter((F.col("items") > 1) & (F.col("pairs") > 2 * most)).limit(1).count())
        if not largest:
            return n
        n *= 2


def _block(n: int) -> Column:
    return F.pmod(F.xxhash64("item_no"), F.lit(n))


class Block:
    """The items of a block: their vocabulary, and which items ask for a term."""

    def __init__(self, rows: list):
        self.items = np.array(sorted({row.item_no for row in rows}), np.int64)
        number = {item: i for i, item in enumerate(self.items.tolist())}
        self.terms = {term: i for i, term in enumerate(sorted({bytes(row.term) for row in rows}))}
        asked = sorted((self.terms[bytes(row.term)], number[row.item_no], row.times) for row in rows)
        term, self.item, self.times = (np.array(column, np.int64) for column in zip(*asked, strict=True))
        self.ends = np.searchsorted(term, np.arange(len(self.terms) + 1))


def _bags(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_terms, bag): a bag is term numbers, ascending, then frequencies."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, bags = [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                lengths.append(len(words))
                counts = Counter(map(terms.get, words))
                counts.pop(None, None)
                numbers = sorted(counts)
                bags.append(np.array(numbers + [counts[i] for i in numbers], "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(bags, pa.binary())],
                                             ["doc_id", "n_terms", "bag"])

    return docs.mapInArrow(work, "doc_id long, n_terms long, bag binary")


def _postings(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, frequency) of all entries of the bags."""
    size = np.array([len(bag) // 8 for bag in bags], np.int64)
    both = np.frombuffer(b"".join(bags), "<u4").astype(np.int64)
    inside = np.arange(len(both)) - np.repeat(2 * (np.cumsum(size) - size), 2 * size)
    numbers = inside < np.repeat(size, 2 * size)
    return np.repeat(np.arange(len(bags)), size), both[numbers], both[~numbers]


def _document_counts(bags: DataFrame) -> DataFrame:
    """(term, df): documents that hold a term, by its number."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for batch in batches:
            _, term, _ = _postings(batch.column(0).to_pylist())
            counts = np.bincount(term, minlength=len(df))
            counts[:len(df)] += df
            df = counts
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some].astype(np.int64))], ["term", "df"])

    return bags.select("bag").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Best:
    """The best classes of each item so far, by score, smallest id and number."""

    def __init__(self, n_items: int, top: int):
        self.top, self.least = top, np.ones(n_items, np.int64)
        self.rows = np.zeros((4, 0), np.int64)  # item, score, smallest id, class number

    def add(self, scores: np.ndarray, first: np.ndarray, number: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        found = np.stack([item, scores[row, item], first[row], number[row]])
        rows = np.concatenate([self.rows, found], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0], "left")
        self.rows = rows[:, place < self.top]
        full = rows[:, place == self.top - 1]
        self.least[full[0]] = full[1]


def _scored(classes: DataFrame, block: Block, weights: np.ndarray, top: int) -> DataFrame:
    """(item, score, first, class_no): each task's best classes of each item."""
    n_items, ends, item_of, times = len(block.items), block.ends, block.item, block.times

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, step = Best(n_items, top), max(1, CELLS // n_items)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                number, m = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                first = np.array([_BEYOND if x is None else x for x in part.column(2).to_pylist()], np.int64)
                row, term, tf = _postings(part.column(3).to_pylist())
                some = weights[term] > 0
                row, term, tf = row[some], term[some], tf[some]
                value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
                # Entries of a few terms at a time: each is repeated for the items that ask for its term.
                asked = ends[term + 1] - ends[term]
                upto = np.cumsum(asked)
                scores = np.zeros(part.num_rows * n_items, np.int64)
                low = 0
                while low < len(term):
                    high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + 2 * CELLS, "right")))
                    n = asked[low:high]
                    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[term[low:high]], n)
                    np.add.at(scores, np.repeat(row[low:high] * n_items, n) + item_of[place],
                              np.repeat(value[low:high], n) * times[place])
                    low = high
                best.add(scores.reshape(-1, n_items), first, number)
        item, score, first, number = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.items[item]), pa.array(score), pa.array(first, mask=first == _BEYOND), pa.array(number)],
            ["item_no", "score", "first", "class_no"])

    return (classes.select("class_no", "m", "first", "bag")
            .mapInArrow(work, "item_no long, score long, first long, class_no long"))


def _first_of(rows: DataFrame, top: int, by: list[str], *order: Column) -> DataFrame:
    """At most ``top`` rows of each group, with their ``rank``. The limit is
    applied in each task before rows of a group meet."""
    return (rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
            .filter(F.col("rank") <= top))


def _ranked_block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    bags = common.durable(_bags(docs, block.terms))
    n_docs, n_terms = bags.agg(F.count_if(F.col("n_terms") > 0), F.coalesce(F.sum("n_terms"), F.lit(0))).head()
    weights = np.zeros(len(block.terms), np.int64)
    for row in _document_counts(bags).collect():  # a row per term of the block at most
        weights[row.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row.df + 1)))
    m = F.lit(100 - 25) + F.expr(f"(25L * n_terms * {n_docs}L) div {max(1, n_terms)}L")
    members = (bags.filter(F.length("bag") > 0).select("doc_id", "bag", m.alias("m"))
               .withColumn("digest", F.xxhash64("bag", "m")))
    classes = common.durable(members.groupBy("digest", "m", "bag").agg(F.min("doc_id").alias("first"))
                             .withColumn("class_no", F.monotonically_increasing_id()))
    winners = common.durable(_first_of(
        _scored(classes, block, weights, top), top, ["item_no"],
        F.col("score").desc(), F.col("first").asc_nulls_last(), F.col("class_no")).drop("rank", "first"))
    # top rows per item of the block at most.
    bound = top * len(block.items)
    wanted = broadcast_if_bounded(winners.select("class_no").distinct(), bound)
    won = common.durable(classes.join(wanted, "class_no", "left_semi").select("class_no", "digest", "m", "bag"))
    keys = broadcast_if_bounded(won.select("digest", "m").distinct(), bound)
    near = _first_of(members.join(keys, ["digest", "m"], "left_semi"), top, ["digest", "m", "bag"],
                     F.col("doc_id").asc_nulls_last()).drop("rank")
    expanded = near.join(won, ["digest", "m", "bag"]).select("class_no", "doc_id").join(winners, "class_no")
    return _first_of(expanded, top, ["item_no"], F.col("score").desc(), F.col("doc_id").asc_nulls_last())


def search(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row of
    ``items`` that score above 0, equal scores by ascending doc_id (null last).

    Whole texts count. A null or empty text has no terms: such a document is never
    found nor counted, such an item finds nothing. Repeated rows of documents are
    documents of their own, repeated items get a ranking each. Other columns are
    not read. The jobs of all steps but the last run when this is called; one item's
    terms are held in one task, and ``block_terms`` bounds those of several."""
    common.ship()
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.whole(text).cast("binary").alias("text"))
    numbered = common.durable(items.select(F.col(item_id).alias("item_id"), common.whole(item_text).cast("binary").alias("text"))
                              .withColumn("item_no", F.monotonically_increasing_id()))
    pairs = common.durable(_item_terms(numbered))
    n, ranked = _blocks(pairs, block_terms), None
    for number in range(n):
        rows = pairs.filter(_block(n) == number).collect()
        if rows:
            part = _ranked_block(docs, Block(rows), top)
            ranked = part if ranked is None else ranked.unionByName(part)
    names = numbered.select("item_no", "item_id")
    if ranked is None:
        return names.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).limit(0)
    return ranked.join(names, "item_no").select("item_id", "rank", "doc_id", "score")
