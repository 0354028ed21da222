"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q that is at least four periods
long and that no neighbouring word extends. Every document is cut into dyadic
blocks: aligned stretches of 2, 4, 8, ... words. A run of period q holds a block
of b words, q < b <= 2q, that occurs again exactly q words later or q words
earlier, and never nearer. So for each block the next and the previous occurrence
within the neighbouring windows of its own length are asked for:

1. a suffix array, sorted by doubling, gives each block the range of suffixes
   that begin with it;
2. a wavelet tree over the suffix array answers range successor and range
   predecessor: the occurrence next to a position among those of a range;
3. a block and its neighbours form a progression whose difference is a candidate
   period. Blocks that continue each other's progression are one candidate, and
   it is extended word by word to the whole run.

Documents share nothing: a task works through its rows in batches of a bounded
number of words (or one document, if that is longer), all blocks of a batch at
once, and no row is shuffled."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daypanel.llm import common

MIN_LENGTH, MIN_EXPONENT = 6, 4
BATCH_WORDS = 1 << 18

SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def repeated_blocks(ids: np.ndarray, first: np.ndarray, last: np.ndarray, exponent: int
                    ) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Suffixes by their first words, each document's in its own stretch, as far
    as blocks need them sorted.

    ``ids`` are word numbers from 1; ``first`` and ``last`` bound each position's
    document. Returns (order, slots, blocks): the suffix array; its places whose
    two first words occur elsewhere in the document; and for each block length
    (length, position, lowest place, number of places) of the aligned blocks that
    occur more than once."""
    n = len(ids)
    wide = int(ids.max()).bit_length()
    following = np.zeros(n, np.int64)
    following[:-1] = ids[1:]
    following[last - 1] = 0
    key = (first << 2 * wide) if int(first.max()).bit_length() + 2 * wide < 63 else None
    if key is None:  # documents by number instead of by place
        key = np.cumsum(first != np.r_[-1, first[:-1]]) << 2 * wide
    key = key | ids << wide | following
    order = np.argsort(key)
    key = key[order]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    blocks, length, repeated = [], 2, None
    while len(slots):
        heads = np.r_[True, key[1:] != key[:-1]]
        low = np.maximum.accumulate(np.where(heads, slots, 0))
        rank[order[slots]] = low
        size = np.diff(np.r_[np.flatnonzero(heads), len(slots)])
        many = np.repeat(size > 1, size)
        slots, low, size = slots[many], low[many], np.repeat(size, size)[many]
        if repeated is None:
            repeated = slots
        at = order[slots]
        room = last[at] - first[at]
        aligned = ((at - first[at]) % length == 0) & (room >= exponent * length // 2)
        if aligned.any():
            blocks.append((length, at[aligned], low[aligned], size[aligned]))
        # Blocks twice as long: documents that can hold no run of theirs are done.
        some = room >= exponent * length
        slots, low, at = slots[some], low[some], at[some]
        ahead = at + length
        inside = ahead < last[at]
        key = low * (n + 1) + np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key)
        key, order[slots] = key[by], at[by]
        length *= 2
    return order, np.arange(0) if repeated is None else repeated, blocks


class WaveletTree:
    """Counting and selecting among the values of any range of an array."""

    def __init__(self, values: np.ndarray):
        self.bits = range(max(1, int(values.max(initial=0)).bit_length()) - 1, -1, -1)
        self.levels = []
        for bit in self.bits:
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append(zeros)
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values of each range [low, high) are smaller than ``value``."""
        count = np.zeros(len(low), np.int64)
        for bit, zeros in zip(self.bits, self.levels, strict=True):
            one = (value >> bit & 1).astype(bool)
            left, right = zeros[low], zeros[high]
            count += np.where(one, right - left, 0)
            low = np.where(one, zeros[-1] + low - left, left)
            high = np.where(one, zeros[-1] + high - right, right)
        return count

    def select(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value, from 0, of each range."""
        found = np.zeros(len(low), np.int64)
        for bit, zeros in zip(self.bits, self.levels, strict=True):
            left, right = zeros[low], zeros[high]
            one = k >= right - left
            k = np.where(one, k - (right - left), k)
            low = np.where(one, zeros[-1] + low - left, left)
            high = np.where(one, zeros[-1] + high - right, right)
            found |= one.astype(np.int64) << bit
        return found

    def neighbours(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The predecessor and the successor of each range's own ``value`` in it;
        -1 where there is none."""
        at = self.below(low, high, value)
        size = high - low
        before = np.full(len(low), -1, np.int64)
        after = before.copy()
        some = np.flatnonzero(at > 0)
        before[some] = self.select(low[some], high[some], at[some] - 1)
        some = np.flatnonzero(at + 1 < size)
        after[some] = self.select(low[some], high[some], at[some] + 1)
        return before, after


def progressions(ids: np.ndarray, first: np.ndarray, last: np.ndarray, exponent: int
                 ) -> Iterator[tuple[int, int, int]]:
    """Candidates (start, end, period): stretches that have the period, by period
    and place."""
    order, slots, blocks = repeated_blocks(ids, first, last, exponent)
    if not blocks:
        return
    place = np.zeros(len(ids), np.int64)
    place[slots] = np.arange(len(slots))
    tree = WaveletTree(order[slots] - first[order[slots]])
    length = np.concatenate([np.full(len(at), b) for b, at, _, _ in blocks])
    at, low, size = (np.concatenate([block[i] for block in blocks]) for i in (1, 2, 3))
    low = place[low]
    own = at - first[at]
    before, after = tree.neighbours(low, low + size, own)
    found = []
    for start, step, there in ((own, after - own, after), (before, own - before, before)):
        near = (there >= 0) & (step < length) & (2 * step >= length)
        found.append((step[near], (start + first[at])[near], length[near]))
    period, start, length = (np.concatenate(part) for part in zip(*found, strict=True))
    if not len(start):
        return
    by = np.lexsort((start, period))
    period, start, length = period[by], start[by], length[by]
    heads = np.flatnonzero(np.r_[True, (period[1:] != period[:-1]) | (start[1:] > start[:-1] + length[1:])])
    tails = np.r_[heads[1:], len(start)] - 1
    yield from zip(start[heads].tolist(), (start + period + length)[tails].tolist(), period[heads].tolist(), strict=True)


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements of ``a`` and ``b`` agree; reads little more."""
    most, at, step = min(len(a), len(b)), 0, 16
    while at < most:
        differ = a[at:at + step] != b[at:at + step] if at + step <= most else a[at:most] != b[at:most]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 2
    return most


def runs_of(ids: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT
            ) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of a batch, by start and period. Document d
    is ``ids[bounds[d]:bounds[d + 1]]``."""
    sizes = np.diff(bounds)
    first, last = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    found = set()
    reach: dict[int, int] = {}
    if not len(ids):
        return []
    for start, end, period in progressions(ids, first, last, exponent):
        # Candidates of a period come by place: one inside the last run is part of it.
        if end <= reach.get(period, -1):
            continue
        low, high = int(first[start]), int(last[start])
        end += _agreeing(ids[end:high], ids[end - period:high - period])
        start -= _agreeing(ids[low:start][::-1], ids[low + period:start + period][::-1])
        reach[period] = end
        if end - start >= max(min_length, exponent * period):
            found.add((start, end, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def find_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT, batch_words: int = BATCH_WORDS,
              rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs by start and period
    (numbers of words), and the text collapsed to the first period of each run,
    its words joined by one space.

    Words are the stretches without ASCII white space of the whole text; a null or
    empty text has none, no runs, and collapses to an empty text. Runs have at
    least ``min_length`` words and ``min_exponent`` periods, which blocks can find
    from 4 on. ``rewrite`` may change a document's words before they are searched.
    Rows that repeat, tied or null ids come back as they are, one for one; other
    columns are not read."""
    if min_exponent < 4:
        raise ValueError("runs of fewer than four periods may hold no aligned block that shows their period")
    common.ship()

    def solve(keys: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: defaultdict = defaultdict()
        number.default_factory = lambda: len(number) + 1
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(words) for words in texts], out=bounds[1:])
        ids = np.fromiter((number[word] for words in texts for word in words), np.int64, int(bounds[-1]))
        found = runs_of(ids, bounds, min_length, min_exponent)
        owner = np.searchsorted(bounds, [start for start, _, _ in found], "right") - 1
        runs: list[list[dict]] = [[] for _ in texts]
        gone = np.zeros(len(ids) + 1, np.int64)
        for doc, (start, end, period) in zip(owner.tolist(), found, strict=True):
            runs[doc].append({"start": start - int(bounds[doc]), "length": end - start, "period": period})
            gone[start + period] += 1
            gone[end] -= 1
        kept = np.cumsum(gone[:-1]) == 0
        collapsed = [b" ".join(words) if not mine else b" ".join(
            word for word, stays in zip(words, kept[low:high].tolist(), strict=True) if stays)
            for words, mine, low, high in zip(texts, runs, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(np.diff(bounds)),
             pa.array(runs, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
             pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, size = [], [], 0
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = raw.split()
                if rewrite is not None:
                    words = rewrite(key, words)
                if texts and size + len(words) > batch_words:
                    yield solve(keys, texts)
                    keys, texts, size = [], [], 0
                keys.append(key)
                texts.append(words)
                size += len(words)
            if texts:
                yield solve(keys, texts)

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.whole(text).cast("binary").alias("text"))
            .mapInArrow(work, SCHEMA))
