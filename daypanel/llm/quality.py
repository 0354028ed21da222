"""Quality rules: boosted trees over statistics of a document.

A pass over whole texts gives each document's counts (words, symbols, repeated
lines, words in repeated windows) and some shares derived from them. Trees are
boosted on the histograms of a bounded sample of labelled documents, with logistic
loss. Features named in ``MONOTONE`` may only lower the score as they grow: a split
on one is taken only if the side of larger values scores no higher, and the middle
of the two bounds all that grows below either side. The ensemble is kept as numpy
arrays of nodes, complete trees level by level, and all trees score all rows of a
batch at once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daypanel.llm import common

TRAIN_ROWS = 16_000
TREES, DEPTH, BINS = 60, 4, 64
RATE, RIDGE, LEAST_WEIGHT = 0.2, 1.0, 2.0
THRESHOLD = 0.5
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
BATCH_WORDS = 1 << 18

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeat_words", "capitals", "shouting", "punctuation",
            "digits", "distinct", "commonest", "doubled", "words_a_line", "closed_lines", "bare_tokens")
# More of these never raises a score.
MONOTONE = frozenset(("symbols", "dup_lines", "repeat_words", "doubled", "bare_tokens"))

_WHITE, _SYMBOLS, _CLOSING = b" \t\n\x0b\x0c\r", b"#*$%&|<>", b".!?:;\"')"


def _classes() -> np.ndarray:
    """Which bytes each count of a histogram adds up."""
    byte = np.arange(256)
    upper, lower, digit = (byte >= 65) & (byte <= 90), (byte >= 97) & (byte <= 122), (byte >= 48) & (byte <= 57)
    white = np.isin(byte, list(_WHITE))
    return np.stack([(byte & 0xC0) != 0x80, white, np.isin(byte, list(_SYMBOLS)), upper, upper | lower, digit,
                     np.isin(byte, list(b"!?")), (byte > 32) & (byte < 127) & ~upper & ~lower & ~digit], axis=1).astype(np.int64)


_CLASSES = _classes()
# Bytes that stand in a word of letters or digits.
_BARE = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def repeated_windows(ids: np.ndarray, doc: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Places whose window of ``size`` words occurs elsewhere in its document.

    Windows are numbered by pairs of shorter ones, up to double their length in a
    step; a window that occurs once is dropped, and so is all that contains it."""
    n = len(ids)
    at, length = np.arange(n), 1
    rank = (np.cumsum(np.r_[0, doc[1:] != doc[:-1]]) << int(ids.max(initial=1)).bit_length()) | ids
    while True:
        by = np.argsort(rank[at])
        at = at[by]
        value = rank[at]
        heads = np.flatnonzero(np.r_[True, value[1:] != value[:-1]][:len(at)])
        count = np.diff(np.r_[heads, len(at)])
        many = np.repeat(count > 1, count)
        low = np.repeat(heads, count)[many]
        at = at[many]
        if length >= size or not len(at):
            return at
        step = min(length, size - length)
        rank = np.full(n, -1, np.int64)
        rank[at] = low
        ahead = at + step
        fits = ahead + length <= last[at]
        at, ahead = at[fits], ahead[fits]
        fits = rank[ahead] >= 0
        at, ahead = at[fits], ahead[fits]
        paired = np.full(n, -1, np.int64)
        paired[at] = rank[at] * n + rank[ahead]
        rank, length = paired, length + step


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of whole texts in UTF-8: `COUNTS` (rows x 5, long) and `FEATURES`."""
    split = [text.split() for text in texts]
    number: defaultdict = defaultdict()
    number.default_factory = lambda: len(number) + 1
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(words) for words in split], out=bounds[1:])
    ids = np.fromiter((number[word] for words in split for word in words), np.int64, int(bounds[-1]))
    bare = np.zeros(len(number) + 1, bool)
    bare[1:] = [not word.strip(_BARE) for word in number]
    n_words = np.diff(bounds)
    doc, last = np.repeat(np.arange(len(texts)), n_words), np.repeat(bounds[1:], n_words)

    per_doc = lambda flags: np.bincount(doc, flags, len(texts)) if len(doc) else np.zeros(len(texts))
    covered = np.zeros(len(ids) + 1, np.int64)
    if len(ids):
        windows = repeated_windows(ids, doc, last, WINDOW)
        covered += np.bincount(windows, minlength=len(ids) + 1)
        covered -= np.bincount(windows + WINDOW, minlength=len(ids) + 1)
    repeat_words = per_doc(np.cumsum(covered[:-1]) > 0)
    doubled = per_doc(np.r_[False, (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])][:len(ids)])
    keys = np.sort(doc << int(ids.max(initial=1)).bit_length() | ids)
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    times, owner = np.diff(np.r_[heads, len(keys)]), doc[heads]
    commonest = np.zeros(len(texts), np.int64)
    np.maximum.at(commonest, owner, times)

    hist = np.stack([np.bincount(np.frombuffer(text, np.uint8), minlength=256) for text in texts])
    points, white, symbols, upper, letters, digits, shouts, marks = (hist @ _CLASSES).T
    lines, dup_lines, closed = (np.zeros(len(texts), np.int64) for _ in range(3))
    for i, text in enumerate(texts):
        full = [line for line in text.split(b"\n") if line and not line.isspace()]
        lines[i], dup_lines[i] = len(full), len(full) - len(set(full))
        closed[i] = sum(line.rstrip(_WHITE)[-1] in _CLOSING for line in full)

    n, chars, n_lines = np.maximum(n_words, 1), np.maximum(points, 1), np.maximum(lines, 1)
    counts = np.stack([n_words, points - white, symbols, dup_lines, repeat_words.astype(np.int64)], axis=1)
    values = np.stack([
        np.log1p(n_words), (points - white) / n, symbols / n, dup_lines / n_lines, repeat_words / n,
        upper / np.maximum(letters, 1), shouts / chars, marks / chars, digits / chars,
        np.bincount(owner, minlength=len(texts)) / n, commonest / n, doubled / n, n_words / n_lines, closed / n_lines,
        per_doc(bare[ids]) / n], axis=1)
    return counts, values


@dataclass
class Trees:
    """Complete trees as arrays of nodes, level by level: node i has the children
    2i + 1 and 2i + 2. ``feature`` and ``threshold`` are (trees, inner nodes),
    ``leaf`` is (trees, leaves)."""
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probabilities, for rows of features."""
        trees, inner = self.feature.shape
        if not trees or not len(values):
            return np.full(len(values), _sigmoid(self.base))
        first = (np.arange(trees) * inner)[:, None]
        rows = (np.arange(len(values)) * values.shape[1])[None, :]
        node, flat = np.zeros((trees, len(values)), np.int64), np.ascontiguousarray(values).ravel()
        while node[0, 0] < inner:
            right = flat[rows + self.feature.ravel()[first + node]] > self.threshold.ravel()[first + node]
            node = 2 * node + 1 + right
        leaves = self.leaf.shape[1]
        total = self.leaf.ravel()[(np.arange(trees) * leaves)[:, None] + node - inner].sum(axis=0)
        return _sigmoid(self.base + total)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def boost(values: np.ndarray, labels: np.ndarray, signs: np.ndarray, *, trees: int = TREES, depth: int = DEPTH,
          bins: int = BINS) -> Trees:
    """Trees for ``labels`` (0 or 1). ``signs`` has -1 for features whose growth
    may not raise a score, 1 for those that may not lower it, 0 for others."""
    n, n_features = values.shape
    cuts = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(cuts[f], values[:, f], "left") for f in range(n_features)], axis=1)
    flat = binned + np.arange(n_features) * bins
    share = float(np.clip(labels.mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    raw, inner, leaves = np.full(n, base), (1 << depth) - 1, 1 << depth
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    for t in range(trees):
        chance = _sigmoid(raw)
        gradient, weight = chance - labels, np.maximum(chance * (1 - chance), 1e-9)
        node = np.zeros(n, np.int64)
        bounds = np.array([[-np.inf, np.inf]])
        for level in range(depth):
            width, above = 1 << level, (1 << level) - 1
            own = node - above
            cell = (own[:, None] * (n_features * bins) + flat).ravel()
            g, h = (np.bincount(cell, np.repeat(x, n_features), width * n_features * bins).reshape(width, n_features, bins)
                    for x in (gradient, weight))
            gl, hl = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
            gt, ht = (x.sum(axis=2)[:, :, None] for x in (g, h))
            gr, hr = gt - gl, ht - hl
            low, high = bounds[:, 0, None, None], bounds[:, 1, None, None]
            left, right = (np.clip(-a / (b + RIDGE), low, high) for a, b in ((gl, hl), (gr, hr)))
            whole = np.clip(-gt / (ht + RIDGE), low, high)
            gain = _gain(left, gl, hl) + _gain(right, gr, hr) - _gain(whole, gt, ht)
            sign = signs[None, :, None]
            gain = np.where((hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT) | (sign * (right - left) < 0), -np.inf, gain)
            # Bins beyond a feature's last cut hold nothing to part.
            for f in range(n_features):
                gain[:, f, len(cuts[f]):] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            f, b = np.divmod(best, bins - 1)
            taken = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            following = np.repeat(bounds, 2, axis=0)
            for i in np.flatnonzero(taken).tolist():
                feature[t, above + i], threshold[t, above + i] = f[i], cuts[f[i]][b[i]]
                middle = (left[i, f[i], b[i]] + right[i, f[i], b[i]]) / 2
                if signs[f[i]]:
                    up, down = (2 * i + 1, 2 * i) if signs[f[i]] > 0 else (2 * i, 2 * i + 1)
                    following[up, 0], following[down, 1] = max(following[up, 0], middle), min(following[down, 1], middle)
            bounds = following
            goes = values[np.arange(n), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + goes
        place = node - inner
        g, h = np.bincount(place, gradient, leaves), np.bincount(place, weight, leaves)
        leaf[t] = RATE * np.clip(-g / (h + RIDGE), bounds[:, 0], bounds[:, 1])
        raw += leaf[t][place]
    return Trees(base, feature, threshold, leaf)


def _gain(value, gradient, weight):
    """By how much a node of this value lowers the loss."""
    return -(gradient * value + 0.5 * (weight + RIDGE) * value * value)


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learned from, so that verdicts can be judged."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _batches(columns: list[list], words_at: int) -> Iterator[list[list]]:
    """Rows in parts of at most ``BATCH_WORDS`` words, by an upper bound; a longer
    text is a part of its own."""
    low, size = 0, 0
    for i, text in enumerate(columns[words_at]):
        words = len(text) // 2 + 1
        if size and size + words > BATCH_WORDS:
            yield [column[low:i] for column in columns]
            low, size = i, 0
        size += words
    if low < len(columns[words_at]):
        yield [column[low:] for column in columns]


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        train_rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees | None:
    """Trees for the probability of label 1, or None where the labels are of one
    kind or missing. Learned on the driver from the statistics (not the texts) of at
    most ``train_rows`` labelled documents that are not held out, those with the
    smallest hashes of their ids; other values than 0 and 1 are left out, and one
    row that says 0 is enough. Repeated ids of documents are one example each row,
    up to the same bound."""
    common.ship()
    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    chosen = common.smallest_hashes(known, train_rows, "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for given, texts in _batches([batch.column(0).to_pylist(), batch.column(1).to_pylist()], 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(given, pa.int32()), pa.array(list(statistics(texts)[1]), pa.list_(pa.float64()))],
                    ["label", "features"])

    # train_rows rows of 12 bytes: a proven bound.
    rows = (docs.select(F.col(doc_id).alias("doc_id"), common.whole(text).cast("binary").alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("label", "text")
            .mapInArrow(work, "label int, features array<double>").limit(train_rows).collect())
    given = np.array([row.label for row in rows], np.float64)
    if len(set(given.tolist())) < 2:
        return None
    values = np.array([row.features for row in rows])
    by = np.lexsort((*values.T, given))  # whatever order the rows came in
    signs = np.array([-1 if name in MONOTONE else 0 for name in FEATURES])
    return boost(values[by], given[by], signs, trees=trees, depth=depth, bins=bins)


def judge(docs: DataFrame, model: Trees | None, *, doc_id: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, `COUNTS`, score, base_failed, kept.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in 8-word
    windows that occur twice or more. A document is kept if it did not fail and
    scores ``threshold`` or more; without a model every score is 1. A null or empty
    text has no words and fails. Repeated rows, tied and null ids come back one for
    one; other columns are not read."""
    common.ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in _batches([batch.column(0).to_pylist(), batch.column(1).to_pylist()], 1):
                counts, values = statistics(texts)
                scores = np.ones(len(texts)) if model is None else model.score(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), *(pa.array(column) for column in counts.T.copy()), pa.array(scores)],
                    ["doc_id", *COUNTS, "score"])

    schema = ", ".join(["doc_id long", *(f"{name} long" for name in COUNTS), "score double"])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.whole(text).cast("binary").alias("text"))
            .mapInArrow(work, schema).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)))
