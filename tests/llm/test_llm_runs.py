"""Periodic runs against a search of all periods and places."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from daypanel.llm import queries, runs
from tests_llm_data import LONG


def all_runs(words, min_length=6, exponent=4):
    found = set()
    for period in range(1, len(words) // exponent + 1):
        i = 0
        while i + period < len(words):
            if words[i] != words[i + period]:
                i += 1
                continue
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            length, piece = j + period - i, words[i:j + period]
            smaller = any(piece[q:] == piece[:-q] for q in range(1, period))
            if length >= max(min_length, exponent * period) and not smaller:
                found.add((i, j + period, period))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words, found):
    gone = {i for start, end, period in found for i in range(start + period, end)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_batches_of_random_words():
    rng = random.Random(3)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 6)):
            n, kinds = rng.randint(0, 70), rng.choice([1, 2, 3, 5, 40])
            words = [rng.randint(1, kinds) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randint(0, n - 1)
                p = rng.randint(1, max(1, (n - a) // 4))
                words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            docs.append(words)
        bounds = np.cumsum([0, *map(len, docs)])
        expected = [(int(b) + s, int(b) + e, p) for words, b in zip(docs, bounds) for s, e, p in all_runs(words)]
        got = runs.runs_of(np.array([w for words in docs for w in words], np.int64), bounds)
        assert got == sorted(expected, key=lambda run: (run[0], run[2]))


def test_wavelet_tree_neighbours():
    rng = np.random.default_rng(0)
    values = rng.permutation(500)
    tree = runs.WaveletTree(values)
    low = rng.integers(0, 499, 300)
    high = np.minimum(500, low + rng.integers(1, 60, 300))
    own = values[low + (high - low) // 2]
    before, after = tree.neighbours(low, high, own)
    for i in range(300):
        part = sorted(values[low[i]:high[i]].tolist())
        at = part.index(own[i])
        assert before[i] == (part[at - 1] if at else -1) and after[i] == (part[at + 1] if at + 1 < len(part) else -1)


def test_many_short_runs_and_nested_periods():
    square = [1, 1, 2] * 8
    words = [w for k in range(60) for w in [k + 10] * 6] + square + [9] + (square + [7]) * 5
    bounds = np.array([0, len(words)])
    assert runs.runs_of(np.array(words, np.int64), bounds) == all_runs(words)


def test_rows_with_every_oddity(table, odd_rows):
    rows = [*odd_rows, (40, "x y " * 50), (41, "a " * 9 + "b"), (41, "a " * 9 + "b"), (42, " é " * 12),
            (43, "one two " * 9), (44, "q\x1cr " * 7)]
    got = runs.find_runs(table(rows), batch_words=1000).collect()
    assert len(got) == len(rows)
    expected = []
    for doc_id, text in rows:
        words = split(text)
        found = [] if text == LONG else all_runs(words)
        expected.append((doc_id, len(words), [(s, e - s, p) for s, e, p in found], collapse(words, found)))
    key = lambda row: (str(row[0]), row[1], row[3])
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=key) == sorted(expected, key=key)
    assert not all_runs(split(LONG)[:2000])


def test_empty_table_and_too_few_periods(table):
    assert runs.find_runs(table([])).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(table([]), min_exponent=3)


def test_planted_words_and_query_digests(spark, tmp_path):
    doc_ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0] + [1, 2, -7]
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randint(0, 300)}" for _ in range(rng.randint(0, 120)))) for i in doc_ids] + [(None, "a a a"), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {row.doc_id: row for row in queries.op11_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        words = split(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = all_runs(words)
        best = min(((s - e, s, p) for s, e, p in found), default=None)
        row = got[doc_id]
        assert row.n_runs == len(found)
        assert (row.start, row.length, row.period, row.exponent_milli) == (
            (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2]))
        lines = "".join(f"{s},{e - s},{p}\n" for s, e, p in found)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapse(words, found).encode()).hexdigest()
