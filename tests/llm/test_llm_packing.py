import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daypanel.llm import packing
from daypanel.llm.tokens import VOCABULARY, Encoder


def test_ids_are_the_full_tokenizers(odd_rows):
    rng = random.Random(3)
    pieces = list("abcXYZ éÉß12²½ªµ'.,!<>|\u0085\x1c\x07漢字ıİΣςé́👍🏽\t\n") + ["'s", "'re", "<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 50))) for _ in range(1500)]
    full, own = Tokenizer.from_file(VOCABULARY), Encoder()
    for text in [*texts, *(t for _, t in odd_rows if t)]:
        ids = full.encode(text, add_special_tokens=False).ids
        assert own.packed(text.encode()) == np.array(ids, "<u4").tobytes(), text


def test_pieces_cover_each_document(table, odd_rows):
    full = Tokenizer.from_file(VOCABULARY)
    wanted = []
    for doc_id, text in odd_rows:
        ids = [*full.encode(text or "", add_special_tokens=False).ids, 1]
        wanted += [(doc_id, i // 4096, i, len(ids[i:i + 4096]), zlib.crc32(np.array(ids[i:i + 4096], "<u4").tobytes()))
                   for i in range(0, len(ids), 4096)]
    assert sorted(map(tuple, packing.token_pieces(table(odd_rows)).collect()), key=str) == sorted(wanted, key=str)


def check(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_valid_and_as_small_as_can_be(table):
    rng = random.Random(5)
    lengths = [rng.choice([rng.randint(1, 100), rng.randint(1, 60), 100]) for _ in range(2000)]
    rows = table([(i, n) for i, n in enumerate(lengths)], schema="doc_id long, length long", clashing=("block", "b", "s"))
    packed = packing.pack(rows, capacity=100, block=700)
    found = packed.collect()
    assert packed.columns == [*rows.columns, "sequence_id", "offset"]
    assert sorted((r.doc_id, r.length) for r in found) == list(enumerate(lengths))
    assert check(found, 100) <= -(-sum(lengths) // 100) + 3  # one sequence a block


def plain_best_fit(lengths, capacity):
    order = np.argsort(-lengths, kind="stable")
    return len(np.unique(packing.best_fit(lengths, order, np.full(len(lengths), -1, np.int32), capacity)))


def test_blocks_waste_nothing_at_their_ends(table, monkeypatch):
    """The sequences used do not grow with the number of blocks."""
    rng = random.Random(6)
    lengths = [rng.randint(1, 40) for _ in range(3000)]
    rows = table([(i, n) for i, n in enumerate(lengths)], schema="doc_id long, length long", clashing=("uid", "fill", "i", "p"))
    for block in (3000, 300, 100):
        found = packing.pack(rows, capacity=100, block=block).collect()
        assert sorted(r.doc_id for r in found) == list(range(3000))
        assert check(found, 100) <= -(-sum(lengths) // 100) + 1


def test_islands_beat_best_fit_decreasing():
    """Lengths of which two or three fill a sequence, where best fit is far from it."""
    rng = np.random.default_rng(2)
    triplets = []
    for _ in range(100):
        a = int(rng.integers(380, 490))
        b = int(rng.integers((1000 - a) // 2 - 60, (1000 - a) // 2 + 60))
        triplets += [a, b, 1000 - a - b]
    for lengths, share in ((rng.integers(250, 500, 1200), 0.96), (np.array(triplets), 0.97), (rng.integers(200, 700, 400), 0.995)):
        best = packing.evolve(lengths, [], 1000, packing.GENERATIONS, packing.POPULATION, rng)[0]
        assert np.bincount(best, weights=lengths).max() <= 1000
        assert packing.lower_bound(lengths, 1000) <= len(np.unique(best)) <= share * plain_best_fit(lengths, 1000)


def test_query_path_packs_tighter_than_best_fit(table):
    rng = np.random.default_rng(4)
    lengths = rng.integers(250, 500, 1200)
    rows = table([(i, int(n)) for i, n in enumerate(lengths)], schema="doc_id long, length long", clashing=("uid", "fill", "i", "p"))
    n = check(packing.pack(rows, capacity=1000).collect(), 1000)
    assert packing.lower_bound(lengths, 1000) <= n <= 0.96 * plain_best_fit(lengths, 1000)


def test_crossover_runs_even_where_best_fit_is_least(monkeypatch):
    calls, original = [], packing.crossover
    monkeypatch.setattr(packing, "crossover", lambda *a: (calls.append(1), original(*a))[1])
    lengths = np.array([10] * 100)
    population = packing.evolve(lengths, [], 100, 30, 4, np.random.default_rng(1))
    assert len(calls) == 2 and len(population) == 4 and len(np.unique(population[0])) == 10


def test_refill_places_every_piece_once():
    rng = np.random.default_rng(9)
    for _ in range(200):
        lengths = rng.integers(1, 60, rng.integers(1, 80))
        whole = packing.best_fit(lengths, rng.permutation(len(lengths)), np.full(len(lengths), -1, np.int32), 100)
        opened = np.where(rng.random(len(lengths)) < rng.random(), -1, whole)
        filled = packing.refill(lengths, opened, 100, rng)
        assert filled.min() == 0 and np.bincount(filled, weights=lengths).max() <= 100
        assert len(np.unique(filled)) == filled.max() + 1


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(8)
    lengths = rng.integers(1, 90, 300)
    nothing = np.full(300, -1, np.int32)
    mother, father = (packing.best_fit(lengths, rng.permutation(300), nothing, 100) for _ in range(2))
    child = packing.crossover(lengths, mother, father, 100, rng)
    assert child.min() == 0 and np.bincount(child, weights=lengths).max() <= 100


def test_odd_lengths_and_empty_tables(table):
    rows = table([(1, 0), (2, None), (3, 101), (4, 100), (4, 100), (5, 1)], schema="doc_id long, length long")
    found = {(r.doc_id, r.offset) for r in packing.pack(rows.drop("length").withColumn(
        "length", F.when(F.col("doc_id") < 4, F.element_at(F.array(F.lit(0), F.lit(None), F.lit(101)), F.col("doc_id").cast(
            "int"))).when(F.col("doc_id") == 4, 100).otherwise(1).cast("long")), capacity=100).collect()}
    assert found == {(1, None), (2, None), (3, None), (4, 0), (5, 0)}
    assert packing.pack(rows.filter("doc_id > 99").drop("length").withColumn("length", F.lit(1).cast("long"))).count() == 0
    assert packing.token_pieces(table([])).count() == 0
