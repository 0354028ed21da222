"""Ranked search against a score of every document for every item."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from daypanel.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def rank_all(docs, items, top=20):
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs = sum(bool(bag) for _, bag in bags)
    total = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
                        for t in terms(text) if bag[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:top], 1):
            rows.append((item_id, rank, doc_id, -score))
    return sorted(rows, key=str)


def found(spark, docs, items, extra=(), **options):
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumns({n: F.lit(n) for n in extra})
    right = spark.createDataFrame(items, "item_id long, text string").withColumns({n: F.lit(n) for n in extra})
    return sorted((tuple(row) for row in lexical.search(left, right, **options).collect()), key=str)


def corpus(seed, n, words=60):
    rng = random.Random(seed)
    word = lambda: f"W{min(int(rng.expovariate(0.15)), words)}"
    return [(i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(n)]


CLASHING = ("term", "bag", "m", "digest", "first", "class_no", "item_no", "score", "rank", "df", "tf", "times", "n_terms")


def test_every_rank_of_every_item(spark):
    docs, items = corpus(1, 300), corpus(2, 25)
    assert found(spark, docs, items) == rank_all(docs, items)


def test_copies_and_ties_beyond_the_places(spark):
    # One bag held by most documents, in any order of words; others tie with it.
    docs = [(i * 7 % 1009, " ".join(random.Random(i).sample(["a", "b", "c!", "D"], 4))) for i in range(400)]
    docs += [(2000 + i, "a b c d") for i in range(5)] + corpus(5, 60)
    items = [(1, "a"), (2, "A,B"), (3, "b w1 w2 w2"), (4, "zzz")]
    assert found(spark, docs, items) == rank_all(docs, items)


def test_blocks_of_items_give_the_same_ranks(spark):
    docs, items = corpus(3, 150), corpus(4, 30)
    assert found(spark, docs, items, block_terms=15) == rank_all(docs, items)
    assert found(spark, docs, items, top=3) == rank_all(docs, items, 3)


def test_scores_in_many_small_steps(spark, monkeypatch):
    docs, items = corpus(6, 80), corpus(7, 9)
    monkeypatch.setattr(lexical, "CELLS", 16)
    assert found(spark, docs, items) == rank_all(docs, items)


def test_oddities(spark, odd_rows):
    docs = [*odd_rows, (30, "İstanbul ÀB café"), (31, "istanbul àb café"), (32, "x y 1a-2B")]
    items = [(1, None), (2, ""), (3, "a B c"), (3, "a B c"), (None, "shared3 passage21 ÀB CAFÉ"), (4, "...!"), (5, "word1 of2 y 1A")]
    assert found(spark, docs, items, CLASHING) == rank_all(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, docs, [(1, None)]) == []
