"""Quality: counts against plain loops, trees by their promises, verdicts by held-out labels."""

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from daypanel.llm import quality
from tests_llm_data import LONG

WHITE = " \t\n\x0b\x0c\r"


def counts_of(text):
    text = text or ""
    words = text.encode().split()
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {j for places in windows.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def odd(rows):
    return [*rows, (50, "a b c d e f g h " * 9), (51, "one two three four five six seven eight x one two three four five six seven eight"),
            (52, "l l\n \nl l\nl l \n\n"), (53, "| | * & <a> %"), (54, "a " * 7), (55, "a " * 9), (55, "a " * 9)]


def test_counts_of_odd_rows(table, odd_rows):
    rows = odd(odd_rows)
    got = quality.judge(table(rows), None).collect()
    expected = sorted(((i, *counts_of(text)) for i, text in rows), key=str)
    assert sorted(((r.doc_id, *(r[name] for name in quality.COUNTS)) for r in got), key=str) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)  # no model, no further verdict


def test_batches_do_not_change_counts(monkeypatch):
    texts = [(text or "").encode() for _, text in odd([(1, LONG), (2, None), (3, "x " * 40)])]
    whole = quality.statistics(texts)
    single = [quality.statistics([text]) for text in texts]
    for part in (0, 1):
        assert np.array_equal(whole[part], np.concatenate([s[part] for s in single]))
    monkeypatch.setattr(quality, "BATCH_WORDS", 10)
    parts = list(quality._batches([list(range(len(texts))), texts], 1))
    assert [t for part in parts for t in part[1]] == texts and len(parts) > 3


def noisy(n, seed):
    rng = np.random.default_rng(seed)
    values = rng.random((n, len(quality.FEATURES)))
    f = {name: i for i, name in enumerate(quality.FEATURES)}
    score = 2 * values[:, f["distinct"]] - 2 * values[:, f["symbols"]] + np.sin(6 * values[:, f["word_length"]])
    return values, (score + rng.normal(0, 0.4, n) > 0.3).astype(float)


def signs():
    return np.array([-1 if name in quality.MONOTONE else 0 for name in quality.FEATURES])


def test_more_of_a_monotone_feature_never_helps():
    values, labels = noisy(3000, 1)
    # A feature that truly helps, named monotone, must not be used against its sign.
    given = signs()
    given[quality.FEATURES.index("distinct")] = -1
    for sign in (signs(), given):
        trees = quality.boost(values, labels, sign)
        rng = np.random.default_rng(2)
        for i in np.flatnonzero(sign):
            more = values.copy()
            more[:, i] += rng.random(len(more))
            assert (trees.score(more) <= trees.score(values) + 1e-12).all()
    free = quality.boost(values, labels, np.zeros(len(quality.FEATURES), int))
    more = values.copy()
    more[:, quality.FEATURES.index("distinct")] += 0.3
    assert (free.score(more) > free.score(values)).any()


def test_trees_learn_and_arrays_score_like_a_walk():
    values, labels = noisy(4000, 3)
    trees = quality.boost(values, labels, signs(), trees=20)
    test, truth = noisy(2000, 4)
    scores = trees.score(test)
    assert ((scores >= 0.5) == truth).mean() > 0.82
    for row, score in zip(test[:50], scores[:50]):
        total = trees.base
        for t in range(20):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.leaf[t, node - trees.feature.shape[1]]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-9


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.fit(docs, labels)
    assert quality.fit(docs.repartition(5), labels.repartition(3)).score(np.zeros((1, 15))) == model.score(np.zeros((1, 15)))
    verdicts = quality.judge(docs, model).join(labels, "doc_id").filter(quality.held_out("doc_id")).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in verdicts)
    right = [(r.score >= quality.THRESHOLD) == (r.quality == 1) for r in verdicts]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_labels_that_teach_nothing(table):
    docs = table([(1, "a b c"), (2, "d e")])
    none = docs.select(F.col("doc_id"), F.lit(1).alias("quality"))
    assert quality.fit(docs, none) is None and quality.fit(docs, none.limit(0)) is None
    assert quality.fit(docs, docs.select("doc_id", F.lit(None).cast("int").alias("quality"))) is None
    assert quality.judge(table([]), None).count() == 0
