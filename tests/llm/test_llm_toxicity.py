import random

import pytest
from pyspark.sql import functions as F

from daypanel.llm import toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("aeioulmnrst", k=rng.randint(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        text = rng.choices(words, k=rng.randint(20, 80))
        for _ in range(3 if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(["vilename", "vilenames", "badword", "grubling"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_scores_held_out_rows(spark, table):
    rows, labels = corpus(1200, 1)
    docs = table([*rows, (5000, None), (5001, ""), (5002, "b4dw0rd you " * 3000), (None, "badword"), (1, rows[1][1])])
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (1, labels[1][1]), (7000, 1), (None, 1), (8, None)],
                                                     "doc_id long, toxic int"), trees=8)
    scored = toxicity.with_score(docs, model, "result")
    assert scored.columns == [*docs.columns, "result"]
    found = {r.doc_id: r for r in scored.withColumn("held", toxicity.held_out("doc_id")).collect()}
    assert scored.count() == len(rows) + 5 and all(0 <= r.result <= 1 for r in found.values())
    truth = dict(labels)
    held = [(r.result, truth[i]) for i, r in found.items() if i in truth and r.held]
    assert len(held) > 200
    good = sum((score >= toxicity.THRESHOLD) == bool(label) for score, label in held)
    assert good / len(held) > 0.97
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_held_out_labels_are_not_read(spark, table):
    rows, labels = corpus(400, 2)
    docs, schema = table(rows), "doc_id long, toxic int"
    held = toxicity.held_out("doc_id")
    honest = spark.createDataFrame(labels, schema)
    forged = honest.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    of = lambda table_: sorted((r.doc_id, r.s) for r in toxicity.with_score(
        docs, toxicity.fit(docs, table_, trees=3), "s").collect())
    assert of(honest) == of(forged)


@pytest.mark.parametrize("labels, base", [([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0)])
def test_labels_of_one_kind_or_none(spark, table, labels, base):
    docs = table([(1, "a"), (2, "b"), (3, None)])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r.s for r in toxicity.with_score(docs, model, "s").collect()} == {base}


def test_empty_table(spark, table):
    model = toxicity.fit(table([]), spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert toxicity.with_score(table([]), model, "s").count() == 0


def test_features_are_finite_for_any_text():
    weights = toxicity.Weights({"bad": 3.0, "vile*": 2.0})
    for text in ["", "bad", "You BAD vilenesses!", "b4d b@d", "é" * 1000, "!!!", "\x00\n\t", "1" * 5000]:
        values = toxicity.features(text, weights)
        assert len(values) == toxicity.N_FEATURES and all(abs(v) < 1e6 for v in values)
    near = toxicity.features("you bad", weights)
    assert near[6] > 0 and toxicity.features("bad " + "x " * 20 + "you", weights)[6] == 0
