"""Toxicity by gradient-boosted trees over dense features, isotonically
calibrated.

A lexicon of words and word beginnings is learned from labelled documents: terms
far more frequent in toxic ones. Features are its density and weight, how often
the second person stands near its terms, capitals, punctuation and obfuscation.
The trees learn from features whose lexicon came from the other half of the
training rows, so a term that only fits its own documents earns no trust; the
calibration uses rows that neither the lexicon nor the trees have seen.

Fitting reads a bounded sample of labelled rows (``train_rows``, those with the
smallest hashes of their ids); scoring reads every row and whole texts."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from daypanel.llm import common

TRAIN_ROWS = 16_000
LEXICON = 600
TREES, DEPTH = 20, 3
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7)
NEAR = 5
# Words that address the reader, in the corpus's languages.
SECOND_PERSON = frozenset((
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi",
    "ton", "ta", "tes", "vous", "votre", "vos", "usted", "ustedes", "ti", "tus", "vosotros"))
# Characters that stand in for letters.
STAND_INS = str.maketrans("0134578@$!|", "oieastbasii")
WORD = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"[^\W\d_][0-9@$!*#|.]+[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")
N_FEATURES = 15


def terms_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


class Weights(dict):
    """The largest lexicon weight of a word's terms; 0 for others."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        weight = max(self.lexicon.get(term, 0.0) for term in terms_of(word))
        if len(self) >= 300_000:
            self.clear()
        if len(word) <= 64:
            self[word] = weight
        return weight


def features(text: str, weights: Weights) -> list[float]:
    """The dense features of a whole text."""
    words = WORD.findall(text.lower())
    n = max(1, len(words))
    weight = np.fromiter(map(weights.__getitem__, words), np.float32, len(words))
    hits = np.flatnonzero(weight)
    second = np.flatnonzero(np.fromiter(map(SECOND_PERSON.__contains__, words), bool, len(words)))
    near = 0
    if len(hits) and len(second):
        at = np.searchsorted(second, hits)
        before = hits - second[np.maximum(at - 1, 0)]
        after = second[np.minimum(at, len(second) - 1)] - hits
        near = int((((before >= 0) & (before <= NEAR)) | ((after >= 0) & (after <= NEAR))).sum())
    raw = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(raw, minlength=128)
    capitals, letters = counts[65:91].sum(), counts[65:91].sum() + counts[97:123].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    size = max(1, len(raw))
    disguised = disguised_hits = 0
    if OBFUSCATED.search(text):
        for token in text.split():
            if OBFUSCATED.search(token):
                disguised += 1
                plain = NOT_LETTERS.sub("", token.lower().translate(STAND_INS))
                disguised_hits += bool(plain and (weights[plain] or weights[NOT_LETTERS.sub("", token.lower())]))
    triples = int(((raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2])).sum()) if len(raw) > 2 else 0
    shouted = len(re.findall(r"\b[A-Z]{3,}\b", text)) if capitals > 2 else 0
    return [math.log1p(len(words)), len(hits) / n, float(weight.sum()) / n, float(weight.max()) if len(words) else 0.0,
            math.log1p(len(hits)), math.log1p(len({words[i] for i in hits.tolist()})), near / n, len(second) / n,
            float(capitals / max(1, letters)), shouted / n, float((counts[33] + counts[63]) / size),
            float(marks / size), disguised / n, disguised_hits / n, triples / size]


def _features_of(text: Column, lexicon: dict[str, float]) -> Column:
    common.ship()

    @F.arrow_udf("array<double>")
    def work(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = Weights(lexicon)
        for batch in texts:
            yield pa.array((features(t.as_py(), weights) for t in batch), pa.list_(pa.float64()))

    return work(text)


def held_out(doc_id: str) -> Column:
    """Rows whose labels no model may see."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """What scoring needs. Without trees (labels of one kind or none) every text
    scores ``base``."""
    lexicon: dict[str, float]
    trees: object | None
    calibration: object | None
    base: float


def _term_counts(rows: DataFrame) -> DataFrame:
    """Documents of each kind that hold a term, by fold."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for fold, toxic, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                terms = {term for word in set(WORD.findall(text.lower())) if len(word) <= 64
                         for term in terms_of(word)}
                found.update((fold, toxic, term) for term in terms)
            folds, toxics, terms = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(folds, pa.int32()), pa.array(toxics, pa.int32()), pa.array(terms, pa.string()),
                 pa.array(found.values(), pa.int64())], ["fold", "toxic", "term", "n"])

    return (rows.select("fold", "toxic", "text").mapInArrow(count, "fold int, toxic int, term string, n long")
            .groupBy("term", "fold").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
                                         F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean")))


def _lexicon(counts: DataFrame, folds: list[int], n_toxic: int, n_clean: int, size: int) -> dict[str, float]:
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    rows = (counts.filter(F.col("fold").isin(folds)).groupBy("term")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .filter((F.col("toxic") >= max(3, n_toxic // 200)) & (F.col("toxic") > F.col("clean")))
            .withColumn("weight", odds).filter("weight > 2")
            .orderBy((F.col("toxic") * F.col("weight")).desc(), "term").limit(size).collect())
    return {row.term: float(row.weight) for row in rows}


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        train_rows: int = TRAIN_ROWS, lexicon: int = LEXICON, trees: int = TREES, depth: int = DEPTH) -> Model:
    """A model of ``labels`` (0 or 1; other values and nulls are left out, and one
    row that says 1 is enough), learned from at most ``train_rows`` of its rows that are not held out. Only
    texts and labels of those rows are read."""
    common.ship()
    common.bounded_batches(docs.sparkSession)
    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = common.smallest_hashes(known, train_rows, "doc_id")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10))
    # train_rows rows of 12 bytes: a proven bound.
    rows = common.durable(
        docs.select(F.col(doc_id).alias("doc_id"), common.whole(text).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("toxic", "text", F.when(part < 2, 2).otherwise((part % 2)).cast("int").alias("fold")))
    sizes = {(r.fold, r.toxic): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    total = sum(sizes.values())
    base = sum(n for (_, toxic), n in sizes.items() if toxic) / total if total else 0.0
    if any(not sizes.get((fold, toxic)) for fold in (0, 1) for toxic in (0, 1)):
        return Model({}, None, None, base)

    counts = common.durable(_term_counts(rows.filter("fold < 2")))
    of = lambda folds: _lexicon(counts, folds, sum(sizes[f, 1] for f in folds),
                                sum(sizes[f, 0] for f in folds), lexicon)
    crossed, full = {0: of([1]), 1: of([0])}, of([0, 1])
    learned = None
    for fold, words in (*crossed.items(), (2, full)):
        part = rows.filter(F.col("fold") == fold).select(
            F.col("toxic").cast("double").alias("label"), "fold",
            array_to_vector(_features_of(F.col("text"), words)).alias("features"))
        learned = part if learned is None else learned.unionByName(part)
    learned = common.durable(learned.coalesce(4))  # train_rows short vectors at most
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=32, seed=7).fit(learned.filter("fold < 2"))
    calibration = None
    if sizes.get((2, 0)) and sizes.get((2, 1)):
        raw = model.transform(learned.filter("fold = 2")).select(
            "label", vector_to_array("probability")[1].alias("features"))
        calibration = IsotonicRegression().fit(raw)
    return Model(full, model, calibration, base)


def with_score(docs: DataFrame, model: Model, name: str, *, text: str = "text") -> DataFrame:
    """``docs`` with the column ``name``: the probability that a text is toxic.
    Null and empty texts are scored like any others."""
    common.bounded_batches(docs.sparkSession)
    if model.trees is None:
        return docs.withColumn(name, F.lit(model.base))
    columns = docs.columns
    vector, raw, probability, prediction, score = (common.unused_name(docs, n) for n in (
        "features", "raw", "probability", "prediction", "score"))
    scored = docs.withColumn(vector, array_to_vector(_features_of(common.whole(text), model.lexicon)))
    trees = model.trees.copy().setFeaturesCol(vector).setPredictionCol(prediction)
    scored = trees.setProbabilityCol(probability).setRawPredictionCol(raw).transform(scored)
    scored = scored.withColumn(score, vector_to_array(probability)[1])
    if model.calibration is not None:
        scored = model.calibration.copy().setFeaturesCol(score).setPredictionCol(name).transform(scored)
    else:
        scored = scored.withColumn(name, F.col(score))
    return scored.select(*(F.col(f"`{c}`") for c in columns), F.least(F.greatest(F.col(name), F.lit(0.0)), F.lit(1.0)).alias(name))


def without_toxic(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    score = common.unused_name(docs, "toxicity")
    return with_score(docs, model, score, text=text).filter(F.col(score) < threshold).drop(score)
