import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daypanel.llm import decontaminate, packing, simhash, toxicity

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"
OPERATORS = {
    "toxicity": lambda docs, items: toxicity.without_toxic(docs, toxicity.Model({}, None, None, 0.0)),
    "simhash": lambda docs, items: simhash.fingerprints(docs),
    "decontaminate": lambda docs, items: decontaminate.without_contaminated(docs, items),
    "packing": lambda docs, items: packing.token_pieces(docs)}


@pytest.fixture
def unset(spark):
    before = spark.conf.get(NAME, None)
    spark.conf.unset(NAME)
    yield
    spark.conf.unset(NAME) if before is None else spark.conf.set(NAME, before)


def largest_batch(docs):
    """Rows, and the bytes of the largest batch of texts that a Python task gets."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    return docs.select("text").mapInArrow(sizes, "n long, size long").agg(F.sum("n"), F.max("size")).first()


@pytest.mark.parametrize("operator", OPERATORS)
def test_texts_go_to_python_in_batches_of_bounded_bytes(spark, unset, operator):
    docs = spark.range(0, 2000, 1, 1).select(
        F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit(" word"), 2000)).alias("text"))
    items = spark.createDataFrame([(1, "not in any text")], "item_id long, text string")
    OPERATORS[operator](docs, items)
    rows, most = largest_batch(docs)
    assert rows == 2000 and most <= 5 << 20  # of 20 MB in one task


def test_a_text_longer_than_a_batch_and_a_value_of_the_session_are_kept(spark, unset):
    spark.conf.set(NAME, "100k")
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x " * 100_000), (3, None)], "doc_id long, text string")
    found = decontaminate.contamination(docs, spark.createDataFrame([(1, "b c")], "item_id long, text string"))
    assert spark.conf.get(NAME) == "100k"
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in found.collect()) == [(1, 4, 2), (2, 100_000, 0), (3, 0, 0)]
