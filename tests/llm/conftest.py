
import pytest
from pyspark.sql import functions as F

from tests_llm_data import LONG, PASSAGE

# Names the operators use inside; a caller's columns may have them too.
CLASHING = ("key", "row", "digest", "salt", "norm", "fingerprint", "score", "prediction", "features", "probability",
            "length", "n_words", "words", "piece", "block", "h", "t1", "t2", "mention", "part", "kept", "f", "b", "hash")


@pytest.fixture
def table(spark):
    """Makes a table of documents, with more columns whose names may clash."""
    def make(rows, clashing=CLASHING, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema).withColumns({name: F.lit(name) for name in clashing})
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows and near copies."""
    near = [f"p{i} q{i * 3} r{i * 5}" for i in range(300)]
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A b"), (6, "a  b"), (7, "ab"), (8, LONG), (9, LONG), (9, LONG),
        (10, "a b c d"), (None, "a b c d"), (None, None), (11, " ".join(near)), (12, " ".join([*near, "tail"])),
        (13, " ".join(["head", *near])), (14, "x " + PASSAGE), (15, PASSAGE + " y " + PASSAGE), (16, "é" * 400),
        (17, "é" * 401), (18, "unlike all the others, 漢字 and 👍🏽 too"), (-5, "a b c d")]
