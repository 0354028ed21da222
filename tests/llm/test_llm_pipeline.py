import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from daypanel.llm import toxicity
from test_llm_decontaminate import brute as brute_contamination
from test_llm_packing import check
from test_llm_simhash import all_pairs, groups, naive_fingerprint

SF = "/root/testdata/sf0.001"


def read(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The documents before and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs[-1], SF).write.parquet(str(folder / name))
        docs.append(spark.read.parquet(str(folder / name)))
    return docs


def test_stages_return_the_columns_of_documents(staged):
    for before, after in zip(staged[:-2], staged[1:-1], strict=True):
        assert after.columns == before.columns and after.subtract(before).count() == 0


def test_toxic_documents_go(spark, staged):
    model = toxicity.fit(staged[0], spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.s for r in toxicity.with_score(staged[0], model, "s").collect()}
    assert set(read(staged[1])) == {i for i, s in scores.items() if s < toxicity.THRESHOLD}


def test_exact_copies_go(staged):
    best = {}
    for doc_id, text in read(staged[1]).items():
        key = re.sub(r"[\x20\x09-\x0D]", "", text)
        best[key] = min(best.get(key, (1,)), (-len(text), doc_id))
    assert set(read(staged[2])) == {doc_id for _, doc_id in best.values()}


def test_near_copies_go(staged):
    prints = {i: naive_fingerprint(t) for i, t in read(staged[2]).items()}
    roots = groups(sorted(set(prints.values())), all_pairs(np.unique(np.array(list(prints.values()), np.uint64)), 3))
    first = {}
    for i in sorted(prints, reverse=True):
        first[roots[prints[i]]] = i
    assert set(read(staged[3])) == set(first.values())


def test_contaminated_documents_go(spark, staged):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = brute_contamination(list(read(staged[3]).items()), items)
    assert set(read(staged[4])) == {d for d, n, hit, _ in judged if not (hit and 20 * hit >= n)}


def test_the_rest_is_packed(staged):
    rows = staged[5].collect()
    assert {r.doc_id for r in rows} == set(read(staged[4]))
    assert check(rows, 4096) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_run_gives_the_last_stage(spark, staged):
    ran = corpus_pipeline.run(spark, SF)
    key = lambda rows: hashlib.sha256(repr(sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows)).encode()).hexdigest()
    assert key(ran.collect()) == key(staged[5].collect())
