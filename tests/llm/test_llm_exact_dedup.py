import hashlib
import re

import pytest
from pyspark.sql import functions as F

from daypanel.llm import exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(norm(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    best = {n: min(g)[-1] for n, g in groups.items()}
    return sorted(((d, rows[best[norm(t)]][0], len(groups[norm(t)]), i == best[norm(t)]) for i, (d, t) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.lit("same"), lambda c: F.substr(c, F.lit(1), F.lit(1))])
def test_equals_brute_force_whatever_the_digest(table, odd_rows, digest):
    assert result(exact_dedup.exact_groups(table(odd_rows), digest=digest)) == brute(odd_rows)


def test_hot_text_meets_in_small_groups(table):
    rows = [(i, "the same text") for i in range(3000)] + [(9000 + i, f"text {i}") for i in range(50)]
    assert result(exact_dedup.exact_groups(table(rows), salts=8)) == brute(rows)


def test_keeps_one_row_of_a_group_with_all_its_columns(table, odd_rows):
    for rows in (odd_rows, odd_rows[:4], [(1, "a"), (2, "b")]):
        docs = table(rows)
        kept = exact_dedup.keep_best(docs)
        assert kept.columns == docs.columns
        found = kept.collect()
        assert sorted((str(r.doc_id), norm(r.text)) for r in found) == sorted(
            (str(d), n) for n in {norm(t) for _, t in rows}
            for d, t in [min((r for r in rows if norm(r[1]) == n), key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))])


REPEATS = [(5, "t"), (5, "t"), (7, "x y"), (7, "xy"), (7, "x y"), (8, "xy"), (None, "n"), (None, "n"), (None, "m"), (3, "m"),
           (4, "p q"), (4, "pq "), (6, None), (6, ""), (6, None)]


def test_of_rows_that_repeat_one_stays(table, monkeypatch):
    for most in (exact_dedup._WRITTEN_OUT, 1, 2):
        monkeypatch.setattr(exact_dedup, "_WRITTEN_OUT", most)
        assert result(exact_dedup.exact_groups(table(REPEATS))) == brute(REPEATS)
    kept = [(r.doc_id, norm(r.text)) for r in exact_dedup.keep_best(table(REPEATS)).collect()]
    assert sorted(kept, key=str) == sorted([(5, "t"), (7, "xy"), (None, "n"), (3, "m"), (4, "pq"), (6, "")], key=str)
    hot = [(1, "same")] * 3000 + [(2, "same")] * 10 + [(3, "other")]
    monkeypatch.setattr(exact_dedup, "_WRITTEN_OUT", 100)
    assert result(exact_dedup.exact_groups(table(hot))) == brute(hot)
    assert sorted(r.doc_id for r in exact_dedup.keep_best(table(hot)).collect()) == [1, 3]


def test_empty_table(table):
    assert result(exact_dedup.exact_groups(table([]))) == []
    assert exact_dedup.keep_best(table([])).count() == 0


def test_digest_is_of_the_normalised_text(table):
    row = exact_dedup.exact_groups(table([(1, "a\x0bb c")])).first()
    assert bytes(row.text_digest).hex() == hashlib.sha256(b"abc").hexdigest()
