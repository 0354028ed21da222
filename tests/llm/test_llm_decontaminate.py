import re

import pytest

from daypanel.llm import decontaminate
from tests_llm_data import LONG, PASSAGE


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i:i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                for item in windows.get(tuple(words[i:i + n]), ()):
                    hit.update(range(i, i + n))
                    found.add(str(item))
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


ITEMS = [(1, PASSAGE), (2, PASSAGE.upper() + " and then some"), (3, "a B"), (4, None), (5, "..."), (6, "漢字 AND"),
         (10, "word5 of5 word6 of6"), (7, PASSAGE), (8, "q3 r5 p2 q6 r10 p3 q9 r15 p4 q12 r20 p5 q15 r25 p6 q18"), (9, "a")]


def result(found):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=str)


def test_equals_brute_force(table, odd_rows):
    rows = [*odd_rows, (50, "so a B it is"), (51, "A-B"), (52, f"{PASSAGE}, {PASSAGE} {LONG[:3000]}")]
    docs, items = table(rows), table(ITEMS, schema="item_id long, text string")
    for bits in (24, 8):  # with a table so small that nearly all shingles pass it
        assert result(decontaminate.contamination(docs, items, table_bits=bits)) == brute(rows, ITEMS)
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(d) for d, n, hit, _ in brute(rows, ITEMS) if not (hit and 20 * hit >= n))


@pytest.mark.parametrize("rows, items", [([], ITEMS), ([(1, "a b"), (2, None)], []), ([(1, "a")], [(1, None), (2, "!")])])
def test_nothing_to_find(table, rows, items):
    docs, items_table = table(rows), table(items, schema="item_id long, text string")
    assert result(decontaminate.contamination(docs, items_table)) == brute(rows, items)
    assert decontaminate.without_contaminated(docs, items_table).count() == len(
        [r for r in brute(rows, items) if not r[2]])
