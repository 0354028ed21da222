import collections
import hashlib
import random

import numpy as np
import pytest

from daypanel.llm import repeats, suffix


def brute(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    masks = []
    for text in texts:
        mask = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if seen[text[i:i + length]] > 1:
                mask[i:i + length] = True
        masks.append(mask)
    return masks


def wanted(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), text, mask in zip(rows, texts, brute(texts, length), strict=True):
        kept = bytes(np.frombuffer(text, np.uint8)[~mask])
        runs = int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
        out.append((doc_id, len(text), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256, bytes(r.kept)) for r in df.collect()),
                  key=str)


def mixed_rows(seed, n=120):
    rng, rows = random.Random(seed), []
    phrases = ["".join(rng.choices("abcdef é", k=rng.randint(10, 120))) for _ in range(8)]
    for i in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else "".join(rng.choices("abcdefghijkl ", k=rng.randint(0, 90)))
                 for _ in range(rng.randint(0, 5))]
        rows.append((i, "".join(parts)))
    return rows + [(1000, None), (1001, ""), (1002, "ab" * 100), (1003, "a" * 300), (None, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize("hot", [4096, 3])
def test_equals_brute_force(table, hot):
    rows = mixed_rows(hot)
    assert found(repeats.remove_repeats(table(rows), length=24, anchor=6, hot=hot)) == wanted(rows, 24)


def test_hot_passage_and_hot_copies(table):
    rng = random.Random(2)
    noise = lambda: "".join(rng.choices("abcdefghijklmnop", k=40))
    passage = "".join(rng.choices("qrstuvwxyz", k=90))
    rows = [(i, noise() + passage + noise()) for i in range(150)] + [(500 + i, "one text, many copies " * 3) for i in range(80)]
    assert found(repeats.remove_repeats(table(rows), length=30, anchor=8, hot=10)) == wanted(rows, 30)


def test_odd_rows_at_the_real_length(table, odd_rows):
    rows = [(d, t[:20_000] if t else t) for d, t in odd_rows]
    assert found(repeats.remove_repeats(table(rows))) == wanted(rows, 200)


def test_long_texts_are_cut_into_overlapping_segments(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 50)
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 400))) for _ in range(8)]
    seen = set()
    for buffer, parts in repeats._segments(enumerate(texts), 20):
        for text, offset, start, end in parts:
            assert bytes(buffer[start:end]) == texts[text][offset:offset + end - start]
            for i in range(end - start - 19):
                assert (text, offset + i) not in seen
                seen.add((text, offset + i))
    assert seen == {(t, i) for t, text in enumerate(texts) for i in range(len(text) - 19)}


@pytest.mark.parametrize("misled", [False, True])
def test_suffixes_sort_by_their_bytes(monkeypatch, misled):
    if misled:  # hashes that tell little make every group fall back to its bytes
        monkeypatch.setattr(suffix, "letters", lambda: np.ones(256, np.uint64))
    rng = random.Random(4)
    for _ in range(40):
        strings = [bytes(rng.choices(rng.choice([b"ab", b"abcdefgh"]), k=rng.randint(0, 25))) for _ in range(rng.randint(1, 50))]
        group = sorted(rng.randint(0, 4) for _ in strings)
        length = np.array([len(s) for s in strings])
        order, common = suffix.sort_suffixes(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(length) - length, length,
                                             np.array(group))
        key = lambda i: (group[i], strings[i])  # noqa: B023, E731
        assert [key(i) for i in order.tolist()] == sorted(map(key, range(len(strings))))
        for at in range(1, len(order)):
            a, b = order[at - 1], order[at]
            if group[a] != group[b]:
                assert common[at] == -1
            else:
                same = next((i for i, (x, y) in enumerate(zip(strings[a], strings[b], strict=False)) if x != y),
                            min(len(strings[a]), len(strings[b])))
                assert common[at] == same


def test_empty_table(table):
    assert repeats.remove_repeats(table([])).count() == 0


def test_lengths_beyond_the_anchors_reach_are_an_error(table):
    for length in (repeats.ANCHOR + 1024, repeats.ANCHOR - 1):
        with pytest.raises(ValueError, match="length must be"):
            repeats.remove_repeats(table([]), length=length)
