import numpy as np
import pytest
import xxhash

from daypanel.llm import simhash
from daypanel.llm.components import components


def naive_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, links):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {p: find(p) for p in points}


def all_pairs(points, bits):
    near = np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= bits, 1)
    return [(int(points[a]), int(points[b])) for a, b in zip(*np.nonzero(near), strict=True)]


def flipped(rng, points, n):
    for _ in range(n):
        points = points ^ (np.uint64(1) << rng.integers(0, 64, len(points)).astype(np.uint64))
    return points


@pytest.mark.parametrize("dense", [0, 900])
def test_trees_lose_no_link(dense):
    rng = np.random.default_rng(dense)
    points = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    points = np.unique(np.r_[points, flipped(rng, points[:200], 3), flipped(rng, np.full(dense, points[0]), 5)])
    wanted = groups(points.tolist(), all_pairs(points, 3))
    for leaf in (64, 256, 4000):
        a, b = simhash.link_shard(points, 3, leaf)
        assert groups(points.tolist(), zip(a.tolist(), b.tolist(), strict=True)) == wanted
    nodes, links = simhash.build_tree(rng.choice(points, 300, replace=False), 30, 3), []
    for _, here in simhash.route(nodes, points, 3):
        links += zip(*(x.tolist() for x in simhash.link_shard(here, 3, 64)), strict=True)
    assert groups(points.tolist(), links) == wanted


def test_a_dense_group_gives_few_links():
    rng = np.random.default_rng(1)
    points = np.unique(flipped(rng, np.full(3000, 7, np.uint64), 3))
    a, _ = simhash.link_leaf(points, 3, 100)
    assert len(a) < len(points)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(500, 500)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 400)}


def test_groups_equal_brute_force(table, odd_rows):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(4000)]
    rows = list(odd_rows)
    for i in range(60):
        base = rng.choice(words, 200).tolist()
        rows.append((1000 + 3 * i, " ".join(base)))
        rows.append((1001 + 3 * i, " ".join(["extra", *base])))
        rows.append((1002 + 3 * i, "  ".join(base).upper()))
    prints = [naive_fingerprint(text) for _, text in rows]
    points = np.unique(np.array(prints, np.uint64))
    roots = groups(points.tolist(), all_pairs(points, 3))
    first = {}
    for (doc_id, _), p in zip(rows, prints, strict=True):
        if doc_id is not None:
            first[roots[p]] = min(first.get(roots[p], doc_id), doc_id)
    wanted = sorted(((d, p, first.get(roots[p])) for (d, _), p in zip(rows, prints, strict=True)), key=str)
    found = simhash.near_groups(table(rows), shard=20, leaf=16)
    assert sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in found.collect()), key=str) == wanted
    kept = simhash.keep_first(table(rows))
    assert kept.columns == table(rows).columns
    stays = {roots[p]: first.get(roots[p]) for p in prints}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, stays.values()))


def test_of_rows_that_repeat_one_stays(table):
    far = [" ".join(f"{w}{i * 7 % 13}" for i in range(60)) for w in ("one", "two", "three", "four")]
    rows = [(5, far[0])] * 3 + [(5, far[1]), (5, far[1].upper()), (6, far[0]), (None, far[2]), (None, far[2]), (None, far[3])] + [
        (9, None), (9, "")]
    prints = {t: naive_fingerprint(t) for t in far}
    assert all((prints[a] ^ prints[b]).bit_count() > 3 for a in far for b in far if a != b)
    kept = sorted(((r.doc_id, (r.text or "").lower()) for r in simhash.keep_first(table(rows)).collect()), key=str)
    assert kept == sorted([(5, far[0]), (5, far[1]), (None, far[2]), (None, far[3]), (9, "")], key=str)


def test_empty_table(table):
    assert simhash.near_groups(table([])).count() == 0
    assert simhash.keep_first(table([])).count() == 0
