"""The pipeline's near stage on corpora of one template, and the parts that it is made of, against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest

from vellum.llm import simhash


def template(n, low, high, seed=1, size=300):
    """Documents that differ from one text by a number of replaced words."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    rows = []
    for i in range(n):
        words = list(base)
        for p in rng.sample(range(size), rng.randrange(low, high)):
            words[p] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def similarities(rows):
    """All Jaccard similarities, by a product of the sets' indicators."""
    sets = [simhash.shingle_hashes(t) for _, t in rows]
    known, place = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([0, *map(len, sets)])
    count = np.bincount(place)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[place]
    x = np.zeros((len(rows), (count > 1).sum()), np.float32)
    for i in range(len(rows)):
        at = column[ends[i] : ends[i + 1]]
        x[i, at[at >= 0]] = 1
    sizes, both = np.diff(ends), x @ x.T
    return both / (sizes[:, None] + sizes - both)


def lowest(links, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("low,high,size", [(1, 14, 4096), (1, 14, 150), (2, 9, 4096), (0, 4, 150)])
def test_documents_of_one_template(spark, low, high, size):
    """No link is lost among documents that are all a little under 0.8 alike, nor where a shard is dealt to several tasks."""
    rows = template(700, low, high)
    alike = similarities(rows)
    links = [(a, b) for a, b in zip(*np.triu_indices(len(rows), 1), strict=True) if alike[a, b] >= 0.8]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), size=size).collect()}
    want = lowest(links, len(rows))
    assert sum(got[a] == got[b] for a, b in links) >= 0.99 * len(links) > 0
    assert all(want[i] == want[c] for i, c in got.items())


def test_sets_of_a_shard_are_compared_exactly(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.choice(2**32, 80, replace=False).astype(np.uint32)
    sets = [np.unique(np.r_[rng.choice(base, rng.integers(60, 80), replace=False), rng.integers(0, 2**32, rng.integers(0, 9)).astype(np.uint32)]) for _ in range(90)] + [np.zeros(0, np.uint32)] * 2
    for frequent, many in ((4096, 32), (16, 32), (4096, 1000)):
        monkeypatch.setattr(simhash.ShardSets, "FREQUENT", frequent)
        monkeypatch.setattr(simhash.ShardSets, "MANY", many)
        s = simhash.ShardSets([x.tobytes() for x in sets], 0.8)
        found = [s.alike(i, j) for i, j in combinations(range(90), 2)]
        want = [len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])) for i, j in combinations(range(90), 2)]
        assert found == want and any(want) and not all(want)
        assert not s.alike(0, 91)


def test_probes_meet_the_members_of_a_chunk():
    rows = template(120, 1, 10, seed=4)
    alike = similarities(rows)
    sets = [simhash.shingle_hashes(t) for _, t in rows]
    drawn = [simhash.sketch(h) for h in sets]
    hashes = [np.unique((h >> np.uint64(32)).astype(np.uint32)).tobytes() for h in sets]
    keys = [[7, *k[1:]] for _, k in drawn]
    all_links = [(a, b) for a, b in combinations(range(120), 2) if alike[a, b] >= 0.8]
    fps = [f for f, _ in drawn]
    alone = list(simhash.shard_pairs(fps, keys, hashes, 7, list(range(120)), [False] * 120, 0.8))
    assert lowest(alone, 120) == lowest(all_links, 120) and len(alone) < 120
    # The first 80 are joined among themselves; the others are looked up.
    first = lowest([(a, b) for a, b in all_links if b < 80], 80)
    probed = list(simhash.shard_pairs(fps, keys, hashes, 7, [*first, *range(80, 120)], [False] * 80 + [True] * 40, 0.8))
    want = lowest([(a, b) for a, b in all_links if a < 80], 120)
    assert lowest([*probed, *[(i, c) for i, c in enumerate(first) if i != c]], 120) == want
    # What shares an earlier key meets there.
    assert list(simhash.shard_pairs(fps, [[1, 7, *k[2:]] for k in keys], hashes, 7, list(range(120)), [False] * 120, 0.8)) == []
