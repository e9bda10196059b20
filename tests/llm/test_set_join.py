import random

import numpy as np
import pytest

from tests.llm import cases
from tests.llm.test_near_copies import shingles
from threadmood.llm import groups, set_join


def brute(rows, words=4, percent=85):
    """{(id, set size, component)} over all pairs of different sets."""
    by_set = {}
    for i, text in rows:
        by_set.setdefault(shingles(text, words), set()).add(i)
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def join(a, b):
        low, high = sorted((find(a), find(b)))
        parent[high] = low

    kept = [(own, sorted(i for i in ids if i is not None)) for own, ids in by_set.items() if own]
    kept = [(own, ids) for own, ids in kept if ids]
    for own, ids in kept:
        for other in ids[1:]:
            join(ids[0], other)
    for k, (own, ids) in enumerate(kept):
        for other, more in kept[k + 1 :]:
            if 100 * min(len(own), len(other)) >= percent * max(len(own), len(other)):
                both = len(own & other)
                if 100 * both >= percent * (len(own) + len(other) - both):
                    join(ids[0], more[0])
    return sorted(((i, len(shingles(text, words)), i if i is None else find(i)) for i, text in rows), key=repr)


def found_in(docs, **options):
    return sorted((tuple(r) for r in set_join.set_join(docs, **options).collect()), key=repr)


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (2, 60)])
def test_components_equal_all_pairs(spark, sf_dir, words, percent):
    docs = cases.documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found_in(docs, words=words, percent=percent) == brute(rows, words, percent)


def family(size, seed, edits, base_words=150):
    """Copies of one text with words changed, around the limit, and a chain that drifts away."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(base_words)]
    rows, drifting = [], list(base)
    for i in range(size):
        words = list(base)
        if i % 5 == 0:
            drifting[draw.randrange(base_words)] = f"y{draw.randrange(10**6)}"
            words = list(drifting)
        else:
            for _ in range(draw.randrange(1, edits)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((seed * 1000 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("edits", [5, 12])
def test_large_families_in_parts(spark, monkeypatch, edits):
    for name, value in {"LIST_PART": 20, "CLUSTER_PART": 16, "SHORT_LIST": 6}.items():
        monkeypatch.setattr(set_join, name, value)
    rows = family(150, 5, edits) + family(60, 6, edits) + [(i, "a passage that stands in many texts " * 2 + f"{i} " * 3) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert 3 < len({c for _, _, c in want}) < len(rows)
    assert found_in(docs) == want


def test_derived_overlaps_equal_counted_ones():
    draw = np.random.default_rng(3)
    base = draw.choice(10_000, 300, replace=False).astype("uint64")
    sets = [np.unique(np.where(draw.random(300) < 0.05, draw.integers(20_000, 30_000, 300), base)).astype("uint64") for _ in range(40)]
    overlaps = set_join.Overlaps(sets)
    leader = overlaps(0)
    for i, own in enumerate(sets):
        assert overlaps(i).tolist() == [len(np.intersect1d(own, other)) for other in sets]
    assert overlaps.known[0] == 0 and leader is overlaps.known[1]


def test_needed_intersections():
    for a in range(1, 60):
        for b in range(1, 60):
            least = min(k for k in range(61) if 100 * k >= 85 * (a + b - k))
            assert set_join.needed(np.array([a + b]), 85)[0] == least


def test_empty_table(spark):
    assert set_join.set_join(cases.empty(spark)).count() == 0


def test_spanning_links_connect_the_same():
    draw = np.random.default_rng(4)
    for n in (2, 30, 400):
        u, v = draw.integers(0, n, (2, n), dtype="int64") * 7
        a, b = groups.spanning(u, v)
        assert len(a) < len(np.unique([u, v]))
        roots = dict(zip(a.tolist(), b.tolist(), strict=True))
        parent = {i: i for i in np.unique([u, v]).tolist()}

        def find(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for x, y in zip(u.tolist(), v.tolist(), strict=True):
            low, high = sorted((find(x), find(y)))
            parent[high] = low
        assert {i: roots.get(i, i) for i in parent} == {i: find(i) for i in parent}


def test_digests_differ_in_no_more_bits_than_sets_in_shingles():
    draw = np.random.default_rng(8)
    for width in (512, 4096):
        one = np.unique(draw.integers(0, 1 << 60, 700, dtype="uint64"))
        other = np.unique(np.concatenate([one[::2], draw.integers(0, 1 << 60, 40, dtype="uint64")]))
        both, bounds = np.concatenate([one, other]), np.array([0, len(one), len(one) + len(other)])
        a, b = (np.frombuffer(x, "uint64") for x in set_join._digests(both, bounds, np.array([width, width])))
        assert 0 < np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(one, other))
        half = np.frombuffer(set_join._digests(one, bounds[:2], np.array([width // 2]))[0], "uint64")
        assert (half == a[: len(half)] ^ a[len(half) :]).all()


def test_rows_are_only_left_out_where_their_id_is_not_wanted(spark):
    ids = spark.range(0, 1000, 7)
    kept = {r.id for r in set_join.only_some(spark.range(1000), ids).collect()}
    assert {r.id for r in ids.collect()} <= kept
    assert len(kept) < 200
