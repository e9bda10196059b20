import random
import re

import pytest

from tests.llm import cases
from threadmood.llm import components, near_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, n):
    """{(id, text): (size, component)} over all pairs."""
    sets = {(i, text): shingles(text, n) for i, text in rows}
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = [key for key in sets if key[0] is not None and sets[key]]
    for a, first in enumerate(keys):
        x = sets[first]
        for second in keys[a + 1 :]:
            y = sets[second]
            if 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    low, high = sorted((find(first[0]), find(second[0])))
                    parent[high] = low
    return {key: (len(own), find(key[0]) if own and key[0] is not None else key[0]) for key, own in sets.items()}


@pytest.mark.parametrize("words", [2, 5])
def test_components_equal_all_pairs(spark, sf_dir, words):
    docs = cases.documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, words)
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_copies.near_copies(docs, words).collect()}
    expected = {(i, n, c, i == c) for (i, _), (n, c) in want.items() if i is not None}
    assert {row for row in found if row[0] is not None} == expected
    assert near_copies.near_copies(docs, words).count() == len(rows)


def family(size, seed=5):
    """Copies of one text with words changed, around the limit."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(size):
        words = list(base)
        for _ in range(draw.randrange(1, 14)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((i + 1, " ".join(words)))
    return rows


def test_a_large_family_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "LIST_PART", 40)
    monkeypatch.setattr(near_copies, "CLUSTER_PART", 30)
    rows = family(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2)
    found = {(r.doc_id, r.component_id) for r in near_copies.near_copies(docs, 2).collect()}
    assert found == {(i, c) for (i, _), (_, c) in want.items()}
    assert len({c for _, c in found}) < len(rows)


def test_links_of_a_group_are_fewer_than_its_members():
    links = list(near_copies._forest(500, lambda i, others: others % 2 == i % 2))
    assert len(links) == 498


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 95), (200, 200)]
    found = {(r.id, r.component) for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {(i, 1) for i in range(1, 61)} | {(90, 90), (95, 90), (100, 90)}


def test_empty_table(spark):
    assert near_copies.near_copies(cases.empty(spark)).count() == 0


def test_no_side_of_a_join_is_broadcast(spark, monkeypatch):
    plans = []

    def noted(df, name, stored=near_copies.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(near_copies, "stored", noted)
    monkeypatch.setattr(components, "stored", noted)
    text = " ".join(f"word{i}" for i in range(40))
    rows = spark.createDataFrame([(i, f"{text} end{i % 3}") for i in range(9)] + [(9, "other words"), (10, None)], "doc_id long, text string")
    found = near_copies.near_copies(rows, words=2)
    noted(found, "found")
    assert {r.doc_id: r.component_id for r in found.collect()} == {**dict.fromkeys(range(9), 0), 9: 9, 10: 10}
    assert sum("Join" in plan for plan in plans) > 3
    assert not any("Broadcast" in plan for plan in plans)
