import random
import re

import numpy as np
import pytest

from tests.llm import cases
from threadmood.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs by trying every period at every place."""
    n, runs = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            smaller = (p for p in range(1, q) if q % p == 0)
            if length >= max(24, 3 * q) and not any(words[start : start + length - p] == words[start + p : start + length] for p in smaller):
                runs.append((start, length, q))
            i += i == start
    return sorted((start, length, q) for start, length, q in runs)


def collapsed(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in dropped)


def random_text(draw, letters):
    words = []
    while draw.random() < 0.9 and len(words) < 300:
        root = [draw.randrange(letters) for _ in range(draw.randrange(1, 40))]
        length = draw.randrange(20) if draw.random() < 0.4 else draw.randrange(5 * len(root) + 10)
        words += (root * (length // len(root) + 1))[:length]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 10])
def test_runs_of_random_texts(letters):
    draw = random.Random(letters)
    names = np.random.default_rng(letters).integers(0, 1 << 63, letters, dtype="uint64")
    for _ in range(60):
        texts = [random_text(draw, letters) for _ in range(draw.randrange(1, 5))]
        first = np.append(0, np.cumsum([len(words) for words in texts]))
        found = periodic.find_runs(names[np.array(sum(texts, []), int)], first)
        want = [(start + at, length, q) for words, at in zip(texts, first.tolist()) for start, length, q in brute(words)]
        assert list(zip(*(x.tolist() for x in found), strict=True)) == want


def test_work_does_not_grow_with_the_repeats():
    words = np.zeros(1_000_000, "uint64")  # half a billion pairs of equal words for each thousand
    words[500_000] = 1
    start, length, period = periodic.find_runs(words, np.array([0, len(words)]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0, 500_001], [500_000, 499_999], [1, 1])


def test_rows_equal_brute_force(spark, sf_dir):
    docs = cases.documents(spark, sf_dir)
    odd = [(1, "a b " * 30 + "c"), (2, "x " * 23), (3, "x " * 24), (4, "z " + "a b c\t\n" * 8), (5, "é  É " * 40), (5, "é  É " * 40), (None, "n " * 50)]
    odd = spark.createDataFrame(odd, "doc_id long, text string")
    rows = docs.unionByName(odd, allowMissingColumns=True)
    texts = [(r.doc_id, WORD.findall(r.text or "")) for r in rows.select("doc_id", "text").collect()]
    want = []
    for i, words in texts:
        runs = brute(words) if len(words) < 800 else None
        want.append((i, len(words), runs, None if runs is None else collapsed(words, runs)))
    found = []
    for row in periodic.periodic_runs(rows).collect():
        short = row.n_words < 800
        found.append((row.doc_id, row.n_words, [tuple(r) for r in row.runs] if short else None, row.collapsed if short else None))
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_columns_of_any_name_and_an_empty_table(spark):
    odd = spark.createDataFrame([("a", "w " * 30), (None, None)], "runs string, collapsed string")
    rows = periodic.periodic_runs(odd.withColumnRenamed("runs", "name"), "name", "collapsed").collect()
    assert sorted((r.name or "", r.n_words, r.collapsed) for r in rows) == [("", 0, ""), ("a", 30, "w")]
    assert periodic.periodic_runs(cases.empty(spark)).count() == 0
