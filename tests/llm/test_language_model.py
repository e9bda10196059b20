import math
import re
import zlib
from collections import Counter

import pytest

from tests.llm import cases
from threadmood.llm import language_model

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    """Scores by dictionaries: (id, text) to (held_out, tokens, known, total, base, score)."""
    tokens = {row: WORD.findall((row[1] or "").translate(LOWER)) + [None] for row in rows}
    held = {row: zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 5 == 1 for row in rows}
    one, two = Counter(), Counter()
    for row in rows:
        if not held[row]:
            one.update(tokens[row])
            two.update(zip(["begin", *tokens[row]], tokens[row], strict=False))
    total, distinct = sum(one.values()), len(one)
    seen, kinds = Counter(), Counter()
    for (before, _), n in two.items():
        seen[before] += n
        kinds[before] += 1

    def alone(w):
        return (one[w] + 0.5) / (total + 0.5 * (distinct + 1))

    def after(h, w):
        return (two[h, w] + kinds[h] * alone(w)) / (seen[h] + kinds[h]) if seen[h] else alone(w)

    out = {}
    for row, own in tokens.items():
        base = sum(math.log10(alone(w)) for w in own)
        score = sum(math.log10(after(h, w)) for h, w in zip(["begin", *own], own, strict=False))
        out[row] = (held[row], len(own), sum(one[w] > 0 for w in own), total, base, score)
    return out


def test_scores_equal_dictionaries(spark, sf_dir):
    docs = cases.documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = Counter()
    for (i, _), own in brute(rows).items():
        n = rows.count((i, _))
        want[i, *own[:4], round(own[4], 6), round(own[5], 6)] += n
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    found = Counter(
        (*(r[n] for n in names), round(r["base_score"], 6), round(r["score"], 6)) for r in cases.collected(language_model.score(docs))
    )
    assert found == want


def test_hot_contexts_are_counted_in_parts(spark):
    rows = [(i, "the " + " the ".join(f"w{(i * j) % 50}" for j in range(30))) for i in range(40)]
    found = {r.doc_id: r.score for r in language_model.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (i, _), own in brute(rows).items():
        assert found[i] == pytest.approx(own[5])


def test_better_than_words_alone_on_held_out_text(spark, sf_dir):
    scored = language_model.score(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out")
    row = scored.selectExpr("sum(score) AS score", "sum(base_score) AS base").first()
    assert row.score > row.base


def test_empty_table(spark):
    assert language_model.score(cases.empty(spark)).count() == 0
