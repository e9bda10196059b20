import random

import numpy as np
import pytest

from threadmood.llm import neighbours


def brute(rows, every=50, k=5):
    valid = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            valid[i] = np.array(v, float)
    out = {}
    for i, v in valid.items():
        if i % every == 0:
            near = [(-(v * w).sum() / np.sqrt((v * v).sum()) / np.sqrt((w * w).sum()), j) for j, w in valid.items() if j != i and len(w) == len(v)]
            out[i] = sorted(near)[:k]
    return out


def found(df):
    out = {}
    for r in sorted(neighbours.nearest(df).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_recall_on_the_table(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want, got = brute(rows), found(df)
    assert set(want) == set(got)
    hits = sum(len({j for _, j in own} & {j for _, j, _ in got[i]}) for i, own in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    for i, own in got.items():
        scores = dict((j, -s) for s, j in brute([(i, dict(rows)[i]), *((j, dict(rows)[j]) for _, j, _ in own)])[i])
        assert [rank for rank, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(scores[j] == pytest.approx(s, abs=1e-12) for _, j, s in own)
        assert own == sorted(own, key=lambda x: (-x[2], x[1]))


def test_few_rows_ties_copies_and_what_takes_no_part(spark):
    rows = [
        (0, [1.0, 0.0]),
        (7, [1.0, 0.0]),
        (3, [1.0, 0.0]),
        (9, [0.0, 1.0]),
        (11, [-1.0, 0.5]),
        (50, [0.0, 0.0]),
        (100, None),
        (150, [1.0, None]),
        (200, [float("nan"), 1.0]),
        (250, [float("inf"), 1.0]),
        (300, []),
        (None, [1.0, 0.0]),
        (350, [1.0, 2.0, 3.0]),
        (400, [3.0, 2.0, 1.0]),
        (400, [3.0, 2.0, 1.0]),
    ]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, bucket string, part int")
    got = found(df)
    want = {i: [(rank + 1, j, -s) for rank, (s, j) in enumerate(own)] for i, own in brute(rows).items()}
    assert {i: [x[:2] for x in own] for i, own in got.items()} == {i: [x[:2] for x in own] for i, own in want.items() if own}


def test_a_very_common_vector(spark):
    draw = random.Random(3)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(1, 300)] + [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(300, 600)]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert [j for _, j, _ in got[50]] == [1, 2, 3, 4, 5]
    assert set(got) == {i for i, _ in rows if i % 50 == 0}


def test_empty_table(spark):
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_a_bucket_of_near_equal_vectors_is_compared_in_parts(spark, monkeypatch):
    draw = random.Random(4)
    rows = [(i, [1 + draw.random() / 1e4, *(draw.random() / 1e4 for _ in range(3))]) for i in range(2000)]
    rows += [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(2000, 4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    whole, compare = found(df), neighbours._compare

    def bounded(queries, rows, schema):
        if rows.num_rows > 200 or queries.num_rows > 25:
            raise ValueError(f"{rows.num_rows} rows and {queries.num_rows} queries in one group")
        return compare(queries, rows, schema)

    monkeypatch.setattr(neighbours, "_compare", bounded)
    monkeypatch.setattr(neighbours, "PART_ROWS", 100)
    monkeypatch.setattr(neighbours, "PART_QUERIES", 8, raising=False)
    assert found(df) == whole
    near = {i: [j for _, j in own] for i, own in brute(rows[:2000]).items()}
    assert all([j for _, j, _ in whole[i]] == own for i, own in near.items())


def test_many_vectors_of_one_direction(spark):
    rows = [(i, [float(i + 1), 2.0 * (i + 1)]) for i in range(30_000)]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    assert len(got) == 600 and all(len(own) == 5 for own in got.values())


def test_tight_and_loose_clusters(spark):
    draw = np.random.default_rng(7)

    def clusters(count, size, spread):
        centres = draw.normal(size=(count, 1, 32))
        return (centres + spread * draw.normal(size=(count, size, 32))).reshape(-1, 32)

    vectors = np.concatenate([clusters(10, 250, 0.02), clusters(150, 10, 0.6)])
    vectors = vectors[draw.permutation(len(vectors))]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    hits = total = loose = loose_total = 0
    for i in range(0, len(vectors), 50):
        scores = units @ units[i]
        scores[i] = -2
        want = np.argsort(-scores)[:5]
        own = len({j for _, j, _ in got[i]} & set(want.tolist()))
        hits, total = hits + own, total + 5
        if scores[want[-1]] < 0.99:
            loose, loose_total = loose + own, loose_total + 5
    assert loose_total >= 50 and loose >= 0.9 * loose_total
    assert hits >= 0.95 * total
