import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from threadmood.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def grown(nodes, fan):
    """All levels of a tree over the nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + fan])) for i in range(0, len(below), fan)])
    return levels


def climbed(levels, at, node, fan):
    """The root with ``node`` in place of a leaf, and all siblings on the way."""
    siblings = []
    for level in levels[:-1]:
        first = at // fan * fan
        run = level[first : first + fan]
        siblings += run[: at - first] + run[at - first + 1 :]
        node, at = digest("".join([*run[: at - first], node, *run[at - first + 1 :]])), at // fan
    return node, siblings


def brute(rows, fan):
    """(id, leaf, subroot, root, proof, folded root) of rows (id, group, leaf, instead)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    keys = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3] is not None, r[3] or ""))
    trees = {key: grown([r[2] for r in groups[key]], fan) for key in keys}
    top = grown([trees[key][-1][0] for key in keys], fan)
    out = []
    for n, key in enumerate(keys):
        for i, (row_id, _, leaf, instead) in enumerate(groups[key]):
            subroot, siblings = climbed(trees[key], i, instead or leaf, fan)
            root, more = climbed(top, n, subroot, fan)
            out.append((row_id, leaf, trees[key][-1][0], top[-1][0], digest("".join(siblings + more)), root))
    return out


def made(sizes):
    rows = []
    for g, size in enumerate(sizes):
        for i in range(size):
            leaf = digest(f"{g} {i}")
            rows.append((g * 10_000 + i, None if g == 0 else f"é{g}" if g % 2 else f"Z{g}", leaf, digest(leaf) if i % 3 == 0 else None))
    return rows + rows[-2:] + [(None, "Z2", digest("no id"), None), (None, None, digest("no id"), digest("x"))]


def found_in(spark, rows):
    df = spark.createDataFrame(rows, "id_ long, key string, digest_ string, changed string").repartition(7)
    built = merkle.build(df, "id_", "key", "digest_", "changed")
    return [tuple(r)[:6] for r in merkle.proofs(built).collect()], built


@pytest.mark.parametrize(("fan", "levels"), [(16, 3), (2, 1), (3, 2)])
def test_trees_of_all_sizes_equal_brute_force(spark, monkeypatch, fan, levels):
    for name, value in {"FAN": fan, "LEVELS": levels, "CHUNK": fan**levels}.items():
        monkeypatch.setattr(merkle, name, value)
    rows = made([3, 1, 16, 17, 33] + [2] * 15) if fan == 16 else made([5, 1, 2, 3, 9, 20])
    found, _ = found_in(spark, rows)
    assert sorted(found, key=repr) == sorted(brute(rows, fan), key=repr)


def test_a_tree_beyond_one_chunk(spark):
    rows = [(i, "a", digest(str(i)), digest("other") if i in (0, 4095, 4096, 4999) else None) for i in range(5000)]
    found, built = found_in(spark, rows)
    assert sorted(found) == sorted(brute(rows, 16))
    assert sum(r[5] != built.root for r in found) == 4


def test_digests_of_rows(spark):
    df = spark.createDataFrame([(1, None, "é"), (None, "", "a:b")], "n long, a string, b string")
    rows = df.select(merkle.digest_of(*(F.col(c) for c in df.columns)).alias("d")).collect()
    assert [r.d for r in rows] == [digest("1:1-2:é"), digest("-0:3:a:b")]


def test_odd_rows_keep_their_count_and_verify(spark, sf_dir):
    docs = cases.documents(spark, sf_dir).withColumn("leaf_", merkle.digest_of(F.col("doc_id"), F.col("text"))).withColumn("total", F.lit(1))
    found = merkle.proofs(merkle.build(docs, "doc_id", "key", "leaf_"))
    assert found.count() == found.where("verified").count() == docs.count()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id_ long, key string, digest_ string")
    built = merkle.build(empty, "id_", "key", "digest_")
    assert built.root is None
    assert merkle.proofs(built).count() == 0
