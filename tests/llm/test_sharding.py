import zlib
from collections import Counter, defaultdict

from tests.llm import cases
from threadmood.llm import sharding


def placed(df, **options):
    return cases.collected(sharding.shard(df, **options))


def test_law_slots_and_columns(spark, sf_dir):
    docs = cases.documents(spark, sf_dir)
    rows = placed(docs)
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == texts
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(8))
    counts = [len(own) for own in slots.values()]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_groups_stay_together_but_where_one_is_larger_than_a_shard(spark):
    rows = [(i, f"text {i % 40}") for i in range(400)] + [(1000 + i, f"alone {i}") for i in range(400)]
    rows += [(5000 + i, "very common") for i in range(400)]
    found = placed(spark.createDataFrame(rows, "doc_id long, text string"))
    shards = defaultdict(set)
    text = dict(rows)
    for r in found:
        shards[text[r["doc_id"]]].add(r["shard"])
    cut = sum(len(shards[f"text {i}"]) > 1 for i in range(40))
    assert cut <= 8 and 3 <= len(shards["very common"]) <= 8
    assert max(Counter(r["shard"] for r in found).values()) == 150


def test_few_rows_and_none(spark):
    assert placed(cases.empty(spark)) == []
    rows = placed(spark.createDataFrame([(1, None), (None, ""), (1, None)], "doc_id long, text string"))
    assert sorted(r["size"] for r in rows) == [1, 1, 1] and len({r["shard"] for r in rows}) == 3
    assert {r["slot"] for r in rows} == {0}
