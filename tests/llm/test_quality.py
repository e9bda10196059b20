import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm import cases
from threadmood.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_measures_and_base_rules(spark, sf_dir):
    docs = cases.documents(spark, sf_dir)
    texts = Counter((row.doc_id, row.text) for row in docs.select("doc_id", "text").collect())
    judged = quality.judged(docs, whole=True)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    seen = Counter()
    for row in cases.collected(judged):
        text = row["row"]["text"]
        seen[row["doc_id"], text] += 1
        own = counted(text)
        assert tuple(row[name] for name in names) == own
        assert row["base_failed"] == (own[0] < 10 or 100 * own[4] > 20 * own[0])
        assert row["kept"] == (not row["base_failed"] and row["quality"] >= 0.5)
        assert row["row"]["key"] == "extra key"
    assert seen == texts


def test_rules_agree_with_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.join(labels, "doc_id").select("doc_id", F.col("quality").alias("good"))
    kept = quality.judged(docs).where("NOT base_failed").join(rows, "doc_id")
    assert kept.where("kept != (good = 1)").count() <= 0.01 * kept.count()


def test_abstaining_says_nothing_and_one_sure_rule_is_enough(spark):
    ways = [([1, 1, 1], 900), ([-1, 1, 1], 60), ([1, -1, 1], 40), ([0, 0, 0], 5), ([0, 1, 0], 5)]
    votes = spark.createDataFrame([(w,) for w, n in ways for _ in range(n)], "votes array<int>")
    found = {tuple(r.votes): r.quality for r in quality.posteriors(votes, 3).collect()}
    assert found[1, 1, 1] > 0.5 and found[0, 0, 0] > 0.5 and found[0, 1, 0] > 0.5
    assert found[-1, 1, 1] < 0.5 and found[1, -1, 1] < 0.5


def test_empty_table(spark):
    assert quality.judged(cases.empty(spark)).count() == 0


def test_no_python_on_the_way(spark, sf_dir, capsys):
    quality.judged(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
