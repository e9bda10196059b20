"""The pipeline against a brute-force version of each stage, on the stage's own input."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import cases, test_near_copies, test_passages
from threadmood.llm import quality


@pytest.fixture(scope="module")
def inputs(spark, sf_dir, tmp_path_factory):
    """What goes into each stage, and the last one's output: the table and odd rows, stage by stage."""
    odd = [(10_000 + i, text, "xx", "odd", 0) for i, text in enumerate(cases.ODD_TEXTS[:-3])]
    odd += [(20_000 + i, f"a passage that is there once {i} " + "and one that is shared by many rows " * 8, "xx", "odd", 0) for i in range(3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = table.unionByName(spark.createDataFrame(odd, schema)).withColumn("key", F.lit("extra"))
    folder, out = str(tmp_path_factory.mktemp("pipeline")), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return [*out, docs]


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(inputs):
    assert all(sorted(df.columns) == sorted(inputs[0].columns) for df in inputs[1:-1])


def test_rejected_documents_go(inputs):
    kept = {r.doc_id for r in quality.judged(inputs[0]).where("kept").collect()}
    assert Counter(rows_of(inputs[1])) == Counter(row for row in rows_of(inputs[0]) if row[0] in kept)
    assert 0 < len(kept) < inputs[0].count()


def test_one_document_of_each_group_stays(inputs):
    rows = rows_of(inputs[1])
    want = {i for (i, _), (_, component) in test_near_copies.brute(rows, 5).items() if i == component}
    assert Counter(rows_of(inputs[2])) == Counter(row for row in rows if row[0] in want)
    assert len(want) < len(rows)


def test_repeated_passages_are_cut(inputs):
    want = {row[0]: own[2].decode("utf-8", "ignore") for row, own in test_passages.brute(rows_of(inputs[2])).items()}
    found = inputs[3].select("doc_id", "text", "n_chars", "key").collect()
    assert {r.doc_id: r.text for r in found} == want
    assert all(r.n_chars == len(r.text) and r.key == "extra" for r in found)


def test_all_ids_are_packed(inputs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in rows_of(inputs[3]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.update((i, at, token) for at, token in enumerate(ids))
    found = Counter()
    for r in inputs[4].collect():
        assert len(r.tokens) == 4 * r.length
        found.update((r.doc_id, r.start + k, token) for k, token in enumerate(np.frombuffer(bytes(r.tokens), "<u4").tolist()))
    assert found == want


def test_run_is_the_stages_in_turn(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert 0 < found.select("doc_id").distinct().count() < docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near copies", "repeated passages", "packing"]


LONG_TEXT = " ".join(f"sentence {i} of a clean document that says one thing after another" for i in range(30))
OTHER_TEXT = " ".join(f"line {i} tells of rivers and of boats that carry {i + 7} bales" for i in range(30))


def near_stage(spark, rows, folder):
    docs = spark.createDataFrame([(*row, "xx", "odd", 0) for row in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{folder}/in")
    corpus_pipeline.one_of_each(spark, spark.read.parquet(f"{folder}/in"), "").write.parquet(f"{folder}/out")
    return spark.read.parquet(f"{folder}/out")


def test_equal_rows_leave_one_and_its_text(spark, tmp_path):
    kept = near_stage(spark, [(1, LONG_TEXT)] * 300 + [(2, LONG_TEXT + " end"), (3, OTHER_TEXT), (4, OTHER_TEXT)], tmp_path)
    assert sorted(rows_of(kept)) == [(1, LONG_TEXT), (3, OTHER_TEXT)]
    assert sorted(rows_of(corpus_pipeline.without_passages(spark, kept, ""))) == [(1, LONG_TEXT), (3, OTHER_TEXT)]


def test_an_id_on_two_texts_is_two_documents(spark, tmp_path):
    third = "a third text of which there is but one row " * 2
    kept = near_stage(spark, [(1, LONG_TEXT), (2, LONG_TEXT), (2, OTHER_TEXT), (5, third), (5, OTHER_TEXT), (6, " "), (6, " ")], tmp_path)
    assert sorted(rows_of(kept)) == [(1, LONG_TEXT), (2, OTHER_TEXT), (5, third), (6, " "), (6, " ")]


def test_rows_without_an_id_are_documents(spark, tmp_path):
    third = "a third text of which there is but one row " * 2
    rows = [(None, LONG_TEXT), (None, third), (None, third), (None, OTHER_TEXT), (7, OTHER_TEXT + " end"), (None, ""), (None, None)]
    kept = near_stage(spark, rows, tmp_path)
    assert Counter(rows_of(kept)) == Counter([(None, LONG_TEXT), (None, third), (7, OTHER_TEXT + " end"), (None, ""), (None, None)])
    assert Counter(rows_of(corpus_pipeline.without_passages(spark, kept, ""))) == Counter(rows_of(kept))
    packed = corpus_pipeline.packed(spark, kept, "").where("doc_id IS NULL AND start = 0")
    assert packed.count() == 4
