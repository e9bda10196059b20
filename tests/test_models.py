import dataclasses
import os

import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from threadmood import schemas
from threadmood.catalog import queries
from threadmood.operators import features, joins, labels, models, scoring
from threadmood.plans import run, tables
from threadmood.plans.config import DEM, DJT, GOP, TARGETS
from threadmood.sources import readers, writers


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return tables.inputs(spark, sf_dir, 8)


@pytest.fixture(scope="module")
def out_dir(spark, sf_dir):
    """The folder the queries use too, so models are trained once for all tests."""
    return queries._output_folder(spark, sf_dir)


@pytest.fixture(scope="module")
def vectorizer(inputs, out_dir):
    return run.vectorizer(inputs, out_dir)


@pytest.fixture(scope="module")
def frame(inputs, vectorizer, out_dir):
    stored = run.training_frame(inputs, vectorizer, out_dir + "/training.parquet")
    return labels.binarize(stored, DJT.label_col)


@pytest.fixture(scope="module")
def pair(inputs, vectorizer, out_dir):
    return run.trained_models(inputs, DJT, vectorizer, out_dir, out_dir + "/training.parquet")


def test_vocabulary_is_the_terms_of_five_documents(inputs, vectorizer):
    labeled = joins.labeled_comments(inputs.comments, inputs.labels)
    terms = features.vocabulary(features.with_tokens(labeled))
    assert {r.term for r in terms.collect()} == set(vectorizer.vocabulary)
    assert terms.where("documents < 5").count() == 0


def test_vectors_are_binary(frame):
    values = frame.select(F.explode(F.unwrap_udt("features")["values"]).alias("v")).distinct()
    assert [r.v for r in values.collect()] == [1.0]


def test_settings(pair):
    assert {n: m.bestModel.getThreshold() for n, m in pair.items()} == {"pos": 0.2, "neg": 0.25}
    for model in pair.values():
        assert model.getNumFolds() == 2
        assert model.bestModel.getRegParam() == 1.0
        assert model.bestModel.getMaxIter() == 10
        assert len(model.avgMetrics) == 1
    assert {c.name: (c.folds, c.sample_fraction) for c in TARGETS.values()} == {
        "dem": (5, 0.05),
        "gop": (5, 0.05),
        "djt": (2, 0.1),
    }


def test_prediction_is_one_above_the_threshold(frame, pair):
    both = scoring.apply_models(frame, pair, probabilities=True)
    for polarity in models.POLARITIES:
        row = both.select(
            F.col(polarity.name).alias("p"),
            F.element_at(F.unwrap_udt(f"{polarity.name}_probability")["values"], 2).alias("prob"),
        )
        wrong = row.where((F.col("p") == 1) != (F.col("prob") > polarity.threshold))
        assert wrong.count() == 0
        assert row.where(~F.col("p").isin(0.0, 1.0)).count() == 0


def test_same_seed_same_models(frame, pair):
    again = models.train(frame, models.POSITIVE, DJT.folds, DJT.seed).bestModel
    assert list(again.coefficients) == pytest.approx(
        list(pair["pos"].bestModel.coefficients), abs=1e-9
    )


def test_saved_models_decide_the_same(frame, pair, tmp_path):
    path = str(tmp_path / "pos.model")
    pair["pos"].write().overwrite().save(path)
    copies = {**pair, "pos": models.load_model(path)}
    first = scoring.apply_models(frame, pair).select("id", "pos", "neg")
    second = scoring.apply_models(frame, copies).select("id", "pos", "neg")
    assert sorted(first.collect()) == sorted(second.collect())


def test_models_of_another_vocabulary_are_trained_anew(inputs, vectorizer, frame, tmp_path):
    """The vectorizer is lost and comes back with other terms: the models must not be paired with it."""
    out = str(tmp_path)
    config = dataclasses.replace(DJT, folds=2)
    first = run.trained_models(inputs, config, vectorizer, out, out + "/training.parquet")
    again = run.trained_models(inputs, config, vectorizer, out, out + "/training.parquet")
    assert again["pos"].bestModel.numFeatures == first["pos"].bestModel.numFeatures
    fewer = CountVectorizerModel.from_vocabulary(
        vectorizer.vocabulary[1:], inputCol="tokens", outputCol="features", binary=True
    )
    other = run.trained_models(inputs, config, fewer, out, out + "/other/training.parquet")
    assert other["pos"].bestModel.numFeatures == len(vectorizer.vocabulary) - 1


def test_vocabulary_has_no_cap_and_one_order(spark):
    rows = spark.createDataFrame([([f"t{i}" for i in range(300_000)],)] * 5, "tokens array<string>")
    terms = features.fit_vectorizer(rows.repartition(4)).vocabulary
    assert len(terms) == 300_000 > 1 << 18
    assert terms == sorted(terms)


def test_weights_equal_repeated_rows(spark, frame):
    """Weight two trains the same model as two rows."""
    weighted = frame.withColumn("weight", F.when(F.col("pos_label") == 1, 2.0).otherwise(1.0))
    repeated = frame.unionAll(frame.where("pos_label = 1")).withColumn("weight", F.lit(1.0))
    fitted = [
        models.classifier(models.POSITIVE).fit(labels.training_pairs(f, "pos_label"))
        for f in (weighted, repeated)
    ]
    # both run the same iterations on the same objective; standard deviations differ
    # by the sample correction of the row count
    a, b = (f.summary.objectiveHistory[0] for f in fitted)
    assert a == pytest.approx(b, rel=1e-9)


def test_label_that_never_occurs(frame, tmp_path):
    """The always-0 model trains, saves, scores and evaluates."""
    constant = labels.binarize(frame.drop("pos_label", "neg_label"), GOP.label_col)
    assert constant.where("pos_label = 1").count() == 0
    path = str(tmp_path / "pos.model")
    models.train(constant, models.POSITIVE, 2, 1).write().overwrite().save(path)
    model = models.load_model(path)
    out = scoring.apply_models(constant, {"pos": model, "neg": model})
    assert out.where("pos <> 0 OR neg <> 0").count() == 0
    mixed = constant.withColumn("pos_label", (F.hash("id") % 2 == 0).cast("int"))
    assert models.held_out_auc(mixed, model, models.POSITIVE, 1) == pytest.approx(0.5)


def test_label_that_always_occurs(frame):
    constant = frame.withColumn("pos_label", F.lit(1))
    model = models.train(constant, models.POSITIVE, 2, 1)
    out = scoring.apply_models(constant, {"pos": model, "neg": model})
    assert out.where("pos <> 1").count() == 0


def test_fold_without_a_flagged_row(frame):
    """One flagged row in all: some training folds have none."""
    kept, _ = models.halves(frame, models.POSITIVE, 1)
    only = kept.orderBy("id").first().id
    rare = frame.withColumn("pos_label", (F.col("id") == only).cast("int"))
    model = models.train(rare, models.POSITIVE, 5, 1)
    assert model.bestModel.numClasses == 2


def test_auc_is_a_share(frame, pair):
    for polarity in models.POLARITIES:
        assert 0 <= models.held_out_auc(frame, pair[polarity.name], polarity, DJT.seed) <= 1


def test_scored_rows_are_eligible_and_sampled(spark, inputs, vectorizer, pair, out_dir):
    scored = run.scored_table(inputs, DJT, vectorizer, pair, out_dir)
    assert scored.schema.names == schemas.SCORED.names
    assert [f.dataType for f in scored.schema] == [f.dataType for f in schemas.SCORED]
    assert scored.where("body LIKE '%/s%' OR body LIKE '&gt%'").count() == 0
    everyone = joins.comment_story(inputs.comments, inputs.stories)
    assert 0 < scored.count() < everyone.count()


def test_bernoulli_target_repeats_with_its_seed(inputs, vectorizer, pair, tmp_path):
    config = dataclasses.replace(DJT, bernoulli=True, sample_fraction=0.5)
    tables_of = [
        run.scored_table(inputs, config, vectorizer, pair, str(tmp_path / name)) for name in "ab"
    ]
    first, second = (sorted(r.id for r in t.collect()) for t in tables_of)
    assert first == second and 40 < len(first) < 120


def test_targets_sharing_a_scan_score_the_same(spark, inputs, vectorizer, pair, tmp_path):
    together, alone = str(tmp_path / "together"), str(tmp_path / "alone")
    writers.save_model(vectorizer, together + "/cvModel")
    for config in (DEM, DJT):
        for name, model in pair.items():
            writers.save_model(model, f"{together}/{config.model_dir}/{name}.model")
        writers.save_tie(spark, *run.models_tie(inputs, config, vectorizer, together))
    writers.save_tie(spark, *run.vectorizer_tie(inputs, together))
    run.run_targets(inputs, together, (DEM, DJT))
    for config in (DEM, DJT):
        shared = readers.read_parquet(spark, f"{together}/{config.scored_path}")
        single = run.scored_table(inputs, config, vectorizer, pair, alone)
        assert shared.schema == single.schema
        assert sorted(map(tuple, shared.collect()), key=repr) == sorted(
            map(tuple, single.collect()), key=repr
        )


def test_shuffled_join_scores_the_same(spark, conf, inputs, vectorizer, pair):
    plain = scoring.score(inputs.comments, inputs.stories, vectorizer, pair)
    expected = sorted(map(tuple, plain.collect()), key=repr)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = scoring.score(
        inputs.comments, inputs.stories, vectorizer, pair, keys=inputs.comments
    )
    assert sorted(map(tuple, shuffled.collect()), key=repr) == expected


def test_run_writes_everything_once(spark, inputs, out_dir):
    written = run.run_target(inputs, DJT, out_dir)
    assert set(written) == set(schemas.REPORT_KEYS)
    times = {p: os.stat(p).st_mtime_ns for p in written.values()}
    assert run.run_target(inputs, DJT, out_dir) == written
    assert times == {p: os.stat(p).st_mtime_ns for p in written.values()}
    for name, path in written.items():
        report = readers.read_report(spark, path, name)
        outside = report.where(
            "percent_pos < 0 OR percent_pos > 100 OR percent_neg < 0 OR percent_neg > 100"
        )
        assert report.count() > 0 and outside.count() == 0


def test_run_from_files(spark, inputs, vectorizer, pair, out_dir, tmp_path):
    """JSON in, Parquet and CSV as inputs, reports as from the tables."""
    source, target = tmp_path / "in", str(tmp_path / "out")
    for name, table, schema in (
        ("comments", inputs.comments, schemas.COMMENTS),
        ("submissions", inputs.stories, schemas.STORIES),
    ):
        path = str(source / name)
        table.write.option("compression", "bzip2").json(path + ".json")
        writers.ingest(readers.read_json(spark, path + ".json", schema), path + ".parquet")
    inputs.labels.write.option("header", True).csv(str(source / "labeled_data.csv"))
    loaded = run.load_inputs(
        spark,
        str(source / "comments.parquet"),
        str(source / "submissions.parquet"),
        str(source / "labeled_data.csv"),
    )
    assert sorted(map(tuple, loaded.labels.collect()), key=repr) == sorted(
        map(tuple, inputs.labels.collect()), key=repr
    )
    writers.save_model(vectorizer, target + "/cvModel")
    for name, model in pair.items():
        writers.save_model(model, f"{target}/{DJT.model_dir}/{name}.model")
    writers.save_tie(spark, *run.models_tie(loaded, DJT, vectorizer, target))
    writers.save_tie(spark, *run.vectorizer_tie(loaded, target))
    from_files = run.run_target(loaded, DJT, target)
    from_tables = run.run_target(inputs, DJT, out_dir)
    for name in DJT.reports:
        first, second = (
            sorted(map(tuple, readers.read_report(spark, w[name], name).collect()), key=repr)
            for w in (from_files, from_tables)
        )
        assert first == second


def test_other_target_shares_the_vectorizer(spark, inputs, out_dir):
    before = os.stat(out_dir + "/cvModel/data").st_mtime_ns
    written = run.run_target(inputs, DEM, out_dir)
    assert set(written) == {"overall", "by_day", "by_place"}
    assert os.stat(out_dir + "/cvModel/data").st_mtime_ns == before


def test_other_inputs_renew_what_follows_and_nothing_else(spark, inputs, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    inputs.comments.write.parquet(f"{source}/comments")
    inputs.stories.write.parquet(f"{source}/stories")
    inputs.labels.write.option("header", True).csv(f"{source}/labels")

    def times():
        loaded = run.load_inputs(spark, f"{source}/comments", f"{source}/stories", f"{source}/labels")
        run.run_target(loaded, DJT, target)
        paths = [target + "/cvModel/data", f"{target}/{DJT.model_dir}/pos.model", f"{target}/{DJT.scored_path}"]
        return [os.stat(path).st_mtime_ns for path in (*paths, f"{target}/{DJT.reports['by_day']}")]

    first = times()
    assert times() == first
    inputs.stories.withColumn("score", F.col("score") + 1).write.mode("overwrite").parquet(f"{source}/stories")
    other_stories = times()
    assert [a == b for a, b in zip(first, other_stories)] == [True, True, False, False]
    changed = inputs.labels.withColumn("labeldjt", -F.col("labeldjt"))
    changed.write.mode("overwrite").option("header", True).csv(f"{source}/labels")
    assert not any(a == b for a, b in zip(other_stories, times()))
    assert not [name for name in os.listdir(target) if name.endswith(".new")]


def test_a_table_of_other_makings_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert writers.materialize(spark.range(2), path, "a").count() == 2
    assert writers.materialize(spark.range(3), path, "a").count() == 2
    assert writers.materialize(spark.range(3), path, "b").count() == 3
    assert writers.materialize(spark.range(4), path).count() == 3
