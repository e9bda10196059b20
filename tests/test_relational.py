import datetime

import pytest
from pyspark.sql import functions as F

from threadmood import schemas
from threadmood.functions import scalar
from threadmood.operators import filters, joins, labels, reports, sampling
from threadmood.plans import tables

COMMENT = dict(
    id="c1", body="text", created_utc=0, author_flair_text=None, link_id="t3_000001", score=1
)


def comments(spark, *changes):
    return spark.createDataFrame([{**COMMENT, **c} for c in changes], schemas.COMMENTS)


def stories(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.STORIES)


def label_rows(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.LABELS)


def scored(spark, *rows):
    """Rows of (created_utc, flair, comment score, story score, pos, neg)."""
    full = [(str(i), "b", r[0], r[1], "t", r[2], r[3], r[4], r[5]) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, schemas.SCORED)


# filters


@pytest.mark.parametrize(
    "body, kept",
    [
        ("x /s", False),
        ("http://site", False),
        ("A/S", True),
        ("&gt; q", False),
        (" &gt; q", True),
        (None, False),
        ("", True),
    ],
)
def test_eligible(spark, body, kept):
    assert filters.eligible(comments(spark, {"body": body})).count() == kept


# scalar functions


def test_story_key(spark):
    links = ["t3_abcde", "t3_abcdef", "t3_1abcdef", "abc", None]
    rows = spark.createDataFrame([(x,) for x in links], "link_id string")
    got = [r[0] for r in rows.select(scalar.story_key(F.col("link_id"))).collect()]
    assert got == ["_abcde", "abcdef", "abcdef", "abc", None]


def test_epoch_day_is_the_day_of_the_session_zone(spark, conf):
    conf("spark.sql.session.timeZone", "America/Los_Angeles")
    row = spark.range(1).select(
        scalar.epoch_day(F.lit(1483257600)).alias("day"),
        F.to_date(scalar.epoch_text(F.lit(1483257600))).alias("formatted"),
    ).first()
    assert row.day == row.formatted == datetime.date(2017, 1, 1)
    before_midnight = spark.range(1).select(scalar.epoch_day(F.lit(1483228799 + 3600))).first()
    assert before_midnight[0] == datetime.date(2016, 12, 31)


def test_epoch_day_takes_numbers_as_text(spark):
    assert spark.range(1).select(scalar.epoch_day(F.lit("86400"))).first()[0] == datetime.date(
        1970, 1, 2
    )


# joins and labels


def test_short_link_matches_nothing_or_wrongly(spark):
    linked = comments(
        spark,
        {"id": "a", "link_id": "t3_abcdef"},
        {"id": "b", "link_id": "t3_abcde"},
        {"id": "c", "link_id": "t3_1abcdef"},
        {"id": "d", "link_id": None},
    )
    side = stories(spark, ("abcdef", "T", 7), ("abcde", "U", 8))
    got = joins.comment_story(linked, side).select("id", "title", "story_score").collect()
    assert sorted(map(tuple, got)) == [("a", "T", 7), ("c", "T", 7)]


def test_comment_story_columns(spark):
    got = joins.comment_story(comments(spark, {}), stories(spark, ("000001", "T", 7)))
    assert got.columns == schemas.SCORED.names[:-2]


def test_label_joins_multiply_rows(spark):
    """Two labels of one id: two rows after the first join, four after the second."""
    rows = comments(spark, {"id": "a"}, {"id": "b"}, {"id": "c"})
    given = label_rows(spark, ("a", 1, 1, 1), ("a", 1, 1, -1), ("b", 1, 1, None))
    labeled = joins.labeled_comments(rows, given)
    assert sorted(r.id for r in labeled.collect()) == ["a", "a", "b"]
    assert labeled.columns == rows.columns
    flags = labels.rejoin_labels(labeled, given, "labeldjt")
    got = sorted((r.id, r.pos_label, r.neg_label) for r in flags.collect())
    assert got == [("a", 0, 1)] * 2 + [("a", 1, 0)] * 2 + [("b", 0, 0)]


def test_weights_stand_for_the_multiplied_rows(spark):
    rows = comments(spark, {"id": "a"}, {"id": "b"}, {"id": "c"})
    given = label_rows(
        spark, *[("a", 1, 1, 1)] * 3, ("a", 1, 1, -1), ("b", 1, 1, None), ("x", 1, 1, 1)
    )
    joined = labels.rejoin_labels(joins.labeled_comments(rows, given), given, "labeldjt")
    counted = joined.groupBy("id", "pos_label", "neg_label").agg(F.count("*").alias("n"))
    weighted = labels.binarize(labels.training_rows(rows, given), "labeldjt")
    assert sorted((r.id, r.pos_label, r.neg_label, float(r.n)) for r in counted.collect()) == sorted(
        (r.id, r.pos_label, r.neg_label, r.weight) for r in weighted.collect()
    )


def test_null_label_is_neither(spark):
    given = label_rows(spark, ("a", 1, -1, None))
    row = labels.binarize(given, "labeldjt").first()
    assert (row.pos_label, row.neg_label) == (0, 0)


@pytest.fixture
def hot(spark):
    """A third of the comments belong to one story."""
    return spark.range(6000).select(
        F.col("id").cast("string").alias("id"),
        F.lit("text").alias("body"),
        F.col("id").alias("created_utc"),
        F.lit(None).cast("string").alias("author_flair_text"),
        F.when(F.col("id") % 3 == 0, F.lit("t3_hothot"))
        .when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("t3_"), F.lpad((F.col("id") % 500).cast("string"), 6, "0")))
        .alias("link_id"),
        F.col("id").alias("score"),
    )


def test_hot_story_is_dealt_over_partitions(spark, conf, hot):
    side = spark.range(500).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("id"),
        F.lit("T").alias("title"),
        F.col("id").alias("score"),
    )
    side = side.unionAll(stories(spark, ("hothot", "H", 1), ("hothot", "H2", 2)))
    plain = joins.comment_story(hot, side)
    expected = sorted(map(tuple, plain.collect()), key=repr)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "20")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dealt = joins.comment_story(hot, side)
    assert "SortMergeJoin" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect()), key=repr) == expected
    sizes = [
        r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()
    ]
    # left in one partition the hot story alone would hold 4000 rows
    assert max(sizes) < 1600


def test_hot_keys_are_few_and_counted_right(spark, conf, hot):
    conf("spark.sql.shuffle.partitions", "20")
    found = joins.hot_keys(hot.select("link_id"), "link_id").collect()
    # 2000 of 6000 rows are 6.67 fair partitions of 20
    assert [(r.hot_key, r.parts) for r in found] == [("t3_hothot", 14)]


# samples


def test_stable_sample_is_nested_and_repeatable(spark):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    small = {r.id for r in sampling.stable_sample(ids, 0.05).collect()}
    large = {r.id for r in sampling.stable_sample(ids.repartition(7), 0.1).collect()}
    assert small < large
    assert 900 < len(small) < 1100 and 1850 < len(large) < 2150


def test_stable_halves_cover_all_and_differ_by_salt(spark):
    ids = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    first, second = sampling.stable_split(ids, salt="a")
    assert first.count() + second.count() == 2000
    assert first.intersect(second).count() == 0
    other, _ = sampling.stable_split(ids, salt="b")
    assert 350 < first.intersect(other).count() < 650


def test_small_fractions_and_null_ids(spark):
    ids = spark.range(100_000).selectExpr("cast(id AS string) AS id")
    assert 0 < sampling.stable_sample(ids, 4e-4).count() < 100
    assert sampling.stable_sample(spark.range(2_000_000).selectExpr("cast(id AS string) AS id"), 4e-5).count() > 0
    some = ids.limit(2).union(spark.createDataFrame([(None,)], "id string"))
    assert sampling.stable_sample(some, 1.0).count() == 3
    first, second = sampling.stable_split(some)
    assert first.count() + second.count() == 3


def test_folds_are_even(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    sizes = sampling.with_fold(ids, 5).groupBy("fold").count().collect()
    assert sorted(r.fold for r in sizes) == [0, 1, 2, 3, 4]
    assert all(850 < r["count"] < 1150 for r in sizes)


def test_bernoulli_sample_repeats_with_its_seed(spark):
    rows = spark.range(10000)
    first = sampling.bernoulli_sample(rows, 0.1, 1).collect()
    assert first == sampling.bernoulli_sample(rows, 0.1, 1).collect()
    assert first != sampling.bernoulli_sample(rows, 0.1, 2).collect()
    assert 850 < len(first) < 1150


# reports


def test_overall(spark):
    rows = scored(spark, (0, "a", 1, 1, 1.0, 1.0), (0, "a", 1, 1, 1.0, 0.0), (0, "a", 1, 1, 0.0, 0.0))
    row = reports.report(rows, "overall").first()
    assert row.percent_pos == pytest.approx(200 / 3)
    assert row.percent_neg == pytest.approx(100 / 3)


def test_empty_input(spark):
    nothing = scored(spark)
    assert list(map(tuple, reports.report(nothing, "overall").collect())) == [(None, None)]
    for name in schemas.REPORT_KEYS:
        if name != "overall":
            assert reports.report(nothing, name).collect() == []


def test_null_keys_are_a_group_and_come_first(spark):
    rows = scored(
        spark,
        (86400, "a", 3, 5, 1.0, 0.0),
        (None, None, None, None, 0.0, 1.0),
        (86399, "a", 2, 5, 0.0, 0.0),
    )
    day = datetime.date(1970, 1, 1)
    got = list(map(tuple, reports.report(rows, "by_day").collect()))
    assert got == [(None, 0, 100), (day, 0, 0), (day + datetime.timedelta(1), 100, 0)]
    assert list(map(tuple, reports.report(rows, "by_place").collect())) == [
        (None, 0, 100),
        ("a", 50, 0),
    ]
    assert [r[0] for r in reports.report(rows, "by_comment_score").collect()] == [None, 2, 3]
    assert [r[0] for r in reports.report(rows, "by_story_score").collect()] == [None, 5]


def test_one_pass_equals_the_single_reports(spark):
    rows = scored(
        spark,
        *((i * 40000 if i % 7 else None, "ab"[i % 2] if i % 5 else None, i % 3, i % 4, float(i % 2), float(i % 3 == 0))
          for i in range(60)),
    )
    together = reports.keyed_reports(rows)
    for name, key in schemas.REPORT_KEYS.items():
        if key:
            part = together.where(F.col("report") == name)
            part = part.select(key.name, "percent_pos", "percent_neg")
            assert sorted(map(tuple, part.collect()), key=repr) == sorted(
                map(tuple, reports.report(rows, name).collect()), key=repr
            )


def test_numbers_beyond_six_digits_keep_them_all(spark):
    rows = spark.createDataFrame([(7,), (999999,), (1000000,), (1000001,)], "doc_id long").select(tables._padded("doc_id")).collect()
    assert [r[0] for r in rows] == ["000007", "999999", "1000000", "1000001"]
