"""Comment-shaped inputs derived from the given test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmood.plans.run import Inputs
from threadmood.session import pin


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(number: str):
    """Six digits or more: a longer number keeps all of its digits."""
    digits = F.col(number).cast("string")
    return F.lpad(digits, F.greatest(F.lit(6), F.length(digits)), "0")


def comments(spark: SparkSession, sf_dir: str, deal: int | None = None) -> DataFrame:
    """Documents as comments, timed and voted on by the event of the same number.

    Every tenth body gets a sarcasm mark and every tenth a quote mark, which the
    texts themselves lack. ``deal`` may name a number of partitions for readers that
    tokenise, where the caller knows the table to come in too few splits.
    """
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    if deal is not None:
        documents = documents.repartition(deal, "doc_id")
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    text, last_digit = F.col("text"), F.col("doc_id") % 10
    return documents.join(events, F.col("event_id") == F.col("doc_id")).select(
        _padded("doc_id").alias("id"),
        F.when(last_digit == 3, F.concat(text, F.lit(" /s")))
        .when(last_digit == 7, F.concat(F.lit("&gt; "), text))
        .otherwise(text)
        .alias("body"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_utc"),
        F.nullif(F.col("lang"), F.lit("fr")).alias("author_flair_text"),
        F.concat(
            F.lit("t3_"), F.lpad((F.col("doc_id") % 40).cast("string"), 6, "0")
        ).alias("link_id"),
        F.col("user_id").alias("score"),
    )


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select(
        _padded("page_id").alias("id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.length("url").cast("bigint").alias("score"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return _table(spark, sf_dir, "labels").select(
        _padded("doc_id").alias("Input_id"),
        F.when(good, 1).otherwise(-1).alias("labeldem"),
        F.when(toxic, -1).alias("labelgop"),
        F.when(toxic, -1).when(good, 1).otherwise(0).alias("labeldjt"),
    )


def inputs(spark: SparkSession, sf_dir: str, deal: int | None = None) -> Inputs:
    pin(spark)
    return Inputs(
        comments(spark, sf_dir, deal), stories(spark, sf_dir), labels(spark, sf_dir)
    )
