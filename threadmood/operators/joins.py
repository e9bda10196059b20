"""The joins of the pipeline, safe for keys that hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmood.functions.scalar import story_key
from threadmood.sources.sizes import fits_broadcast, shuffle_partitions


def hot_keys(keys: DataFrame, key: str) -> DataFrame:
    """Keys with more than twice a fair partition's rows, and in how many parts to cut them.

    With P shuffle partitions there are fewer than P/2 such keys, whatever the data,
    so the result may be broadcast. Counting is combined on the map side.
    """
    partitions = shuffle_partitions(keys)
    counts = keys.groupBy(F.col(key).alias("hot_key")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    fair_shares = F.col("n") * F.lit(partitions) / total
    return counts.where(F.col("hot_key").isNotNull() & (fair_shares > 2)).select(
        "hot_key", F.ceil(2 * fair_shares).cast("int").alias("parts")
    )


def skew_safe_join(
    many: DataFrame,
    one: DataFrame,
    many_key: str,
    one_key: str,
    keys: DataFrame,
    deal_by: tuple[str, ...],
) -> DataFrame:
    """Inner join of ``many`` rows to ``one`` side by key.

    A ``one`` side under Spark's broadcast limit goes to a plain join, which moves no
    ``many`` row. Otherwise both sides are shuffled, and rows of a hot key are dealt
    over several partitions, with the matching ``one`` rows repeated in each of them.
    The part is a hash of the ``deal_by`` columns, so a retried task deals a row the same
    way; rows equal in all of them stay together and are left to AQE's skew handling.

    ``keys`` is a cheap source of the ``many`` keys, to count in.
    """
    on = many[many_key] == one[one_key]
    if fits_broadcast(one):
        return many.join(one, on)
    hot = hot_keys(keys.select(many_key), many_key)
    parts = F.col("parts")
    own_part = F.when(parts.isNotNull(), F.pmod(F.xxhash64(*deal_by), parts).cast("int"))
    # never NULL, or the join would infer a filter that repeats the columns' work
    dealt = many.join(F.broadcast(hot), many[many_key] == hot["hot_key"], "left").select(
        many["*"], F.coalesce(own_part, F.lit(0)).alias("part")
    )
    all_parts = F.when(parts.isNotNull(), F.sequence(F.lit(0), parts - 1))
    repeated = one.join(F.broadcast(hot), one[one_key] == hot["hot_key"], "left").select(
        one["*"], F.explode(F.coalesce(all_parts, F.array(F.lit(0)))).alias("part")
    )
    joined = dealt.join(
        repeated,
        (dealt[many_key] == repeated[one_key]) & (dealt["part"] == repeated["part"]),
    )
    return joined.drop("part")


def labeled_comments(comments: DataFrame, labels: DataFrame) -> DataFrame:
    """Comment columns of the labelled comments; n labels for an id give n rows.

    Labels are counted per id before the join, so an id with very many of them is one
    row there, and its repeats are made only where its comment lies. Labels under
    Spark's broadcast limit move no comment; more of them are shuffled.
    """
    counts = labels.groupBy("Input_id").agg(F.count("*").alias("labels_of_id"))
    joined = comments.join(counts, comments["id"] == counts["Input_id"])
    repeats = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("labels_of_id")))
    return joined.select(*comments.columns, repeats.alias("nth")).drop("nth")


def comment_story(
    comments: DataFrame,
    stories: DataFrame,
    carry: tuple[str, ...] = (),
    keys: DataFrame | None = None,
) -> DataFrame:
    """Comments with the title and score of their story.

    ``carry`` names further comment columns to keep. ``keys`` may give the unfiltered
    comments, whose ``link_id`` is cheaper to read, to look for hot stories in.
    """
    keyed = comments.select(
        "id",
        "body",
        "created_utc",
        "author_flair_text",
        F.col("score").alias("comment_score"),
        *carry,
        story_key(F.col("link_id")).alias("story_key"),
    )
    side = stories.select(
        F.col("id").alias("story_id"), "title", F.col("score").alias("story_score")
    )
    links = comments if keys is None else keys
    keys = links.select(story_key(F.col("link_id")).alias("story_key"))
    deal_by = ("id", "created_utc", "comment_score")
    return skew_safe_join(keyed, side, "story_key", "story_id", keys, deal_by).select(
        "id",
        "body",
        "created_utc",
        "author_flair_text",
        "title",
        "comment_score",
        "story_score",
        *carry,
    )
