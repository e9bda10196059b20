"""Sharding by balanced label propagation: copies move together, and shards stay even."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from threadmood.llm.shared import parts_of, stored

ROUNDS = 4
#: A group above this share of a shard moves row by row, so that it fills what room there is.
LARGE = 0.02


def _chance(*parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but its arguments."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _moved(linked: DataFrame, capacity: int, turn: int) -> DataFrame:
    """One round: parts of a group go to the shard that holds most of it, as far as quotas allow.

    The quota of a shard is its room, plus as many rows as want to leave it. Wishes beyond it
    are granted in that proportion, by a hash.
    """
    parts = linked.groupBy("group", "shard").agg(F.count("*").alias("n"))
    best = parts.groupBy("group").agg(
        F.max(F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard"))["shard"].alias("to")
    )
    wishes = parts.join(best, "group").where("shard != to")
    leaving = wishes.groupBy(F.col("shard")).agg(F.sum("n").alias("leaving"))
    coming = wishes.groupBy(F.col("to").alias("shard")).agg(F.sum("n").alias("coming"))
    held = linked.groupBy("shard").agg(F.count("*").alias("held"))
    # A row per shard: small whatever the data.
    quotas = (
        coming.join(held, "shard", "left")
        .join(leaving, "shard", "left")
        .select(
            F.col("shard").alias("to"),
            F.least(
                F.lit(1.0),
                F.greatest(
                    F.lit(0.0),
                    (F.lit(capacity) - F.coalesce("held", F.lit(0)) + F.coalesce("leaving", F.lit(0)) / 2) / F.col("coming"),
                ),
            ).alias("rate"),
        )
    )
    wishes = wishes.join(F.broadcast(quotas), "to").select(
        "group", "shard", "to", "rate", (F.col("n") > capacity * LARGE).alias("large")
    )
    lot = F.when(F.col("large"), _chance(F.col("row"), F.lit(turn))).otherwise(_chance(F.col("group"), F.col("shard"), F.lit(turn)))
    return linked.join(wishes, ["group", "shard"], "left").select(
        "row", "group", F.when(lot < F.col("rate"), F.col("to")).otherwise(F.col("shard")).alias("shard")
    )


def _ranked(rows: DataFrame, buckets: int) -> DataFrame:
    """rows with ``rank``: gapless from 0 per shard, linked rows ahead of single ones, a group's rows close together.

    Counts of buckets give where a bucket begins, so no task sorts more than one bucket of one
    shard; a group is spread over 16 buckets, so no group decides how large a bucket is.
    """
    bucket = F.struct(
        F.col("single"),
        F.pmod(F.xxhash64("group"), F.lit(buckets)).alias("a"),
        F.pmod(F.xxhash64("row"), F.lit(16)).alias("b"),
    )
    rows = rows.withColumn("bucket", bucket)
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    begins = counts.select(
        "shard",
        "bucket",
        (F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))).alias("begin"),
    )
    inside = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("group", "row")) - 1
    return rows.withColumn("inside", inside).join(begins, ["shard", "bucket"]).select(
        "row", "shard", (F.coalesce("begin", F.lit(0)) + F.col("inside")).alias("rank")
    )


def shard(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, rounds: int = ROUNDS
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) per row, under the law ``rows``.

    Counts of the shards differ by one at most. Rows with equal texts are linked, each to its
    group and not to each other, so links grow with the rows. Labels start evenly and spread in
    ``rounds`` rounds of joins; then shards above their count give rows to those below it,
    single rows first. A group is cut only where it is larger than the room. ``size`` is the
    text's UTF-8 bytes plus 1, ``slot`` is gapless from 0 per shard, ``grown_shard`` is NULL:
    under this law a new shard would take rows anywhere. NULL counts as an empty text; repeated
    rows and NULL ids each get a place of their own; other columns are ignored; an empty table
    gives an empty result. The texts are read once; everything after works on a few numbers per
    row, written to the shared folder between the rounds. A row per shard is all that is ever
    broadcast.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = stored(
        df.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    buckets = max(4, parts_of(df))
    copies = base.groupBy("group").agg(F.count("*").alias("copies")).where("copies > 1").select("group", F.lit(True).alias("linked"))
    first = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    rows = stored(
        base.join(copies, "group", "left").select("row", "group", F.col("linked").isNull().alias("single"), first), "shard-start"
    )
    total = rows.count()
    linked = rows.where("NOT single").select("row", "group", "shard")
    for turn in range(rounds):
        linked = stored(_moved(linked, -(-total // shards), turn), "shard-labels")
    labels = linked.withColumn("single", F.lit(False)).unionByName(rows.where("single"))
    ranked = stored(_ranked(labels, buckets), "shard-ranks")

    # A row per shard: what it holds, what it should hold, and where its surplus and its gaps lie in a row.
    spark = df.sparkSession
    everywhere = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    held = ranked.groupBy("shard").agg(F.count("*").alias("held"))
    goal = F.lit(total // shards) + (F.col("shard") < total % shards).cast("int")
    plan = everywhere.join(held, "shard", "left").select("shard", F.coalesce("held", F.lit(0)).alias("held"), goal.alias("goal"))
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    over, under = F.greatest(F.col("held") - F.col("goal"), F.lit(0)), F.greatest(F.col("goal") - F.col("held"), F.lit(0))
    plan = plan.select(
        "shard",
        "goal",
        F.least("held", "goal").alias("stay"),
        F.coalesce(F.sum(over).over(earlier), F.lit(0)).alias("over_from"),
        F.coalesce(F.sum(under).over(earlier), F.lit(0)).alias("under_from"),
        under.alias("under"),
    )
    plan = stored(plan, "shard-plan")
    own = ranked.join(F.broadcast(plan.select("shard", "goal", "over_from")), "shard")
    stays = own.where("rank < goal").select("row", "shard", F.col("rank").alias("slot"))
    gaps = plan.where("under > 0").select(
        F.col("shard").alias("to"), "stay", F.col("under_from").alias("begin"), (F.col("under_from") + F.col("under")).alias("end")
    )
    given = own.where("rank >= goal").select("row", (F.col("over_from") + F.col("rank") - F.col("goal")).alias("at"))
    takes = given.join(F.broadcast(gaps), (F.col("at") >= F.col("begin")) & (F.col("at") < F.col("end"))).select(
        "row", F.col("to").alias("shard"), (F.col("stay") + F.col("at") - F.col("begin")).alias("slot")
    )
    return base.join(stays.unionByName(takes), "row").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
