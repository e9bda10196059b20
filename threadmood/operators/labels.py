"""Labels as training targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmood.functions.scalar import indicator

_TWO_CLASSES = {"ml_attr": {"type": "nominal", "vals": ["0", "1"]}}


def binarize(df: DataFrame, label_col: str) -> DataFrame:
    label = F.col(label_col)
    return df.withColumns({"pos_label": indicator(label, 1), "neg_label": indicator(label, -1)})


def rejoin_labels(labeled: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """Label flags by a second join: rows that met n labels come out n * n times."""
    side = labels.select("Input_id", label_col)
    joined = labeled.join(side, labeled["id"] == side["Input_id"])
    return binarize(joined, label_col).drop("Input_id", label_col)


def with_repeats(labels: DataFrame) -> DataFrame:
    """Each label row once, with ``copies`` and ``weight``: how often it is there, times the rows of its id.

    Training on the n rows of an id with weight n equals training on the n * n rows
    of the second join, without making them. Equal rows are counted before they are
    moved, so an id with very many of them is a few rows by then.
    """
    groups = labels.groupBy(*labels.columns).agg(F.count("*").alias("copies"))
    per_id = groups.groupBy(F.col("Input_id").alias("counted_id")).agg(
        F.sum("copies").alias("rows_of_id")
    )
    return groups.join(per_id, groups["Input_id"] == per_id["counted_id"]).select(
        *labels.columns, "copies", (F.col("copies") * F.col("rows_of_id")).cast("double").alias("weight")
    )


def repeated(rows: DataFrame) -> DataFrame:
    """Rows as often as their ``copies`` say."""
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return rows.withColumn("copies", times).drop("copies")


def training_rows(comments: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled comments with all their label columns and training weight."""
    bodies, weighted = comments.select("id", "body"), with_repeats(labels)
    on = bodies["id"] == weighted["Input_id"]
    return bodies.join(weighted, on).drop("Input_id")


def training_pairs(frame: DataFrame, label: str, *carry: str) -> DataFrame:
    """(label, features, weight) of one polarity, ``label`` being its flag column.

    The label is declared to have two values, so that a fold without a flagged row can
    still be evaluated.
    """
    flag = F.col(label).alias("label", metadata=_TWO_CLASSES)
    return frame.select(flag, "features", "weight", *carry)
