"""Declared schemas: no inference pass, and ids such as ``0123456`` stay text."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


COMMENTS = _struct(
    id=T.StringType(),
    body=T.StringType(),
    created_utc=T.LongType(),
    author_flair_text=T.StringType(),
    link_id=T.StringType(),
    score=T.LongType(),
)

STORIES = _struct(id=T.StringType(), title=T.StringType(), score=T.LongType())

LABELS = _struct(
    Input_id=T.StringType(),
    labeldem=T.IntegerType(),
    labelgop=T.IntegerType(),
    labeldjt=T.IntegerType(),
)

SCORED = _struct(
    id=T.StringType(),
    body=T.StringType(),
    created_utc=T.LongType(),
    author_flair_text=T.StringType(),
    title=T.StringType(),
    comment_score=T.LongType(),
    story_score=T.LongType(),
    pos=T.DoubleType(),
    neg=T.DoubleType(),
)

# key column of each report; "overall" has none
REPORT_KEYS = {
    "overall": None,
    "by_day": T.StructField("date", T.DateType()),
    "by_place": T.StructField("place", T.StringType()),
    "by_comment_score": T.StructField("comment_score", T.LongType()),
    "by_story_score": T.StructField("story_score", T.LongType()),
}


def report(name: str) -> T.StructType:
    key = REPORT_KEYS[name]
    return T.StructType(
        ([key] if key else [])
        + [
            T.StructField("percent_pos", T.DoubleType()),
            T.StructField("percent_neg", T.DoubleType()),
        ]
    )
