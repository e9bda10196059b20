"""The text rules as a SQL function, without Python in its plan."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from threadmood.functions import text

_STRING = re.compile(r"('(?:\\.|[^'\\])*')", re.S)
# operators that a column shows as calls, such as or(a, b); quoted they are calls in SQL as well
_OPERATOR = re.compile(r"(?<![\w`])(or|and|not|in|!=|<=>|>=|<=|=|>|<|\+|-|\*|/|%|!)\(")


def sql_text(column: Column) -> str:
    """A column of built-in functions as SQL."""
    shown = str(column).removeprefix("Column<'").removesuffix("'>")
    pieces = _STRING.split(shown)
    return "".join(p if i % 2 else _OPERATOR.sub(r"`\1`(", p) for i, p in enumerate(pieces))


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``sanitize(text)`` callable from SQL: the same expression as ``text.sanitize``."""
    body = sql_text(text.sanitize(F.col("body")))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION sanitize(body STRING) RETURNS ARRAY<STRING> RETURN {body}"
    )
