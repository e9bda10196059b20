"""Scalar column expressions used by the joins, filters, samples and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadmood.functions import rules

#: Stable hashes are whole numbers below this.
HASHES = 1 << 32


def story_key(link_id: Column) -> Column:
    """Last six characters of the parent link; a shorter link is taken whole."""
    return F.right(link_id, F.lit(rules.STORY_ID_LENGTH))


def epoch_text(seconds: Column) -> Column:
    return F.from_unixtime(seconds)


def epoch_day(seconds: Column) -> Column:
    """Day in the session time zone, without formatting and parsing a string."""
    return F.to_date(F.timestamp_seconds(seconds.cast("long")))


def indicator(label: Column, value: int) -> Column:
    """1 where the label has the value, else 0, also where it is NULL."""
    return F.when(label == value, 1).otherwise(0)


def percent(flag: Column) -> Column:
    """Share of rows flagged. COUNT(*) counts rows with a NULL flag too."""
    return 100 * F.sum(flag) / F.count("*")


def key_hash(key: Column, salt: str = "") -> Column:
    """Whole number in [0, HASHES): the same on every run, engine and retry. NULL counts as an empty key."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(key, F.lit("")))), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def in_fraction(key: Column, fraction: float, salt: str = "") -> Column:
    return key_hash(key, salt) < F.lit(fraction * HASHES)


def as_whole_number(text: Column, kind: str = "bigint") -> tuple[Column, Column]:
    """The whole number a text stands for, also written as ``5.0``, and whether it stands for none; blank is NULL."""
    number = text.try_cast("decimal(38, 10)")
    whole = number.try_cast(kind)
    blank = text.isNull() | (F.trim(text) == "")
    return F.when(~blank, whole), ~blank & (whole.isNull() | (number != whole))


def whole_number(text: Column, kind: str = "bigint") -> Column:
    """The whole number a text stands for; blank is NULL, anything else an error."""
    whole, wrong = as_whole_number(text, kind)
    return F.when(wrong, F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast(kind)).otherwise(whole)
