"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 1024


def dimension(df: DataFrame) -> DataFrame:
    """Broadcast hint for a dimension of one row per fulfilment centre, region or
    calendar day: its size is bounded by the business, not by the facts. Other
    tables are left to Spark's byte threshold and to AQE, or see :func:`growing`."""
    return F.broadcast(df)


def spread_nulls(key: Column, by: Column) -> Column:
    """A left-join key in which null matches nothing, as ever, but is spread over
    many values, so that the rows without a key don't meet in one task."""
    return F.coalesce(key, F.concat(F.lit("\x00"), F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("string")))


def growing(df: DataFrame) -> DataFrame:
    """Keep a side that grows with the input (one row per item) out of broadcasts:
    Spark picks them by compressed bytes, and in memory every executor would hold
    many times that. Both sides are shuffled and sorted instead."""
    return df.hint("merge")
