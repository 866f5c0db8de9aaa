"""Inline FC -> region map (a constant dimension supplied as configuration)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

REGION_MAP_SCHEMA = T.StructType([
    T.StructField("location_code", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
])


def region_map(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    """One row per FC code. The mapping is driver-side configuration (tens of
    rows), so the result is safe to broadcast."""
    return spark.createDataFrame(sorted(mapping.items()), REGION_MAP_SCHEMA)
