"""Typed CSV hand-off files with an explicit reject split.

Spark does not enforce ``varchar(n)`` widths and, in PERMISSIVE mode, turns an
unparsable field into null. ``read_typed_csv`` therefore reads every declared
column as text next to the typed value and splits the rows into accepted and
rejected: a row is rejected when a text field is wider than declared, or when
a non-empty field does not parse as its declared type, or when the line has
more or fewer fields than declared. Everything stays a
column expression, so the check runs inside the scan's codegen stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    width: int | None = None  # varchar(n); None = unbounded


NEW_ITEMS = [Col("item_id", T.StringType(), 7)]

RECOMMENDATIONS = [
    Col("action", T.StringType(), 10),
    Col("item_id", T.StringType(), 6),
    Col("region", T.StringType(), 12),
    Col("location_cd", T.StringType(), 4),
    Col("supplier", T.StringType(), 15),
    Col("proposed_qty", T.IntegerType()),
    Col("fc_region_need_percent", T.DoubleType()),
]

HISTORY = [
    Col("snapshot_date", T.DateType()),
    Col("action_", T.StringType(), 30),
    Col("item", T.StringType(), 7),
    Col("supplier", T.StringType(), 20),
    Col("proposed_fc_qty", T.IntegerType()),
    Col("fc_region_need_percent", T.DecimalType(18, 6)),
]


CORRUPT = "_corrupt_record"


def _raw_schema(cols: list[Col]) -> T.StructType:
    return T.StructType([T.StructField(c.name, T.StringType()) for c in cols] + [T.StructField(CORRUPT, T.StringType())])


def split_rejects(raw: DataFrame, cols: list[Col]) -> tuple[DataFrame, DataFrame]:
    """(accepted typed rows, rejected raw rows with a ``reject_reason``)."""
    typed, reasons = [], []
    if CORRUPT in raw.columns:
        reasons.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields")))
    for c in cols:
        s = F.col(c.name)
        if isinstance(c.dtype, T.StringType):
            typed.append(s.alias(c.name))
            if c.width is not None:
                reasons.append(F.when(F.length(s) > c.width, F.lit(f"{c.name}: longer than {c.width}")))
        else:
            v = s.try_cast(c.dtype)
            typed.append(v.alias(c.name))
            reasons.append(F.when(s.isNotNull() & (F.trim(s) != "") & v.isNull(),
                                  F.lit(f"{c.name}: not a {c.dtype.simpleString()}")))
    reason = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    flagged = raw.withColumn("reject_reason", reason)
    ok = flagged.where(F.col("reject_reason") == "").select(*typed)
    bad = flagged.where(F.col("reject_reason") != "")
    return ok, bad


def read_typed_csv(spark: SparkSession, path: str, cols: list[Col], header: bool = False,
                   sep: str = ",") -> tuple[DataFrame, DataFrame]:
    raw = (spark.read.schema(_raw_schema(cols)).option("header", header).option("sep", sep)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return split_rejects(raw, cols)


def read_new_items(spark: SparkSession, path: str, **kw) -> tuple[DataFrame, DataFrame]:
    """S2"""
    return read_typed_csv(spark, path, NEW_ITEMS, **kw)


def read_recommendations(spark: SparkSession, path: str, **kw) -> tuple[DataFrame, DataFrame]:
    """S3"""
    return read_typed_csv(spark, path, RECOMMENDATIONS, **kw)


def read_history(spark: SparkSession, path: str, **kw) -> tuple[DataFrame, DataFrame]:
    """S7 staging: the historical recommendation file."""
    return read_typed_csv(spark, path, HISTORY, **kw)
