"""Daily target-snapshot table monitoring and repair, and the
persistent recommendation / history tables.

Tables are parquet folders partitioned by ``snapshot_date``. Deleting or
replacing a day is a dynamic partition overwrite of exactly that day's
partitions; replacement rows are staged in the shared checkpoint folder before
the overwrite, so a rerun (or a lost executor) never reads a half-written day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restock.functions.columns import is_false_or_null, supplier_vendor
from restock.functions.joins import dimension
from restock.session import staging_path


def outl_monitor(excess_base: DataFrame) -> DataFrame:
    """O1: total safety stock per snapshot day, newest first."""
    return (excess_base.groupBy("snapshot_date").agg(F.sum("ss").alias("ss"))
            .orderBy(F.col("snapshot_date").desc()))


def outl_bad_dates(excess_base: DataFrame) -> DataFrame:
    """O2: days whose safety stock came in as zero (failed upstream load)."""
    return (excess_base.groupBy("snapshot_date").agg(F.sum("ss").alias("ss"))
            .where(F.coalesce(F.col("ss"), F.lit(0.0)) == 0).select("snapshot_date"))


def repair_plan(excess_base: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """(bad_date, source_date): each bad day - the listed days, or without a list
    the days of zero safety stock - takes the last good day before it; null if
    there is none. Good: not listed, and not zero either. One aggregate over the
    rows; the rest works on the day table (one row per calendar day)."""
    days = excess_base.groupBy("snapshot_date").agg((F.coalesce(F.sum("ss"), F.lit(0.0)) == 0).alias("_zero"))
    if listed is None:
        days = days.withColumn("_bad", F.col("_zero"))
    else:
        marked = listed.select("snapshot_date").distinct().withColumn("_listed", F.lit(True))
        days = days.join(dimension(marked), "snapshot_date", "left").withColumn("_bad", F.col("_listed").isNotNull())
    # the days as one array: a few thousand at most
    every = days.agg(F.collect_list(F.struct("snapshot_date", "_bad", "_zero")).alias("_days"))
    one = every.select("_days", F.explode(F.filter("_days", lambda x: x["_bad"])["snapshot_date"]).alias("bad_date"))
    earlier = F.filter("_days", lambda x: ~x["_bad"] & ~x["_zero"] & (x["snapshot_date"] < F.col("bad_date")))
    return one.select("bad_date", F.array_max(F.transform(earlier, lambda x: x["snapshot_date"])).alias("source_date"))


def unrepaired_days(plan: DataFrame) -> DataFrame:
    """The bad days of a plan that have no earlier good day: their rows stay as
    they are, and someone should know."""
    return plan.where("source_date is null").select(F.col("bad_date").alias("snapshot_date"))


def latest_good_snapshot(excess_base: DataFrame, as_of: dt.date) -> dt.date | None:
    """The last day on or before ``as_of`` whose load is good (safety stock not
    all zero): the snapshot a run before the upstream batch finishes should use.
    One small aggregate over the day totals; returns a single date."""
    row = (excess_base.where(F.col("snapshot_date") <= F.lit(as_of))
           .groupBy("snapshot_date").agg(F.sum("ss").alias("ss"))
           .where(F.coalesce(F.col("ss"), F.lit(0.0)) != 0)
           .agg(F.max("snapshot_date").alias("d")).first())
    return row.d if row else None


def drop_snapshots(excess_base: DataFrame, dates: DataFrame) -> DataFrame:
    """The table without the listed days (a day list)."""
    return excess_base.join(dimension(dates.select("snapshot_date")), "snapshot_date", "left_anti")


def replacement_rows(excess_base: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of each source day re-dated to the bad day, exact duplicates
    removed (all other columns unchanged)."""
    cols = [c for c in excess_base.columns if c != "snapshot_date"]
    return (excess_base.join(dimension(plan.withColumnRenamed("source_date", "snapshot_date")),
                             "snapshot_date")
            .select(F.col("bad_date").alias("snapshot_date"), *cols).distinct())


def outl_repair(excess_base: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """O3: the repaired table = untouched days + replacement rows of bad days.
    Bad days without an earlier good day stay (see ``unrepaired_days``)."""
    plan = repair_plan(excess_base, listed).where("source_date is not null")
    kept = drop_snapshots(excess_base, plan.select(F.col("bad_date").alias("snapshot_date")))
    return kept.unionByName(replacement_rows(excess_base, plan))


def repair_table(spark: SparkSession, path: str, dates: Iterable[dt.date] | None = None) -> DataFrame:
    """Repair a parquet table in place: stage replacement rows, then overwrite
    only the repaired days' partitions. Returns the replacement rows."""
    eb = spark.read.parquet(path)
    listed = None if dates is None else spark.createDataFrame([(d,) for d in dates], "snapshot_date date")
    plan = repair_plan(eb, listed).where("source_date is not null")
    stage = staging_path(spark, "outl-repair")
    replacement_rows(eb, plan).write.mode("overwrite").parquet(stage)
    staged = spark.read.schema(eb.schema).parquet(stage)
    (staged.select(*eb.columns).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path))
    return staged


def delete_days(spark: SparkSession, path: str, dates: Iterable[dt.date]) -> None:
    """S8 in place: remove the partitions of the listed days from a table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    fs = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for d in dates:
        fs.delete(folder(f"{path}/snapshot_date={d.isoformat()}"), True)


# -- S6: persistent recommendation table ---------------------------------------

RECOMMENDATION_SCHEMA = T.StructType([
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("supply_planner", T.StringType()),
    T.StructField("mc1", T.StringType()),
    T.StructField("action_", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("product_abc_code", T.StringType()),
    T.StructField("private_label_flag", T.BooleanType()),
    T.StructField("is_new_item", T.BooleanType()),
    T.StructField("avg_daily_forecast", T.DecimalType(18, 6)),
    T.StructField("supplier", T.StringType()),
    T.StructField("vendor_name", T.StringType()),
    T.StructField("vendor_distribution_method", T.StringType()),
    T.StructField("vendor_direct_import_flag", T.BooleanType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("erdd", T.DateType()),
    T.StructField("moq", T.IntegerType()),
    T.StructField("projected_region_oos", T.BooleanType()),
    T.StructField("fc_need", T.DecimalType(18, 6)),
    T.StructField("proposed_fc_qty", T.IntegerType()),
    T.StructField("fc_region_need_percent", T.DecimalType(18, 6)),
    T.StructField("region_proposed_cummulative_quantity", T.IntegerType()),
    T.StructField("total_region_ss", T.DecimalType(18, 6)),
    T.StructField("total_region_ip", T.DecimalType(18, 6)),
    T.StructField("total_region_need", T.DecimalType(18, 6)),
    T.StructField("fc_need_rank_in_region", T.IntegerType()),
    T.StructField("region_need_left_after_ordering_cummulative", T.DecimalType(18, 6)),
    T.StructField("item_moq_more_than_60dos", T.BooleanType()),
])

_BASE_TO_TABLE = {
    "region_proposed_qty_cummulative": "region_proposed_cummulative_quantity",
    "total_reg_outl": "total_region_ss",
    "total_reg_ip": "total_region_ip",
    "total_reg_need": "total_region_need",
    "region_need_left_after_order_cummulative": "region_need_left_after_ordering_cummulative",
    "has_high_moq": "item_moq_more_than_60dos",
}


def to_recommendation_table(rec_base: DataFrame, snapshot_date: dt.date) -> DataFrame:
    """Base-variant output shaped and typed as the persistent table."""
    df = rec_base
    for a, b in _BASE_TO_TABLE.items():
        df = df.withColumnRenamed(a, b)
    df = df.withColumn("snapshot_date", F.lit(snapshot_date))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECOMMENDATION_SCHEMA.fields])


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write by ``snapshot_date``; overwrite replaces only the days present in
    ``df`` (idempotent daily append)."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_date").parquet(path))


def append_history(rows: DataFrame, path: str) -> int:
    """Append rows to a stored table without touching the other rows of
    their days; rows that are there already are not added again, so a rerun adds
    nothing. Returns the number of rows added."""
    spark = rows.sparkSession
    new = rows
    if spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(
            spark._jvm.org.apache.hadoop.fs.Path(path)):
        there = spark.read.parquet(path).select(*[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"t.{c}")) for c in rows.columns]
        new = rows.alias("n").join(there.alias("t"), same, "left_anti")
    stage = staging_path(spark, "history-append")
    new.write.parquet(stage)
    staged = spark.read.schema(rows.schema).parquet(stage)
    n = staged.count()
    if n:
        staged.write.mode("append").partitionBy("snapshot_date").parquet(path)
    return n


# -- S7: historical recommendation files -------------------------------------------

def history_import(hist: DataFrame, products: DataFrame, vendors: DataFrame) -> DataFrame:
    """Keep file rows whose item is not private label and whose vendor (the
    supplier code before '-') is not a direct importer."""
    pr = products.where(is_false_or_null(F.col("private_label_flag"))).select(
        F.col("product_part_number").alias("item"))
    v = vendors.where(is_false_or_null(F.col("direct_import_flag"))).select("vendor_number")
    return (hist.join(pr, "item", "left_semi")
            .join(v, supplier_vendor(F.col("supplier")) == v.vendor_number, "left_semi"))
