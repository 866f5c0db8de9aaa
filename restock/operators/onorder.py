"""Open transfer / replenishment orders by region and week."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.functions.columns import date_from_parts, week_start
from restock.functions.joins import dimension
from restock.params import Params


def weekly_on_order(onorder: DataFrame, products: DataFrame, documents: DataFrame,
                    locations: DataFrame, region_map: DataFrame, p: Params) -> DataFrame:
    """Open quantity by item, region, week of the expected date; only lots
    carrying one of the markers, dated on or after the run date."""
    d = date_from_parts(F.col("year"), F.col("month"), F.col("day"))
    lot = reduce(lambda a, b: a | b, [F.col("lotid").contains(m) for m in p.onorder_lot_markers])
    o = onorder.where(lot).withColumn("_d", d).where(F.col("_d") >= F.lit(p.as_of))
    fcs = dimension(locations.select("location_key", "location_code")
                            .join(dimension(region_map), "location_code")
                            .select("location_key", "region"))
    return (o.join(products.select(F.col("product_part_number").alias("item")), "item", "left_semi")
            .join(documents.withColumnRenamed("document_number", "lotid"), "lotid")
            .join(fcs, "location_key")
            .groupBy(F.col("item").alias("product_part_number"), "region", week_start("_d").alias("week"))
            .agg(F.sum("onordqty").alias("oo_region")))


def undated_on_order(onorder: DataFrame, p: Params) -> DataFrame:
    """Rows of R8's lots, and how many of them have no valid expected date:
    those cannot be placed in a week and are not part of R8."""
    d = date_from_parts(F.col("year"), F.col("month"), F.col("day"))
    lot = reduce(lambda a, b: a | b, [F.col("lotid").contains(m) for m in p.onorder_lot_markers])
    return onorder.where(lot).agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(d.isNull(), 1)).alias("n_undated"))


def region_on_order(weekly: DataFrame) -> DataFrame:
    """R9"""
    return weekly.groupBy("product_part_number", "region").agg(F.sum("oo_region").alias("oo_region"))


def network_weekly_on_order(weekly: DataFrame) -> DataFrame:
    """R10"""
    return weekly.groupBy("product_part_number", "week").agg(F.sum("oo_region").alias("oo_network"))


def network_on_order(reg: DataFrame) -> DataFrame:
    """R11"""
    return reg.groupBy("product_part_number").agg(F.sum("oo_region").alias("oo_network"))
