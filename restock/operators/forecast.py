"""Weekly regional forecast and its windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.functions.columns import week_start
from restock.operators.inventory import eligible_fc_regions
from restock.params import Params

ITEM_REGION = ["product_part_number", "region"]


def weekly_forecast(forecast: DataFrame, products: DataFrame, locations: DataFrame,
                    region_map: DataFrame, p: Params) -> DataFrame:
    """Sum of manual-else-statistical forecast by item, region, Monday week,
    for days as_of .. horizon_end at eligible FCs."""
    f = forecast.where(F.col("forecast_dt").between(F.lit(p.as_of), F.lit(p.horizon_end)))
    fcs = eligible_fc_regions(locations, region_map, p).select("location_key", "region")
    # Pre-aggregate before the shuffle: the FC -> region map is a broadcast
    # (map-side) join, so daily item x FC rows are summed to item x region x
    # week (partial + final aggregate) before the product join, which then
    # shuffles ~7 x FCs-per-region fewer rows. Exact: product_key -> part
    # number is one-to-one and both joins only filter or map keys.
    weekly = (f.join(fcs, "location_key")
              .groupBy("product_key", "region", week_start("forecast_dt").alias("week"))
              .agg(F.sum(F.coalesce("manual_quantity", "statistical_quantity")).alias("forecast_region")))
    return (weekly.join(products.select("product_key", "product_part_number"), "product_key")
            .select("product_part_number", "region", "week", "forecast_region"))


def forecast_windows(weekly: DataFrame, p: Params) -> DataFrame:
    """Per (item, region) running forecast and week rank.

    avg_daily_forecast_week keeps the original definition (a mean over the one
    row of an item-region-week, i.e. the weekly total); daily_forecast_mean is
    the true daily mean over the days the week covers inside the horizon."""
    w = Window.partitionBy(*ITEM_REGION).orderBy("week")
    first = F.greatest(F.col("week"), F.lit(p.as_of))
    last = F.least(F.date_add("week", 6), F.lit(p.horizon_end))
    days = F.datediff(last, first) + 1
    return weekly.select(
        "*",
        F.col("forecast_region").alias("avg_daily_forecast_week"),
        F.sum("forecast_region").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("cumulative_forecast_region"),
        F.dense_rank().over(w).alias("week_rank_region"),
        F.round(F.col("forecast_region") / days, 4).alias("daily_forecast_mean"),
    )


def network_weekly_forecast(weekly: DataFrame) -> DataFrame:
    """D1"""
    return weekly.groupBy("product_part_number", "week").agg(
        F.sum("forecast_region").alias("forecast_network"))
