"""In-stock, order-split and shipping-zone KPIs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.functions.columns import is_false_or_null
from restock.functions.joins import dimension
from restock.operators.inventory import eligible_fcs
from restock.params import Params


def tracked_items(rec_file: DataFrame) -> DataFrame:
    """K8: distinct item ids of the recommendation file."""
    return rec_file.select("item_id").distinct()


def instock_base(snapshot: DataFrame, region_map: DataFrame, lifecycle: DataFrame,
                 rec_file: DataFrame, p: Params) -> DataFrame:
    """K1: item x FC x day stock from ``kpi_start`` to the day before the run,
    replenishable items only, flagged when the item is tracked."""
    s = snapshot.where(F.col("snapshot_dt").between(F.lit(p.kpi_start), F.lit(p.as_of - dt.timedelta(days=1))))
    lc = (lifecycle.where(is_false_or_null(F.col("discontinued_flag")) & is_false_or_null(F.col("dropship_flag")))
          .select(F.col("snapshot_date").alias("snapshot_dt"), "product_part_number", "discontinued_flag"))
    tr = tracked_items(rec_file).select(F.col("item_id").alias("product_part_number"),
                                        F.lit(True).alias("_hg"))
    return (s.join(dimension(region_map), "location_code")
            .join(lc, ["snapshot_dt", "product_part_number"])
            .join(tr, "product_part_number", "left")
            .select(F.col("snapshot_dt").alias("snapshot_date"), "product_part_number", "location_code",
                    "region", F.coalesce("sellable_quantity", F.lit(0)).alias("sellable_units"),
                    F.coalesce("discontinued_flag", F.lit(False)).alias("product_discontinued_flag"),
                    F.col("_hg").isNotNull().alias("hg_ordered_item")))


def oos_units(snapshot: DataFrame, region_map: DataFrame, lifecycle: DataFrame, rec_file: DataFrame,
              p: Params, by_region: bool = True) -> DataFrame:
    """Sellable units per day, item, tracked flag (and region), with the
    filters of ``instock_base``, summed *before* the lifecycle join: the region
    map is a broadcast (map-side) join, so item x FC rows are pre-aggregated to
    item x region (or item) before any shuffle. Exact, because the lifecycle
    snapshot has one row per day and item (a filter here) and the tracked flag
    is a function of the item."""
    s = (snapshot.where(F.col("snapshot_dt").between(F.lit(p.kpi_start), F.lit(p.as_of - dt.timedelta(days=1))))
         .join(dimension(region_map), "location_code"))
    keys = ["snapshot_dt", "product_part_number"] + (["region"] if by_region else [])
    units = s.groupBy(*keys).agg(F.sum(F.coalesce("sellable_quantity", F.lit(0))).alias("sellable_units"))
    lc = (lifecycle.where(is_false_or_null(F.col("discontinued_flag")) & is_false_or_null(F.col("dropship_flag")))
          .select(F.col("snapshot_date").alias("snapshot_dt"), "product_part_number"))
    tr = tracked_items(rec_file).select(F.col("item_id").alias("product_part_number"), F.lit(True).alias("_hg"))
    return (units.join(lc, ["snapshot_dt", "product_part_number"], "left_semi")
            .join(tr, "product_part_number", "left")
            .select(F.col("snapshot_dt").alias("snapshot_date"), "product_part_number",
                    F.col("_hg").isNotNull().alias("hg_ordered_item"),
                    *(["region"] if by_region else []), "sellable_units"))


def region_oos_from_snapshot(snapshot, region_map, lifecycle, rec_file, p: Params) -> DataFrame:
    """K2 computed with pre-aggregation."""
    u = oos_units(snapshot, region_map, lifecycle, rec_file, p, by_region=True)
    return u.select("snapshot_date", "product_part_number", "hg_ordered_item", "region",
                    F.when(F.col("sellable_units") <= 0, 1).otherwise(0).alias("region_oos"))


def network_oos_from_snapshot(snapshot, region_map, lifecycle, rec_file, p: Params) -> DataFrame:
    """K4 computed with pre-aggregation."""
    u = oos_units(snapshot, region_map, lifecycle, rec_file, p, by_region=False)
    return u.select("snapshot_date", "product_part_number", "hg_ordered_item",
                    F.when(F.col("sellable_units") <= 0, 1).otherwise(0).alias("network_oos"))


def region_oos_rate(flags: DataFrame) -> DataFrame:
    """K3"""
    return flags.groupBy("snapshot_date", "region", "hg_ordered_item").agg(
        F.count(F.lit(1)).alias("total_item_locs"),
        F.sum("region_oos").alias("items_oos_in_region"),
        F.round(F.sum("region_oos") / F.count(F.lit(1)), 4).alias("region_oos_percentage"))


def network_oos_rate(flags: DataFrame) -> DataFrame:
    """K5"""
    return flags.groupBy("snapshot_date", "hg_ordered_item").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.sum("network_oos").alias("items_oos_in_network"),
        F.round(F.sum("network_oos") / F.count(F.lit(1)), 4).alias("network_oos_percentage"))


def _eligible_lines(order_line: DataFrame, orders: DataFrame, locations: DataFrame,
                    products: DataFrame, p: Params) -> DataFrame:
    o = orders.where(~F.col("order_status").isin(list(p.excluded_order_status))).select("order_key")
    fcs = dimension(eligible_fcs(locations, p)).select(
        F.col("location_key").alias("fulfillment_center_key"), "location_code")
    return (order_line.join(o, "order_key", "left_semi")
            .join(fcs, "fulfillment_center_key")
            .join(products.select("product_key", "product_part_number"), "product_key"))


def _released_between(order_line: DataFrame, locations: DataFrame, p: Params, start: dt.date, end: dt.date) -> DataFrame:
    """All lines of the orders that have a line released in the period at an
    eligible FC. An order whose first eligible release is in the period has such
    a line, so nothing is lost; the rest of the history is not aggregated."""
    fcs = dimension(eligible_fcs(locations, p)).select(F.col("location_key").alias("fulfillment_center_key"))
    some = (order_line.where(F.col("released_dttm").cast("date").between(F.lit(start), F.lit(end)))
            .join(fcs, "fulfillment_center_key", "left_semi").select("order_key"))
    return order_line.join(some, "order_key", "left_semi")


def split_orders(order_line: DataFrame, orders: DataFrame, locations: DataFrame,
                 products: DataFrame, p: Params) -> DataFrame:
    """K6: orders first released in the last ``split_window_days`` days, split
    when their eligible lines ship from more than one FC. (More than one
    distinct FC is tested as min <> max: one aggregation pass, no distinct
    expansion.)"""
    end = p.as_of - dt.timedelta(days=1)
    start = p.as_of - dt.timedelta(days=p.split_window_days)
    ln = _eligible_lines(_released_between(order_line, locations, p, start, end), orders, locations, products, p)
    return (ln.groupBy("order_key")
            .agg(F.min(F.col("released_dttm").cast("date")).alias("order_released_date"),
                 F.when(F.min("location_code") != F.max("location_code"), 1).otherwise(0).alias("is_split"))
            .where(F.col("order_released_date").between(F.lit(start), F.lit(end))))


def split_order_items(splits: DataFrame, order_line: DataFrame, products: DataFrame) -> DataFrame:
    """K7: every line (any FC) of the selected orders, with its item. (No date
    pre-filter is possible: the order's first release is taken over eligible-FC
    lines only, and lines at other FCs may be released earlier.)"""
    return (splits.join(order_line.select("order_key", "product_key"), "order_key")
            .join(products.select("product_key", "product_part_number"), "product_key")
            .select("order_key", "order_released_date", "is_split", "product_part_number"))


def split_rate(split_items: DataFrame, rec_file: DataFrame) -> DataFrame:
    """K9: split rate per release day, by whether the order holds a tracked item."""
    tr = tracked_items(rec_file).select(F.col("item_id").alias("product_part_number"),
                                        F.lit(1).alias("_hit"))
    per_order = (split_items.join(tr, "product_part_number", "left")
                 .groupBy("order_released_date", "order_key")
                 .agg(F.max("is_split").alias("is_split"),
                      F.least(F.lit(1), F.sum(F.coalesce("_hit", F.lit(0)))).alias("contains_nbhg_item")))
    return per_order.groupBy("order_released_date", "contains_nbhg_item").agg(
        (F.sum("is_split") / F.count(F.lit(1))).alias("split_rate"),
        F.sum("is_split").alias("split_order_count"),
        F.count(F.lit(1)).alias("count_orders"))


def order_zone(order_line: DataFrame, orders: DataFrame, shipments: DataFrame, locations: DataFrame,
               products: DataFrame, rec_file: DataFrame, p: Params) -> DataFrame:
    """Per order, tracked-item flag, first release day and mean ship zone
    of its eligible lines; orders released from ``zone_start`` to yesterday."""
    recent = _released_between(order_line, locations, p, p.zone_start, p.as_of - dt.timedelta(days=1))
    ln = _eligible_lines(recent, orders, locations, products, p).join(shipments, "order_line_id")
    tr = tracked_items(rec_file).select(F.col("item_id").alias("product_part_number"),
                                        F.lit(1).alias("_hit"))
    return (ln.join(tr, "product_part_number", "left").groupBy("order_key")
            .agg(F.least(F.lit(1), F.sum(F.coalesce("_hit", F.lit(0)))).alias("contains_nbhg_item"),
                 F.min(F.col("released_dttm").cast("date")).alias("order_released_date"),
                 F.avg("actual_zone").alias("actual_zone"))
            .where(F.col("order_released_date").between(F.lit(p.zone_start),
                                                        F.lit(p.as_of - dt.timedelta(days=1)))))


def avg_zone(zones: DataFrame) -> DataFrame:
    """Mean of the per-order mean zone."""
    return zones.groupBy("order_released_date", "contains_nbhg_item").agg(
        F.round(F.avg("actual_zone"), 6).alias("avg_zone_shipped"))
