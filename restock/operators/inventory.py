"""Eligible FCs, inventory base, item attributes, regional and network
on-hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.functions.columns import is_true
from restock.functions.joins import dimension
from restock.params import Params


def new_items(item_attr: DataFrame, p: Params) -> DataFrame:
    """Ids carrying the new-item attribute, minus the excluded prefix."""
    return (item_attr
            .where((F.col("attr_cd") == p.new_item_attr)
                   & ~F.col("item_id").startswith(p.new_item_excluded_prefix))
            .select("item_id"))


def eligible_fcs(locations: DataFrame, p: Params) -> DataFrame:
    """Active fulfilment warehouses of the company."""
    return (locations
            .where(is_true(F.col("fulfillment_active"))
                   & (F.col("active_warehouse") == 1)
                   & (F.col("warehouse_type") == 0)
                   & (F.col("company") == p.company))
            .select("location_key", "location_code"))


def eligible_fc_regions(locations: DataFrame, region_map: DataFrame, p: Params) -> DataFrame:
    """Eligible FCs that are in the region map: (location_key, location_code, region).
    Bounded by the number of FCs, so it is broadcast."""
    return dimension(
        eligible_fcs(locations, p).join(dimension(region_map), "location_code")
        .select("location_key", "location_code", "region"))


def inventory_base(snapshot: DataFrame, products: DataFrame, locations: DataFrame,
                   region_map: DataFrame, p: Params) -> DataFrame:
    """R2: item x FC stock on the run date at eligible, mapped FCs."""
    s = snapshot.where(F.col("snapshot_dt") == F.lit(p.as_of))
    fcs = eligible_fc_regions(locations, region_map, p).select("location_key", "region")
    return (s.join(products.select("product_key"), "product_key", "left_semi")
            .join(fcs, "location_key")
            .select("product_part_number", "location_code",
                    F.col("managed_flag").alias("is_assorted"), "region",
                    F.col("sellable_quantity").alias("current_on_hand_fc")))


def item_attributes(inv_base: DataFrame, products: DataFrame, new_item_ids: DataFrame) -> DataFrame:
    """Attributes of the items in the inventory base, with a new-item flag."""
    items = inv_base.select("product_part_number").distinct()
    flags = (new_item_ids.select(F.col("item_id").alias("product_part_number")).distinct()
             .withColumn("_new", F.lit(True)))
    return (items.join(products, "product_part_number")
            .join(flags, "product_part_number", "left")
            .select("product_part_number",
                    F.col("merch_classification1").alias("mc1"),
                    F.col("merch_classification2").alias("mc2"),
                    F.col("merch_classification3").alias("mc3"),
                    F.col("abc_code").alias("product_abc_code"),
                    F.col("discontinued_flag").alias("product_discontinued_flag"),
                    F.col("published_flag").alias("product_published_flag"),
                    "private_label_flag",
                    F.col("_new").isNotNull().alias("is_new_item")))


def region_on_hand(inv_base: DataFrame) -> DataFrame:
    """R4"""
    return inv_base.groupBy("product_part_number", "region").agg(
        F.sum("current_on_hand_fc").alias("current_on_hand_region"))


def network_on_hand(reg_on_hand: DataFrame) -> DataFrame:
    """R5"""
    return reg_on_hand.groupBy("product_part_number").agg(
        F.sum("current_on_hand_region").alias("current_on_hand_network"))
