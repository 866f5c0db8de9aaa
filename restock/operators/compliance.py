"""Buyer compliance with the recommendations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.functions.columns import is_false_or_null, safe_div, supplier_vendor
from restock.functions.joins import dimension, growing
from restock.params import Params


def units_by_action(rec_file: DataFrame, products: DataFrame, vendors: DataFrame) -> DataFrame:
    """Recommended units per action, private label and direct import excluded."""
    pr = products.where(is_false_or_null(F.col("private_label_flag"))).select(
        F.col("product_part_number").alias("item_id"))
    v = vendors.where(is_false_or_null(F.col("direct_import_flag"))).select("vendor_number")
    return (rec_file.join(pr, "item_id", "left_semi")
            .join(v, supplier_vendor(F.col("supplier")) == v.vendor_number, "left_semi")
            .groupBy("action").agg(F.sum("proposed_qty").alias("total_ordered_units")))


def placed_orders(proc: DataFrame, products: DataFrame, vendors: DataFrame, locations: DataFrame,
                  p: Params) -> DataFrame:
    """Purchase lines ordered ``compliance_lag_days`` before the run date by
    listed buyers, still open."""
    day = p.as_of - dt.timedelta(days=p.compliance_lag_days)
    f = proc.where(
        (F.col("document_order_dttm").cast("date") == F.lit(day))
        & (F.col("deleted_by_users") == F.lit(False))
        & (F.col("document_type") == p.document_type)
        & (F.col("data_source") == p.data_source)
        & F.col("purchaser_code").isin(list(p.buyers))
        & is_false_or_null(F.col("wms_closed_flag"))
        & is_false_or_null(F.col("ready_to_reconcile_flag")))
    return (f.join(growing(products.select("product_key")), "product_key", "left_semi")
            .join(vendors.select("vendor_key", "vendor_number", "vendor_name"), "vendor_key")
            .join(dimension(locations.select("location_key", "location_code")), "location_key")
            .select(F.col("document_order_dttm").cast("date").alias("document_order_date"),
                    "purchaser_code", "document_number", "location_code", "vendor_number", "vendor_name",
                    "product_part_number", F.col("requested_delivery_dttm").alias("rdd"),
                    F.col("expected_receipt_dttm").alias("erdd"), "original_quantity",
                    "last_version_quantity", "outstanding_quantity", "total_cost"))


ROLLUP_KEYS = ["document_order_date", "purchaser_code", "location_code", "product_part_number",
               "vendor_number", "vendor_name", "rdd", "erdd"]


def placed_orders_rollup(orders: DataFrame) -> DataFrame:
    """One row per day, buyer, FC, item, vendor and dates; document numbers
    listed comma-separated in ascending order."""
    return orders.groupBy(*ROLLUP_KEYS).agg(
        F.array_join(F.array_sort(F.collect_list("document_number")), ",").alias("orders_placed"),
        F.sum("original_quantity").alias("original_quantity"),
        F.sum("last_version_quantity").alias("last_version_quantity"),
        F.sum("outstanding_quantity").alias("outstanding_quantity"),
        F.round(F.sum("total_cost"), 2).alias("total_cost"),
    ).withColumn("units_per_cost", safe_div(F.col("original_quantity"), F.col("total_cost"))) \
     .withColumn("cost_per_unit", safe_div(F.col("total_cost"), F.col("original_quantity")))


def network_demand(rollup: DataFrame, item_location: DataFrame, locations: DataFrame,
                   p: Params) -> DataFrame:
    """C4: network average demand of the ordered items, over item-FC settings
    not supplied by an own FC and with a real supplier prefix."""
    own = dimension(
        locations.where(F.coalesce(F.col("fulfillment_active"), F.lit(False))
                        & (F.col("company") == p.company) & (F.col("warehouse_type") == 0))
        .select(F.col("location_code").alias("_pfx")).distinct())
    items = rollup.select(F.col("product_part_number").alias("item")).distinct()
    cil = (item_location.withColumn("_pfx", supplier_vendor(F.col("supplier")))
           .where(F.col("_pfx").isNotNull() & ~F.col("_pfx").isin("", "?"))
           .join(own, "_pfx", "left_anti"))
    # sums before the semi join: the join then sorts one row per item, not one per item and FC
    demand = cil.groupBy("item").agg(F.round(F.sum("avedemqty"), 5).alias("network_avedemqty"))
    return (demand.join(items, "item", "left_semi")
            .select(F.col("item").alias("product_part_number"), "network_avedemqty"))


def compliance_items(rollup: DataFrame, products: DataFrame, vendors: DataFrame) -> DataFrame:
    """The items of C5, without its other joins."""
    own = products.where(is_false_or_null(F.col("private_label_flag"))).select("product_part_number")
    v = vendors.where(is_false_or_null(F.col("direct_import_flag"))).select("vendor_number")
    return (rollup.select("product_part_number", "vendor_number").join(v, "vendor_number", "left_semi")
            .join(growing(own), "product_part_number", "left_semi").select("product_part_number").distinct())


def compliance(rollup: DataFrame, products: DataFrame, vendors: DataFrame, demand: DataFrame,
               item_uom: DataFrame, excess_base: DataFrame, rec_file: DataFrame,
               p: Params, detail: bool = False) -> DataFrame:
    """Placed orders next to the recommendation for the same item, vendor
    and FC ('Manual Order' when none) and the excess-base targets of the order
    day and the day after."""
    pr = products.select("product_part_number", F.col("merch_classification1").alias("mc1"),
                         F.col("abc_code").alias("product_abc_code"), "private_label_flag",
                         F.col("discontinued_flag").alias("product_discontinued_flag"))
    v = vendors.select("vendor_number", F.col("vendor_name").alias("_vname"),
                                         F.col("direct_import_flag").alias("vendor_direct_import_flag"))
    # one unit-of-measure row per item (the warehouse may list several units)
    uom = (item_uom.where(F.col("wh_id") == p.uom_warehouse)
           .groupBy(F.col("item_number").alias("product_part_number"))
           .agg(F.max(F.col("cartonization_flag") == "NO").alias("_sioc")))
    # all placed orders are of one day, so only that day and the next are read
    # (a literal partition filter, whatever join strategy is picked)
    day = p.as_of - dt.timedelta(days=p.compliance_lag_days)
    eb = (excess_base.where(F.col("snapshot_date").between(F.lit(day), F.lit(day + dt.timedelta(days=1))))
          .select("product_part_number", "snapshot_date", "oh_oo", "outl", "units_above_outl",
                  "fcast_over_lt_rp", "oh", "oo"))
    oy = eb.select("product_part_number", F.col("snapshot_date").alias("document_order_date"),
                   F.col("oh_oo").alias("ip_dayof"), F.col("outl").alias("_outl_y"),
                   F.col("units_above_outl").alias("_above_y"), F.col("fcast_over_lt_rp").alias("_fclt_y"),
                   F.col("oh").alias("oh_dayof"), F.col("oo").alias("oo_dayof"))
    ot = eb.select("product_part_number", F.date_sub("snapshot_date", 1).alias("document_order_date"),
                   F.col("oh_oo").alias("ip_dayafter"), F.col("outl").alias("_outl_t"),
                   F.col("units_above_outl").alias("_above_t"),
                   F.col("oh").alias("oh_dayafter"), F.col("oo").alias("oo_dayafter"))
    ro = rec_file.select(F.col("item_id").alias("product_part_number"),
                         supplier_vendor(F.col("supplier")).alias("vendor_number"),
                         F.col("location_cd").alias("location_code"), "action", "region",
                         "proposed_qty", "fc_region_need_percent")
    j = (rollup.join(growing(pr), "product_part_number").join(v, "vendor_number")
         .where(is_false_or_null(F.col("private_label_flag"))
                & is_false_or_null(F.col("vendor_direct_import_flag")))
         .join(growing(demand), "product_part_number", "left")
         .join(growing(uom), "product_part_number", "left")
         .join(growing(oy), ["product_part_number", "document_order_date"], "left")
         .join(growing(ot), ["product_part_number", "document_order_date"], "left")
         .join(ro, ["product_part_number", "vendor_number", "location_code"], "left"))
    change = F.col("_above_t") - F.col("_above_y")
    # Lead-time forecast and raw on-hand / on-order of both days
    d8 = [F.round("_fclt_y", 5).alias("fcast_over_lt_rp"), "oo_dayof", "oh_dayof",
          "oo_dayafter", "oh_dayafter"] if detail else []
    return j.select(
        "purchaser_code", "mc1", "document_order_date", "region", "location_code", "orders_placed",
        F.coalesce("action", F.lit("Manual Order")).alias("recommendation"),
        "product_part_number", "product_abc_code", "private_label_flag", "product_discontinued_flag",
        F.coalesce("_sioc", F.lit(False)).alias("is_sioc_item"), "network_avedemqty",
        "vendor_number", "vendor_name", "vendor_direct_import_flag", "rdd", "erdd",
        (F.col("original_quantity") - F.col("proposed_qty")).alias("order_prop_qty_delta"),
        "proposed_qty", "fc_region_need_percent", "original_quantity", "last_version_quantity",
        "outstanding_quantity", "total_cost",
        "ip_dayof", F.round("_outl_y", 0).alias("outl_dayof"),
        F.round("_above_y", 0).alias("excess_units_dayof"),
        "ip_dayafter", F.round("_outl_t", 0).alias("outl_dayafter"),
        F.round("_above_t", 0).alias("excess_units_dayafter"),
        F.round(change, 0).alias("dod_excess_change"),
        F.round(safe_div(change, F.col("network_avedemqty")), 2).alias("network_dos_for_excess_inventory_change"),
        *d8,
    )


PERF_MEASURES = [("units_sold", "total_units_sold_t90", "avg_daily_units_sold"),
                 ("gross_sales", "total_gross_sales_t90", "avg_gross_sales"),
                 ("gross_margin", "total_gross_margin_t90", "avg_gross_margin"),
                 ("contribution_margin", "total_cm_t90", "avg_contribution_margin"),
                 ("distinct_pdp_views", "total_distinct_pdp_views", "avg_pdp_views")]


def trailing_performance(perf: DataFrame, items: DataFrame, p: Params) -> DataFrame:
    """Sums and daily means over the trailing window for the compliance
    items. Each item is counted once (semi join), not once per order line."""
    end = p.as_of - dt.timedelta(days=p.performance_end_lag_days)
    start = end - dt.timedelta(days=p.performance_days - 1)
    f = perf.where(F.col("activity_date").between(F.lit(start), F.lit(end)))
    aggs = []
    for src, tot, avg in PERF_MEASURES:
        aggs += [F.sum(src).alias(tot), F.avg(src).alias(avg)]
    # the compliance items are few: keep their days first, then aggregate
    return (f.join(items.select("product_part_number"), "product_part_number", "left_semi")
            .groupBy("product_part_number").agg(*aggs))


REPORT_COLUMNS = [
    "purchaser_code", "mc1", "document_order_date", "region", "location_code", "recommendation",
    "product_part_number", "product_abc_code", "network_avedemqty", "orders_placed",
    "order_prop_qty_delta", "proposed_qty", "fc_region_need_percent", "original_quantity", "total_cost",
    "excess_units_dayof", "excess_units_dayafter", "dod_excess_change",
    "network_dos_for_excess_inventory_change"]


def compliance_report(comp: DataFrame, perf_t: DataFrame) -> DataFrame:
    """C7"""
    extra = [c for _, t, a in PERF_MEASURES for c in (t, a)]
    return comp.join(perf_t, "product_part_number", "left").select(*REPORT_COLUMNS, *extra)
