"""Full need table, running need, needed fraction, the
APPROVE / REJECT ladder, and the dormant network-level measures.

Plan shape: every window here is partitioned by (item, region) or by item, so
Spark needs a single exchange on item for ranks, running sums and regional
totals (a window sum replaces the group-by + join back of the regional totals).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.functions.columns import clamp0, need_fraction, safe_div, supplier_vendor, week_start
from restock.functions.joins import spread_nulls
from restock.operators.proposals import _check, rank_windows
from restock.params import Params

REJECT_NO_PROPOSAL = "REJECT: Did not Propose"
REJECT_INSTOCK_FILLIN = "REJECT: instock Fill-in"
APPROVE, REJECT = "APPROVE", "REJECT"


def ranked_need(tunnel: DataFrame, variant: str = "fillin") -> DataFrame:
    """R17 + R18 + R20/R21 running sums over windows on item: ranks (over all
    tunnel rows), regional totals (only non-fill-in rows count; regions without
    such a row are dropped, like the inner join with the regional table), then
    running proposed quantity by regional and by network rank over the rows
    that remain."""
    _check(variant)
    wr, wn = rank_windows(variant)
    run = (Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("item", "region")
    counted = ~F.col("is_fillin") if variant == "fillin" else F.lit(True)
    outl = F.sum(F.when(counted, clamp0(F.col("fc_outl")))).over(whole)
    ip = F.sum(F.when(counted, clamp0(F.col("fc_ip")))).over(whole)
    n_counted = F.count(F.when(counted, F.lit(1))).over(whole)
    t = (tunnel.select(
        "*",
        F.row_number().over(wr).alias("fc_need_rank_in_region"),
        F.row_number().over(wn).alias("fc_need_rank_in_network"),
        outl.alias("total_reg_outl"), ip.alias("total_reg_ip"), n_counted.alias("_n"))
        .where(F.col("_n") > 0).drop("_n"))
    by_reg = (Window.partitionBy("item", "region").orderBy("fc_need_rank_in_region").rowsBetween(*run))
    by_net = (Window.partitionBy("item").orderBy("fc_need_rank_in_network").rowsBetween(*run))
    return t.select(
        "*",
        (F.col("total_reg_outl") - F.col("total_reg_ip")).alias("total_reg_need"),
        F.sum("proposed_qty").over(by_reg).alias("region_proposed_qty_cummulative"),
        F.sum("proposed_qty").over(by_net).alias("network_proposed_qty_cummulative"))


def full_need(tunnel: DataFrame, excess_base: DataFrame, proj_state: DataFrame, p: Params,
              variant: str = "fillin") -> DataFrame:
    """R19 + R20 + R21: every ranked proposal row with regional totals, network
    targets of the excess-base snapshot, and the projected regional stock of the
    week its order would arrive (null projection counts as out of stock)."""
    _check(variant)
    t = ranked_need(tunnel, variant)
    outl = (excess_base.where(F.col("snapshot_date") == F.lit(p.outl_day))
            .select(F.col("product_part_number").alias("item"), "outl", "oh_oo"))
    fin = proj_state.select(
        F.col("product_part_number").alias("item"), "region", F.col("week").alias("_week"),
        "product_abc_code", "is_new_item", "avg_daily_forecast", "projected_on_hand_region",
        "projected_on_order_region", "current_on_hand_network", "current_on_order_network",
        F.lit(True).alias("_fin"))
    j = (t.withColumn("_week", week_start("duedate"))
         .join(outl, "item", "left")
         .join(fin, ["item", "region", "_week"], "left"))
    oos_name = "projected_region_oos_erddweek" if variant == "fillin" else "projected_region_oos"
    left = F.col("total_reg_need") - F.col("region_proposed_qty_cummulative")
    net_ip = F.col("oh_oo") + F.col("network_proposed_qty_cummulative")
    cols = ["item", "product_abc_code", "is_new_item",
            F.round("avg_daily_forecast", 3).alias("avg_daily_forecast"), "region", "location"]
    if variant == "fillin":
        cols += ["proposal_type", "is_fillin"]
    cols += ["supplier", "moq", "review_period", F.col("prundate").alias("release_date"),
             F.col("duedate").alias("erdd"),
             (F.coalesce("projected_on_hand_region", F.lit(0.0)) <= 0).alias(oos_name),
             F.col("_fin").isNull().alias("projection_missing"),
             "projected_on_hand_region", "projected_on_order_region",
             "fc_outl", "fc_ip", "fc_need",
             "total_reg_outl", "total_reg_ip", "total_reg_need",
             "current_on_hand_network", "current_on_order_network",
             F.col("outl").alias("current_outl_network_calcd"),
             F.col("oh_oo").alias("current_ip_network_calcd"),
             (F.col("outl") - F.col("oh_oo")).alias("current_need_network"),
             F.col("proposed_qty").alias("proposed_fc_qty"),
             net_ip.alias("current_network_ip_with_proposed_qty_cummulative_calcd"),
             (net_ip - F.col("outl")).alias("current_network_excess_created_cummulative_calcd"),
             "fc_need_rank_in_region", "fc_need_rank_in_network",
             "region_proposed_qty_cummulative", "network_proposed_qty_cummulative",
             left.alias("region_need_left_after_order_cummulative")]
    return j.select(*cols)


def with_need_fraction(full: DataFrame) -> DataFrame:
    """R22"""
    return full.withColumn(
        "fc_region_need_percent",
        need_fraction(F.col("region_need_left_after_order_cummulative"), F.col("proposed_fc_qty")))


def decision(variant: str, p: Params):
    """The action ladder as one CASE expression."""
    _check(variant)
    frac = F.col("fc_region_need_percent")
    rank1 = F.col("fc_need_rank_in_region") == 1
    ladder = F.when(F.col("supplier").isNull(), F.lit(REJECT_NO_PROPOSAL))
    if variant == "fillin":
        oos = F.col("projected_region_oos_erddweek")
        ladder = (ladder.when(F.col("is_fillin") & oos, F.lit(APPROVE))
                  .when(F.col("is_fillin") & ~oos, F.lit(REJECT_INSTOCK_FILLIN))
                  .when(oos & rank1, F.lit(APPROVE)))
    else:
        oos = F.col("projected_region_oos")
        ladder = ladder.when(oos & (F.col("region_need_left_after_order_cummulative") < 0) & rank1,
                             F.lit(APPROVE))
    return (ladder.when(frac < p.approve_fraction, F.lit(REJECT))
            .when(frac >= p.approve_fraction, F.lit(APPROVE)))


def high_moq(p: Params):
    """MOQ worth more than ``high_moq_days`` of (rounded) daily forecast."""
    return F.coalesce(safe_div(F.col("moq"), F.col("avg_daily_forecast")) > p.high_moq_days, F.lit(False))


def recommend(full: DataFrame, vendors: DataFrame, item_attrs: DataFrame, p: Params,
              variant: str = "fillin") -> DataFrame:
    """Label every proposal row; variant ``base`` keeps only in-scope
    rows (proposal present, not private label, not direct import, buyer listed)."""
    _check(variant)
    n = with_need_fraction(full)
    v = vendors.select(
        "vendor_number", F.col("purchaser_code").alias("supply_planner"), "vendor_name",
        F.col("distribution_method").alias("vendor_distribution_method"),
        F.col("direct_import_flag").alias("vendor_direct_import_flag"))
    attrs = item_attrs.select(F.col("product_part_number").alias("item"), "mc1",
                              F.col("product_abc_code").alias("_abc"),
                              F.col("is_new_item").alias("_new"), "private_label_flag")
    j = (n.join(v, spread_nulls(supplier_vendor(F.col("supplier")), F.concat_ws("/", "item", "location")) == v.vendor_number, "left")
         .join(attrs, "item"))
    left = F.col("region_need_left_after_order_cummulative")
    left_shown = F.when(left < 0, F.lit(0.0)).otherwise(F.round(left, 2))
    common_head = ["supply_planner", "mc1", decision(variant, p).alias("action_"), "item", "region", "location"]
    measures = [F.round("fc_need", 2).alias("fc_need"), "proposed_fc_qty",
                F.round("fc_region_need_percent", 2).alias("fc_region_need_percent"),
                "region_proposed_qty_cummulative"]
    if variant == "fillin":
        cols = common_head + [
            F.col("_abc").alias("product_abc_code"), F.col("_new").alias("is_new_item"),
            "avg_daily_forecast", "proposal_type", "is_fillin", "supplier", "vendor_name",
            "vendor_distribution_method", "release_date", "erdd", "moq",
            "projected_region_oos_erddweek"] + measures + [
            F.round("total_reg_outl", 3).alias("total_reg_ss"),
            F.round("total_reg_ip", 3).alias("total_reg_ip"),
            F.round("total_reg_need", 3).alias("total_reg_need"),
            "fc_need_rank_in_region",
            left_shown.alias("region_need_left_after_order_cummulative"),
            F.when(left > 0, F.lit(0.0)).otherwise(F.abs(F.round(left, 2)))
            .alias("region_excess_units_created_from_order_cummulative"),
            high_moq(p).alias("has_high_moq")]
        return j.select(*cols)
    cols = common_head + [
        "private_label_flag", F.col("_abc").alias("product_abc_code"), F.col("_new").alias("is_new_item"),
        "avg_daily_forecast", "supplier", "vendor_name", "vendor_distribution_method",
        "vendor_direct_import_flag", "release_date", "erdd", "moq", "projected_region_oos"] + measures + [
        F.round("total_reg_outl", 3).alias("total_reg_outl"),
        F.round("total_reg_ip", 3).alias("total_reg_ip"),
        F.round("total_reg_need", 3).alias("total_reg_need"),
        "fc_need_rank_in_region",
        left_shown.alias("region_need_left_after_order_cummulative"),
        high_moq(p).alias("has_high_moq")]
    return (j.where(F.col("supplier").isNotNull()
                    & ~F.coalesce("private_label_flag", F.lit(False))
                    & ~F.coalesce("vendor_direct_import_flag", F.lit(False))
                    & F.col("supply_planner").isin(list(p.buyers)))
            .select(*cols))


def presentation_order(rec: DataFrame, variant: str = "fillin") -> DataFrame:
    """Sort for the hand-off file (only at the sink)."""
    keys = ["item", "region", "fc_need_rank_in_region"]
    if variant == "base":
        keys = ["supply_planner"] + keys
    return rec.orderBy(*keys)


# -- D4-D7: network-level measures ------------------------------------------

def network_measures(full: DataFrame, net_need: DataFrame, net_proj: DataFrame) -> DataFrame:
    """D4-D7 on the (fill-in) full need table: network need left after each
    proposal in network-rank order, the network needed fraction, excess and
    ordered units in days of supply with their buckets, and network OOS at the
    receipt week."""
    np_ = net_proj.select(F.col("product_part_number").alias("item"), F.col("week").alias("_week"),
                          F.col("inv").alias("projected_on_hand_network"))
    j = (full.join(net_need, "item")
         .withColumn("_week", week_start("erdd"))
         .join(np_, ["item", "_week"], "left"))
    cum = F.col("network_proposed_qty_cummulative")
    left = F.col("total_network_need") - cum
    ip = F.col("total_network_ip") + cum
    excess_dos = F.when(left >= 0, F.lit(0.0)).otherwise(
        safe_div(-(F.col("total_network_need") - left), F.col("avg_daily_forecast")))
    ordered_dos = safe_div(cum, F.col("avg_daily_forecast"))
    return j.select(
        "item", "region", "location", "fc_need_rank_in_network", "proposed_fc_qty",
        "total_network_outl", "total_network_ip", "total_network_need",
        cum.alias("network_proposed_qty_cummulative"),
        left.alias("network_need_left_after_order_cummulative"),
        ip.alias("current_network_ip_with_proposed_qty_cummulative"),
        (ip - F.col("total_network_outl")).alias("current_network_excess_created_cummulative"),
        need_fraction(left, F.col("proposed_fc_qty")).alias("fc_network_need_percent_cummulative"),
        excess_dos.alias("network_excess_created_from_order_cummulative_dos"),
        ordered_dos.alias("proposed_ordered_units_cummulative_dos"),
        F.when(F.abs(excess_dos) <= 30, "0-30").otherwise("31+")
        .alias("network_excess_created_cummulative_dos_bucket"),
        F.when(F.abs(ordered_dos) <= 60, "0-60").otherwise("61+")
        .alias("proposed_ordered_units_cummulative_dos_bucket"),
        (F.coalesce("projected_on_hand_network", F.lit(0.0)) <= 0).alias("projected_network_oos_erddweek"),
    )
