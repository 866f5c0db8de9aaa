"""Proposal base, stock-tunnel match, need ranks, regional need.

Two variants share this code:
  * ``base``   - today's proposals matched on item, FC and the FC's usual
                 supplier; fill-in (status X) proposals are ignored;
  * ``fillin`` - proposals from the daily snapshot table, all statuses; fill-in
                 proposals are ranked after primary ones and left out of the
                 regional totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.functions.columns import clamp0, is_false_or_null, prefix, supplier_vendor
from restock.functions.joins import dimension, spread_nulls
from restock.params import Params

VARIANTS = ("base", "fillin")


def _check(variant: str) -> None:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")


def proposal_base(item_location: DataFrame, region_map: DataFrame, products: DataFrame,
                  proposals: DataFrame, vendors: DataFrame, p: Params,
                  variant: str = "fillin") -> DataFrame:
    """Every item x FC setting in a mapped region with today's proposal (if
    any), its vendor, and the earliest due date of the item in the region.
    Self transfers (supplier equal to an FC code) and discontinued items drop."""
    _check(variant)
    rm = dimension(region_map)
    cil = (item_location.join(rm, item_location.location == rm.location_code)
           .join(products.select(F.col("product_part_number").alias("item"), "discontinued_flag"), "item")
           .where(is_false_or_null(F.col("discontinued_flag"))))
    prop = proposals.where(F.col("prundate") == F.lit(p.as_of))
    if variant == "base":
        prop = prop.where(F.col("status") != "X")
    else:
        prop = prop.where(F.col("create_date") == F.lit(p.as_of))
    prop = prop.select(F.col("item").alias("p_item"), prefix(F.col("destwhs"), 4).alias("p_loc"),
                       F.col("supplier").alias("p_supplier"), "qty", "prundate", "duedate", "status")
    cond = (cil.item == prop.p_item) & (cil.location == prop.p_loc)
    if variant == "base":
        cond = cond & (cil.supplier == prop.p_supplier)
    j = cil.join(prop, cond, "left")
    # self transfers: supplier equal to an FC code (null supplier = no proposal, kept)
    j = j.join(rm.select(F.col("location_code").alias("p_supplier")), "p_supplier", "left_anti")
    v = vendors.select("vendor_number", "vendor_name")
    j = j.join(v, spread_nulls(supplier_vendor(F.col("p_supplier")), F.concat_ws("/", "item", "location")) == v.vendor_number, "left")
    w = Window.partitionBy("item", "region")
    if variant == "base":
        min_due = F.min("duedate").over(w)
        extra: list[Column] = []
    else:
        min_due = F.min(F.when(F.col("status") != "X", F.col("duedate"))).over(w)
        ptype = (F.when(F.col("status").isNull(), F.lit("3"))
                 .when(F.col("status") == "X", F.lit("2")).otherwise(F.lit("1")))
        extra = [ptype.alias("proposal_type"),
                 F.coalesce(F.col("status") == "X", F.lit(False)).alias("is_fillin_prop")]
    return j.select(
        "item", "location", F.col("qty").alias("proposed_qty"), F.col("p_supplier").alias("supplier"),
        "vendor_name", F.col("minresint").alias("review_period"), F.col("minreslot").alias("moq"),
        "prundate", "duedate", min_due.alias("min_erdd_region"), "region", "status", *extra)


def fc_need(props: DataFrame, stock_tunnel: DataFrame, variant: str = "fillin") -> DataFrame:
    """Match each proposal row with the planning targets of its FC on the
    regional earliest due date (base variant: the row's own due date, else the
    regional one). OUTL = max(0, stkmin), IP = max(0, stkono), NEED = OUTL - IP."""
    _check(variant)
    st = stock_tunnel.select(F.col("item").alias("s_item"), prefix(F.col("whouse"), 4).alias("tunn_fc"),
                             F.col("date").alias("s_date"), "stkmin", "stkono")
    match_date = (F.coalesce(F.col("duedate"), F.col("min_erdd_region")) if variant == "base"
                  else F.col("min_erdd_region"))
    j = props.join(st, (props.item == st.s_item) & (match_date == st.s_date)
                   & (st.tunn_fc == props.location))
    outl, ip = clamp0(F.col("stkmin")), clamp0(F.col("stkono"))
    cols = ["item", "location", "proposed_qty"]
    if variant == "fillin":
        cols += ["proposal_type", (F.col("proposal_type") == "2").alias("is_fillin")]
    cols += ["supplier", "vendor_name", "review_period", "moq", "prundate",
             F.coalesce("duedate", "min_erdd_region").alias("duedate"), "min_erdd_region", "region",
             "status", outl.alias("fc_outl"), ip.alias("fc_ip"),
             (outl - ip).alias("fc_need"), "tunn_fc"]
    return j.select(*cols)


def unmatched_proposal_rows(props: DataFrame) -> DataFrame:
    """Q15 metric: proposal-base rows whose region has no earliest due date
    (only fill-in or status-less proposals there), which the stock-tunnel match
    drops; counted per region and proposal type."""
    return (props.where(F.col("min_erdd_region").isNull())
            .groupBy("region", "proposal_type").agg(F.count(F.lit(1)).alias("dropped_rows"),
                                                   F.count("supplier").alias("dropped_proposals")))


def rank_windows(variant: str) -> tuple[Window, Window]:
    """(regional, network) orderings of the need rank. An FC may have several
    proposals of one item (primary and fill-in, several suppliers or lots), so
    ties go by FC, supplier, due date, quantity and status, nulls last; rows that
    are equal in all of these are interchangeable."""
    ties = [F.col(c).asc_nulls_last() for c in ("location", "supplier", "duedate", "proposed_qty", "status")]
    need = [F.col("fc_need").desc_nulls_last(), *ties]
    reg_order = ([F.col("proposal_type").asc_nulls_last()] if variant == "fillin" else []) + need
    net_order = need
    return (Window.partitionBy("item", "region").orderBy(*reg_order),
            Window.partitionBy("item").orderBy(*net_order))


def need_rank(tunnel: DataFrame, variant: str = "fillin") -> DataFrame:
    """row_number of the FC need within (item, region) and within item."""
    _check(variant)
    wr, wn = rank_windows(variant)
    return tunnel.select("*", F.row_number().over(wr).alias("fc_need_rank_in_region"),
                         F.row_number().over(wn).alias("fc_need_rank_in_network"))


def region_need(tunnel: DataFrame, variant: str = "fillin") -> DataFrame:
    """Regional OUTL, IP and NEED totals (fill-in rows not counted)."""
    _check(variant)
    t = tunnel.where(~F.col("is_fillin")) if variant == "fillin" else tunnel
    return t.groupBy("item", "region").agg(
        F.sum(clamp0(F.col("fc_outl"))).alias("total_reg_outl"),
        F.sum(clamp0(F.col("fc_ip"))).alias("total_reg_ip"),
    ).withColumn("total_reg_need", F.col("total_reg_outl") - F.col("total_reg_ip"))


def network_need(reg_need: DataFrame) -> DataFrame:
    """D3: network totals = sum of the clamped regional totals."""
    return reg_need.groupBy("item").agg(
        F.sum(clamp0(F.col("total_reg_outl"))).alias("total_network_outl"),
        F.sum(clamp0(F.col("total_reg_ip"))).alias("total_network_ip"),
    ).withColumn("total_network_need",
                 F.col("total_network_outl") - F.col("total_network_ip"))
