"""Regional base, inventory projection, projected state.

Inventory projection (per item x region, weeks in order), with
x_w = on_order_w - forecast_w and S_w = on_hand + sum_{v<=w} x_v:

* ``net``:   inv_w = S_w (a negative value is a backlog);
* ``floor``: inv_w = max(0, inv_{w-1} + x_w), inv_0 = on_hand (lost sales).
  This recursion has the closed form inv_w = S_w - min(0, min_{v<=w} S_v),
  i.e. two running window aggregates over the same ordering - no UDF and no
  per-group Python; Spark plans both windows behind one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.params import Params

ITEM_REGION = ["product_part_number", "region"]


def regional_base(reg_on_hand: DataFrame, net_on_hand: DataFrame, excess_base: DataFrame,
                  net_on_order: DataFrame, fwin: DataFrame, weekly_oo: DataFrame,
                  p: Params) -> DataFrame:
    """Item x region x week facts; items absent from the excess-base
    snapshot of ``p.outl_day`` drop out (inner join)."""
    o = (excess_base.where(F.col("snapshot_date") == F.lit(p.outl_day))
         .select("product_part_number", "avg_daily_forecast"))
    adf = F.nullif(F.col("avg_daily_forecast"), F.lit(0.0))
    return (reg_on_hand.join(net_on_hand, "product_part_number")
            .join(o, "product_part_number")
            .join(net_on_order, "product_part_number", "left")
            .join(fwin.drop("daily_forecast_mean"), ITEM_REGION, "left")
            .join(weekly_oo.withColumnRenamed("oo_region", "oo_region_for_week"),
                  ITEM_REGION + ["week"], "left")
            .select("product_part_number", "region", "current_on_hand_region",
                    "current_on_hand_network",
                    F.round(F.try_divide(F.col("current_on_hand_network"), adf), 2)
                    .alias("current_on_hand_dos"),
                    F.col("oo_network").alias("current_on_order_network"),
                    F.round(F.try_divide(F.col("oo_network"), adf), 2).alias("current_on_order_dos"),
                    "avg_daily_forecast", "week", "forecast_region", "cumulative_forecast_region",
                    "avg_daily_forecast_week", "week_rank_region", "oo_region_for_week"))


def project(df: DataFrame, keys: list[str], on_hand: str, forecast: str, on_order: str,
            mode: str = "floor") -> DataFrame:
    """Add columns ``oo``, ``forecast`` and ``inv`` (projected end-of-week stock)
    to rows keyed by ``keys`` + week. Rows without a week are dropped."""
    if mode not in ("floor", "net"):
        raise ValueError(f"unknown projection mode {mode!r}")
    w = (Window.partitionBy(*keys).orderBy("week")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = F.coalesce(F.col(on_order), F.lit(0)).cast("double") - F.coalesce(F.col(forecast), F.lit(0.0))
    out = (df.where(F.col("week").isNotNull())
           .withColumn("oo", F.coalesce(F.col(on_order), F.lit(0)).cast("int"))
           .withColumn("forecast", F.col(forecast).cast("double"))
           .withColumn("_s", F.coalesce(F.col(on_hand), F.lit(0)).cast("int").cast("double")
                       + F.sum(x).over(w)))
    if mode == "net":
        return out.withColumn("inv", F.col("_s")).drop("_s")
    return (out.withColumn("inv", F.col("_s") - F.least(F.lit(0.0), F.min("_s").over(w)))
            .drop("_s"))


def inventory_projection(reg_base: DataFrame, mode: str = "floor") -> DataFrame:
    """Projected on-order, stock and forecast per item, region, week."""
    return project(reg_base, ITEM_REGION, "current_on_hand_region", "forecast_region",
                   "oo_region_for_week", mode).select(
        "region", "product_part_number", "week", "oo", "inv", "forecast")


def projected_state(reg_base: DataFrame, item_attrs: DataFrame, mode: str = "floor") -> DataFrame:
    """The projection next to its regional base row and item attributes.

    The original joins the projection back to the base on (item, region, week);
    both come from the same rows, so here the projection is computed as window
    columns on the base itself and only the item attributes are joined."""
    proj = project(reg_base, ITEM_REGION, "current_on_hand_region", "forecast_region",
                   "oo_region_for_week", mode)
    return (proj.join(item_attrs.select("product_part_number", "product_abc_code", "is_new_item"),
                      "product_part_number")
            .select("region", "product_part_number", "product_abc_code", "is_new_item",
                    "current_on_hand_network", "current_on_order_network", "week",
                    F.col("oo").alias("projected_on_order_region"),
                    F.col("inv").alias("projected_on_hand_region"),
                    F.col("forecast").alias("region_forecast"),
                    F.coalesce("avg_daily_forecast", F.lit(0.0)).alias("avg_daily_forecast"),
                    "forecast_region",
                    F.coalesce("avg_daily_forecast_week", F.lit(0.0)).alias("avg_daily_forecast_week")))


def network_projection(weekly_fc: DataFrame, reg_on_hand: DataFrame, net_on_hand: DataFrame, excess_base: DataFrame,
                       net_weekly_fc: DataFrame, net_weekly_oo: DataFrame, p: Params, mode: str = "floor") -> DataFrame:
    """Projection at network level over the item-weeks of the regional base:
    weeks with a forecast in a region that has a stock row, of items in the
    target snapshot."""
    o = excess_base.where(F.col("snapshot_date") == F.lit(p.outl_day)).select("product_part_number")
    rows = (weekly_fc.join(reg_on_hand.select(*ITEM_REGION), ITEM_REGION, "left_semi")
            .select("product_part_number", "week").distinct()
            .join(net_on_hand, "product_part_number").join(o, "product_part_number", "left_semi")
            .join(net_weekly_fc, ["product_part_number", "week"], "left")
            .join(net_weekly_oo, ["product_part_number", "week"], "left"))
    return project(rows, ["product_part_number"], "current_on_hand_network", "forecast_network",
                   "oo_network", mode).select(
        "product_part_number", "week", "oo", "inv", "forecast")
