"""Query registry: one entry per operator of the blueprint, each a function
``(spark, sf_dir) -> DataFrame`` over the adapter views of the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.operators import kpi as K
from restock.operators import onorder as OO
from restock.operators import proposals as PR
from restock.operators import snapshots as S
from restock.operators import compliance as C
from restock.operators import decisions as D
from restock.params import Params
from restock.plans.chain import OperatorChain
from restock.sources.adapters import DriverTables
from restock.sources.warehouse import WarehouseTables

QueryFn = Callable[[SparkSession, str], DataFrame]


_INPUTS: dict[tuple, DriverTables] = {}


def inputs(spark: SparkSession, sf_dir: str, params: Params | None = None) -> DriverTables:
    """The logical input views of one tables folder, defined once per session
    (lazy plans: the file listing and view definitions are shared by every
    query of the session; no data is cached)."""
    p = params or Params()
    key = (spark.conf.get("spark.app.id", ""), id(spark), sf_dir.rstrip("/"), p)
    if key not in _INPUTS:
        _INPUTS[key] = DriverTables(spark, sf_dir, p)
    return _INPUTS[key]


def _pl(spark: SparkSession, sf_dir: str, params: Params | None = None) -> OperatorChain:
    p = params or Params()
    return OperatorChain(inputs(spark, sf_dir, p), p)


def _q(f: Callable[[OperatorChain], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(_pl(spark, sf_dir))
    run.__doc__ = f.__doc__
    return run


def _listed_days(pl: OperatorChain) -> DataFrame:
    """Three and one days before the run, from the table's own days."""
    days = [pl.p.as_of - dt.timedelta(days=n) for n in (3, 1)]
    return pl.excess_base.where(F.col("snapshot_date").isin(days)).select("snapshot_date").distinct()


NEED_RANK_COLS = ["item", "region", "location", "fc_need", "fc_need_rank_in_region",
                  "fc_need_rank_in_network"]

REGISTRY: dict[str, QueryFn] = {
    # sources / sinks / table upkeep
    "new_items": _q(lambda pl: pl.new_items),
    "region_map": _q(lambda pl: pl.region_map),
    "history_import": _q(lambda pl: S.history_import(pl.src.historical_file, pl.products, pl.vendors)),
    "outl_delete": _q(lambda pl: S.drop_snapshots(pl.excess_base, pl.outl_bad_dates)),
    "outl_repair": _q(lambda pl: S.outl_repair(pl.excess_base)),
    # a listed day, a zero day that is not listed, and a listed first day
    "outl_repair_listed": _q(lambda pl: S.outl_repair(pl.excess_base, _listed_days(pl))),
    "outl_unrepaired": _q(lambda pl: S.unrepaired_days(S.repair_plan(pl.excess_base, _listed_days(pl)))),
    "on_order_undated": _q(lambda pl: OO.undated_on_order(pl.src.onorder_detail, pl.p)),
    "warehouse_scan": lambda spark, d: WarehouseTables(spark, {"orders": f"{d}/orders.parquet"}).orders,
    "spot_check": _q(lambda pl: pl.instock_base.where(F.col("snapshot_date") == F.lit(pl.p.kpi_start))),
    "outl_monitor": _q(lambda pl: S.outl_monitor(pl.excess_base)),
    "outl_bad_dates": _q(lambda pl: pl.outl_bad_dates),
    # recommendation chain
    "eligible_fcs": _q(lambda pl: pl.eligible_fcs),
    "inventory_base": _q(lambda pl: pl.inventory_base),
    "item_attributes": _q(lambda pl: pl.item_attributes),
    "region_on_hand": _q(lambda pl: pl.region_on_hand),
    "network_on_hand": _q(lambda pl: pl.network_on_hand),
    "weekly_forecast": _q(lambda pl: pl.weekly_forecast),
    "forecast_windows": _q(lambda pl: pl.forecast_windows),
    "weekly_on_order": _q(lambda pl: pl.weekly_on_order),
    "region_on_order": _q(lambda pl: pl.region_on_order),
    "network_weekly_on_order": _q(lambda pl: pl.network_weekly_on_order),
    "network_on_order": _q(lambda pl: pl.network_on_order),
    "regional_base": _q(lambda pl: pl.regional_base),
    "inventory_projection": _q(lambda pl: pl.inventory_projection("net")),
    "inventory_projection_floor": _q(lambda pl: pl.inventory_projection("floor")),
    "projected_state": _q(lambda pl: pl.projected_state),
    "proposal_base": _q(lambda pl: pl.proposal_base("base")),
    "proposal_base_fillin": _q(lambda pl: pl.proposal_base("fillin")),
    "fc_need": _q(lambda pl: pl.fc_need("base")),
    "fc_need_fillin": _q(lambda pl: pl.fc_need("fillin")),
    "unmatched_proposal_rows": _q(lambda pl: PR.unmatched_proposal_rows(pl.proposal_base("fillin"))),
    "need_rank": _q(lambda pl: pl.need_rank("base").select(*NEED_RANK_COLS)),
    "need_rank_fillin": _q(lambda pl: pl.need_rank("fillin").select(*NEED_RANK_COLS, "proposal_type")),
    "region_need": _q(lambda pl: pl.region_need("base")),
    "region_need_fillin": _q(lambda pl: pl.region_need("fillin")),
    "full_need": _q(lambda pl: pl.full_need("base")),
    "full_need_fillin": _q(lambda pl: pl.full_need("fillin")),
    "network_position": _q(lambda pl: pl.full_need("fillin").select(
        "item", "region", "location", "fc_need_rank_in_network", "current_outl_network_calcd",
        "current_ip_network_calcd", "current_need_network",
        "current_network_ip_with_proposed_qty_cummulative_calcd",
        "current_network_excess_created_cummulative_calcd")),
    "region_need_left": _q(lambda pl: pl.full_need("fillin").select(
        "item", "region", "location", "fc_need_rank_in_region", "proposed_fc_qty",
        "region_proposed_qty_cummulative", "region_need_left_after_order_cummulative")),
    "need_fraction": _q(lambda pl: D.with_need_fraction(pl.full_need("fillin")).select(
        "item", "region", "location", "fc_need_rank_in_region", "proposed_fc_qty",
        "region_need_left_after_order_cummulative",
        F.round("fc_region_need_percent", 6).alias("fc_region_need_percent"))),
    "recommend": _q(lambda pl: pl.recommend("base")),
    "recommend_fillin": _q(lambda pl: pl.recommend("fillin")),
    "high_moq": _q(lambda pl: pl.recommend("fillin").select(
        "item", "region", "location", "moq", "avg_daily_forecast", "has_high_moq")),
    # dormant network-level operators
    "network_weekly_forecast": _q(lambda pl: pl.network_weekly_forecast),
    "network_projection": _q(lambda pl: pl.network_projection),
    "network_need": _q(lambda pl: PR.network_need(pl.region_need("fillin"))),
    "network_need_left": _q(lambda pl: pl.network_measures().select(
        "item", "region", "location", "fc_need_rank_in_network", "network_proposed_qty_cummulative",
        "network_need_left_after_order_cummulative",
        "current_network_ip_with_proposed_qty_cummulative",
        "current_network_excess_created_cummulative")),
    "network_need_fraction": _q(lambda pl: pl.network_measures().select(
        "item", "region", "location",
        F.round("fc_network_need_percent_cummulative", 6).alias("fc_network_need_percent_cummulative"),
        F.round("network_excess_created_from_order_cummulative_dos", 4)
        .alias("network_excess_created_from_order_cummulative_dos"),
        F.round("proposed_ordered_units_cummulative_dos", 4)
        .alias("proposed_ordered_units_cummulative_dos"))),
    "dos_bucket": _q(lambda pl: pl.network_measures().select(
        "item", "region", "location", "network_excess_created_cummulative_dos_bucket",
        "proposed_ordered_units_cummulative_dos_bucket")),
    "network_oos_flag": _q(lambda pl: pl.network_measures().select(
        "item", "region", "location", "projected_network_oos_erddweek")),
    # compliance
    "units_by_action": _q(lambda pl: C.units_by_action(pl.rec_file, pl.products, pl.vendors)),
    "placed_orders": _q(lambda pl: pl.placed_orders),
    "placed_orders_rollup": _q(lambda pl: pl.placed_orders_rollup.select(
        "*", F.round("units_per_cost", 6).alias("_u"), F.round("cost_per_unit", 6).alias("_c"))
        .drop("units_per_cost", "cost_per_unit")
        .withColumnsRenamed({"_u": "units_per_cost", "_c": "cost_per_unit"})),
    "network_demand": _q(lambda pl: pl.network_demand),
    "compliance": _q(lambda pl: pl.compliance),
    "compliance_detail": _q(lambda pl: C.compliance(
        pl.placed_orders_rollup, pl.products, pl.vendors, pl.network_demand, pl.src.item_uom,
        pl.excess_base, pl.rec_file, pl.p, detail=True)),
    "trailing_performance": _q(lambda pl: pl.trailing_performance),
    "compliance_report": _q(lambda pl: pl.compliance_report),
    # KPI
    "instock_base": _q(lambda pl: pl.instock_base),
    "region_oos": _q(lambda pl: pl.region_oos),
    "region_oos_rate": _q(lambda pl: K.region_oos_rate(pl.region_oos)),
    "network_oos": _q(lambda pl: pl.network_oos),
    "network_oos_rate": _q(lambda pl: K.network_oos_rate(pl.network_oos)),
    "split_orders": _q(lambda pl: pl.split_orders),
    "split_order_items": _q(lambda pl: pl.split_order_items),
    "tracked_items": _q(lambda pl: K.tracked_items(pl.rec_file)),
    "split_rate": _q(lambda pl: K.split_rate(pl.split_order_items, pl.rec_file)),
    "order_zone": _q(lambda pl: pl.order_zone.select(
        "order_key", "contains_nbhg_item", "order_released_date",
        F.round("actual_zone", 6).alias("actual_zone"))),
    "avg_zone": _q(lambda pl: K.avg_zone(pl.order_zone)),
}


def queries() -> dict[str, QueryFn]:
    return dict(REGISTRY)


FLAGSHIP = "recommend_fillin"


# -- file hand-offs: table-derived files written as CSV and read back typed ------

def _csv_roundtrip(spark: SparkSession, df: DataFrame, name: str) -> str:
    from restock.session import staging_path
    path = staging_path(spark, name)
    df.write.mode("overwrite").csv(path)
    return path


def _new_items_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> S2: the new-item extract saved as CSV and loaded as varchar(7)."""
    from restock.sources.csv import read_new_items
    pl = _pl(spark, sf_dir)
    ok, _ = read_new_items(spark, _csv_roundtrip(spark, pl.new_items, "new-items"))
    return ok


def _recommendations_csv(spark: SparkSession, sf_dir: str, rejects: bool = False) -> DataFrame:
    """S3 + S12: the recommendation file as CSV, typed read, reject split."""
    from restock.sources.csv import read_recommendations
    pl = _pl(spark, sf_dir)
    ok, bad = read_recommendations(spark, _csv_roundtrip(spark, pl.rec_file, "recommendations"))
    return bad.select("item_id", "location_cd", "supplier", "reject_reason") if rejects else ok


def _history_csv_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 staging + filter: the historical file as CSV, typed read, import filter."""
    from restock.sources.csv import read_history
    pl = _pl(spark, sf_dir)
    ok, _ = read_history(spark, _csv_roundtrip(spark, pl.src.historical_file, "history"))
    return S.history_import(ok, pl.products, pl.vendors)


REGISTRY.update({
    "new_items_csv": _new_items_csv,
    "recommendations_csv": _recommendations_csv,
    "recommendations_csv_rejects": lambda spark, d: _recommendations_csv(spark, d, rejects=True),
    "history_csv_import": _history_csv_import,
    "recommendation_table": _q(lambda pl: S.to_recommendation_table(pl.recommend("base"), pl.p.as_of)),
})
