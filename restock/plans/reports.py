"""Reports as lazy DataFrames, and their sorted files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from restock.operators import compliance as C
from restock.operators import kpi as K
from restock.operators import snapshots as S
from restock.params import Params
from restock.plans.chain import OperatorChain


# the order of each report's rows, applied where it is written
ROW_ORDER = {
    "units_by_action": ["action"],
    "compliance": ["purchaser_code", "product_part_number", "location_code"],
    "compliance_report": ["purchaser_code", "product_part_number", "location_code"],
    "region_oos_rate": ["region", "snapshot_date"],
    "network_oos_rate": ["hg_ordered_item", "snapshot_date"],
    "split_rate": ["order_released_date", "contains_nbhg_item"],
    "avg_zone": ["order_released_date", "contains_nbhg_item"],
    "outl_monitor": ["snapshot_date"],
}


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    """Each report as a folder of CSV files whose names are in row order (a
    range-partitioned sort, so no task holds a whole report)."""
    for name, df in reports.items():
        keys = [k for k in ROW_ORDER.get(name, []) if k in df.columns]
        (df.orderBy(*keys) if keys else df).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def compliance_reports(src, params: Params) -> dict[str, DataFrame]:
    """Buyer compliance: units by recommended action, compliance fact, report."""
    pl = OperatorChain(src, params)
    return {"units_by_action": C.units_by_action(pl.rec_file, pl.products, pl.vendors),
            "compliance": pl.compliance,
            "compliance_report": pl.compliance_report}


def kpi_reports(src, params: Params) -> dict[str, DataFrame]:
    """In-stock (region and network), order-split and shipping-zone KPIs."""
    pl = OperatorChain(src, params)
    return {"region_oos_rate": K.region_oos_rate(pl.region_oos),
            "network_oos_rate": K.network_oos_rate(pl.network_oos),
            "split_rate": K.split_rate(pl.split_order_items, pl.rec_file),
            "avg_zone": K.avg_zone(pl.order_zone)}


def snapshot_checks(src, params: Params) -> dict[str, DataFrame]:
    """Target-snapshot table: daily totals, bad days, repaired table."""
    pl = OperatorChain(src, params)
    return {"outl_monitor": S.outl_monitor(pl.excess_base),
            "outl_bad_dates": pl.outl_bad_dates,
            "outl_repair": S.outl_repair(pl.excess_base)}
