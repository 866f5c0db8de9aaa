"""Run parameters. Everything the original scripts hard-coded (run date,
forecast horizon, company, buyer allowlist, status codes, thresholds) is a
field here, so the same operators serve any day and any tenant."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # run date: replaces every "current_date" of the original scripts
    as_of: dt.date = dt.date(2000, 1, 5)
    # last forecast day read (inclusive)
    horizon_end: dt.date = dt.date(2000, 6, 30)
    # date of the excess-base snapshot used by the recommendation run; None = as_of
    # (see snapshots.latest_good_snapshot for the last good day on or before as_of)
    outl_date: dt.date | None = None
    # "as_of": use outl_date (default as_of); "latest_good": use the last day on
    # or before as_of whose load is good (a run before the upstream batch ends)
    outl_date_rule: str = "as_of"
    # eligible fulfilment centres
    company: str = "ACME"
    # buyers whose proposals are in scope (base variant, compliance)
    buyers: tuple[str, ...] = ("B0", "B1", "B2", "B3", "B5", "B7", "B8", "B10")
    # item attribute that marks a new item, and the excluded id prefix
    new_item_attr: str = "NEW_ITEM"
    new_item_excluded_prefix: str = "RX"
    # lot id markers of open orders that count as on-order
    onorder_lot_markers: tuple[str, ...] = ("RS", "TR")
    # decision thresholds
    approve_fraction: float = 0.5
    high_moq_days: float = 60.0
    # projection mode of the inventory projection: "floor" (lost sales) or "net"
    projection_mode: str = "floor"
    # compliance
    compliance_lag_days: int = 2
    document_type: str = "Purchase"
    data_source: str = "ERP"
    uom_warehouse: str = "F001"
    performance_days: int = 91
    performance_end_lag_days: int = 2
    # KPI
    kpi_start: dt.date = dt.date(1999, 10, 7)
    zone_start: dt.date = dt.date(1999, 10, 7)
    split_window_days: int = 90
    excluded_order_status: tuple[str, ...] = ("F", "X")
    # snapshot-table repair: None = detect bad days (safety stock summed to zero)
    repair_dates: tuple[dt.date, ...] | None = None
    # cut lineage after the long sub-plans (regional projection, stock match)
    # with a reliable checkpoint into spark.checkpoint.dir (shared storage)
    checkpoint_stages: bool = False

    @property
    def outl_day(self) -> dt.date:
        return self.outl_date or self.as_of

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
