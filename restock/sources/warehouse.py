"""Warehouse table scans by logical name.

``WarehouseTables`` exposes the same attribute names as the test adapters
(``inventory_snapshot``, ``forecast_current``, ``proposals`` ...), each read
from a parquet path. Date-partitioned tables (``snapshot_dt``,
``snapshot_date``, ``forecast_dt``) get partition pruning from the operators'
date filters; columns a query does not use are pruned from the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from restock.params import Params

LOGICAL_TABLES = (
    "region_map", "locations", "products", "item_attr", "vendors", "inventory_snapshot",
    "product_lifecycle", "forecast_current", "onorder_detail", "procurement_document",
    "item_location", "proposals", "stock_tunnel", "excess_base", "procurement_product", "item_uom",
    "merch_performance", "recommendation_file", "historical_file", "orders", "order_line",
    "shipment_order_line",
)


class WarehouseTables:
    def __init__(self, spark: SparkSession, paths: Mapping[str, str], params: Params | None = None,
                 fmt: str = "parquet"):
        unknown = set(paths) - set(LOGICAL_TABLES)
        if unknown:
            raise ValueError(f"unknown logical tables: {sorted(unknown)}")
        self.spark, self.paths, self.fmt = spark, dict(paths), fmt
        self.p = params or Params()

    def load(self, name: str) -> DataFrame:
        if name not in self.paths:
            raise KeyError(f"no path configured for logical table {name!r}")
        return self.spark.read.format(self.fmt).load(self.paths[name])

    def __getattr__(self, name: str) -> DataFrame:
        if name in LOGICAL_TABLES:
            return self.load(name)
        raise AttributeError(name)
