"""Operator chains over a set of logical inputs.

``OperatorChain`` memoises each intermediate DataFrame (a lazy plan, not data), so
queries that share a stage share one logical sub-plan; Spark's exchange reuse
then avoids recomputing shared shuffles inside one query.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.operators import compliance as C
from restock.operators import decisions as D
from restock.operators import forecast as FC
from restock.operators import inventory as I
from restock.operators import kpi as K
from restock.operators import onorder as OO
from restock.operators import projection as PJ
from restock.operators import proposals as PR
from restock.operators import snapshots as S
from restock.params import Params


class ItemScope:
    """The logical inputs of the regional base restricted to an item set with
    semi joins, applied before any aggregation. Exact for every
    per-item result (the regional base, the projection and the item
    attributes depend only on the item's own rows)."""

    def __init__(self, src, items: DataFrame, products: DataFrame):
        self.src, self.p = src, getattr(src, "p", None)
        self._items = items                                   # product_part_number
        self._keys = products.join(self._items, "product_part_number", "left_semi").select("product_key")

    def __getattr__(self, name):
        return getattr(self.src, name)

    @cached_property
    def inventory_snapshot(self) -> DataFrame:
        return self.src.inventory_snapshot.join(self._items, "product_part_number", "left_semi")

    @cached_property
    def forecast_current(self) -> DataFrame:
        return self.src.forecast_current.join(self._keys, "product_key", "left_semi")

    @cached_property
    def onorder_detail(self) -> DataFrame:
        return self.src.onorder_detail.join(
            self._items.withColumnRenamed("product_part_number", "item"), "item", "left_semi")

    @cached_property
    def excess_base(self) -> DataFrame:
        return self.src.excess_base.join(self._items, "product_part_number", "left_semi")


class OperatorChain:
    """``src`` provides the logical inputs as attributes (see
    ``restock.sources.adapters.DriverTables`` for names and columns)."""

    def __init__(self, src, params: Params | None = None):
        self.src = src
        self.p = params or getattr(src, "p", None) or Params()
        if self.p.outl_date_rule == "latest_good" and self.p.outl_date is None:
            # one small aggregate over the day totals; a single date comes back
            good = S.latest_good_snapshot(src.excess_base, self.p.as_of)
            if good is None:
                raise ValueError(f"no good target snapshot on or before {self.p.as_of}")
            self.p = self.p.with_(outl_date=good)
        elif self.p.outl_date_rule not in ("as_of", "latest_good"):
            raise ValueError(f"unknown outl_date_rule {self.p.outl_date_rule!r}")
        self._memo: dict = {}

    def _cut(self, df: DataFrame) -> DataFrame:
        """Reliable checkpoint (written to spark.checkpoint.dir) when enabled:
        a lost executor then recomputes from the checkpoint, not the whole DAG."""
        if not self.p.checkpoint_stages:
            return df
        from restock.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)

    def _once(self, key, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    # -- shared inputs (one lazy definition each) -----------------------------
    @cached_property
    def region_map(self) -> DataFrame:
        return self.src.region_map

    @cached_property
    def products(self) -> DataFrame:
        return self.src.products

    @cached_property
    def locations(self) -> DataFrame:
        return self.src.locations

    @cached_property
    def vendors(self) -> DataFrame:
        return self.src.vendors

    @cached_property
    def excess_base(self) -> DataFrame:
        return self.src.excess_base

    @cached_property
    def rec_file(self) -> DataFrame:
        return self.src.recommendation_file

    # -- recommendation chain ----------------------------------------------------
    @cached_property
    def new_items(self):
        return I.new_items(self.src.item_attr, self.p)

    @cached_property
    def eligible_fcs(self):
        return I.eligible_fcs(self.locations, self.p)

    @cached_property
    def inventory_base(self):
        return I.inventory_base(self.src.inventory_snapshot, self.products, self.locations,
                                self.region_map, self.p)

    @cached_property
    def item_attributes(self):
        return I.item_attributes(self.inventory_base, self.products, self.new_items)

    @cached_property
    def region_on_hand(self):
        return I.region_on_hand(self.inventory_base)

    @cached_property
    def network_on_hand(self):
        return I.network_on_hand(self.region_on_hand)

    @cached_property
    def weekly_forecast(self):
        return FC.weekly_forecast(self.src.forecast_current, self.products, self.locations,
                                  self.region_map, self.p)

    @cached_property
    def forecast_windows(self):
        return FC.forecast_windows(self.weekly_forecast, self.p)

    @cached_property
    def network_weekly_forecast(self):
        return FC.network_weekly_forecast(self.weekly_forecast)

    @cached_property
    def weekly_on_order(self):
        return OO.weekly_on_order(self.src.onorder_detail, self.products, self.src.procurement_document,
                                  self.locations, self.region_map, self.p)

    @cached_property
    def region_on_order(self):
        return OO.region_on_order(self.weekly_on_order)

    @cached_property
    def network_weekly_on_order(self):
        return OO.network_weekly_on_order(self.weekly_on_order)

    @cached_property
    def network_on_order(self):
        return OO.network_on_order(self.region_on_order)

    @cached_property
    def regional_base(self):
        return PJ.regional_base(self.region_on_hand, self.network_on_hand, self.excess_base,
                                self.network_on_order, self.forecast_windows, self.weekly_on_order, self.p)

    def inventory_projection(self, mode: str | None = None):
        return PJ.inventory_projection(self.regional_base, mode or self.p.projection_mode)

    @cached_property
    def projected_state(self):
        return self._cut(PJ.projected_state(self.regional_base, self.item_attributes, self.p.projection_mode))

    @cached_property
    def network_projection(self):
        return PJ.network_projection(self.weekly_forecast, self.region_on_hand, self.network_on_hand, self.excess_base,
                                     self.network_weekly_forecast, self.network_weekly_on_order, self.p,
                                     self.p.projection_mode)

    def proposal_base(self, variant: str):
        return PR.proposal_base(self.src.item_location, self.region_map, self.products,
                                self.src.proposals, self.vendors, self.p, variant)

    def fc_need(self, variant: str):
        return self._once(("fc_need", variant), lambda: self._cut(
            PR.fc_need(self.proposal_base(variant), self.src.stock_tunnel, variant)))

    def need_rank(self, variant: str):
        return PR.need_rank(self.fc_need(variant), variant)

    def region_need(self, variant: str):
        return PR.region_need(self.fc_need(variant), variant)

    @cached_property
    def _proposal_scope(self) -> "OperatorChain":
        """The chain over inputs restricted to the run date's proposed items."""
        items = self.proposal_items.select(F.col("item").alias("product_part_number"))
        return OperatorChain(ItemScope(self.src, items, self.products), self.p)

    def projected_state_for(self) -> DataFrame:
        """R14 for the items of today's proposals only (what R19 looks up)."""
        scope = self._proposal_scope
        return self._cut(PJ.projected_state(scope.regional_base, scope.item_attributes, self.p.projection_mode))

    @cached_property
    def proposal_items(self) -> DataFrame:
        """Items with a proposal on the run date: a superset of the items of any
        stock-tunnel row (each needs a proposal due date in its region), read
        with one pruned scan of the day's proposals."""
        return self.src.proposals.where(F.col("prundate") == F.lit(self.p.as_of)).select("item")

    def full_need(self, variant: str):
        def build():
            return D.full_need(self.fc_need(variant), self.excess_base,
                               self.projected_state_for(), self.p, variant)
        return self._once(("full_need", variant), build)

    def recommend(self, variant: str):
        return D.recommend(self.full_need(variant), self.vendors, self._proposal_scope.item_attributes, self.p, variant)

    def network_measures(self):
        full = self.full_need("fillin")
        net_proj = self._proposal_scope.network_projection
        return D.network_measures(full, PR.network_need(self.region_need("fillin")), net_proj)

    # -- compliance -----------------------------------------------------------------
    @cached_property
    def placed_orders(self):
        return C.placed_orders(self.src.procurement_product, self.products, self.vendors,
                               self.locations, self.p)

    @cached_property
    def placed_orders_rollup(self):
        return C.placed_orders_rollup(self.placed_orders)

    @cached_property
    def network_demand(self):
        return C.network_demand(self.placed_orders_rollup, self.src.item_location, self.locations, self.p)

    @cached_property
    def compliance(self):
        return C.compliance(self.placed_orders_rollup, self.products, self.vendors, self.network_demand,
                            self.src.item_uom, self.excess_base, self.rec_file, self.p)

    @cached_property
    def trailing_performance(self):
        items = C.compliance_items(self.placed_orders_rollup, self.products, self.vendors)
        return C.trailing_performance(self.src.merch_performance, items, self.p)

    @cached_property
    def compliance_report(self):
        return C.compliance_report(self.compliance, self.trailing_performance)

    # -- KPI ---------------------------------------------------------------------------
    @cached_property
    def instock_base(self):
        return K.instock_base(self.src.inventory_snapshot, self.region_map, self.src.product_lifecycle,
                              self.rec_file, self.p)

    @cached_property
    def split_orders(self):
        return K.split_orders(self.src.order_line, self.src.orders, self.locations, self.products, self.p)

    @cached_property
    def split_order_items(self):
        return K.split_order_items(self.split_orders, self.src.order_line, self.products)

    @cached_property
    def order_zone(self):
        return K.order_zone(self.src.order_line, self.src.orders, self.src.shipment_order_line,
                            self.locations, self.products, self.rec_file, self.p)

    @cached_property
    def region_oos(self):
        return K.region_oos_from_snapshot(self.src.inventory_snapshot, self.region_map,
                                          self.src.product_lifecycle, self.rec_file, self.p)

    @cached_property
    def network_oos(self):
        return K.network_oos_from_snapshot(self.src.inventory_snapshot, self.region_map,
                                           self.src.product_lifecycle, self.rec_file, self.p)

    # -- snapshot table ----------------------------------------------------------------
    @cached_property
    def outl_bad_dates(self):
        return S.outl_bad_dates(self.excess_base)
