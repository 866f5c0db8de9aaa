"""Logical inputs derived from the driver's TPC-H-ish test tables.

The replenishment operators read warehouse tables (inventory snapshots,
forecasts, proposals, stock tunnel, purchase documents, ...). The test data
only has lineitem / orders / part / supplier / nation / region / customer, so
each logical input is a deterministic view over those tables. The same views
are written in DuckDB SQL in ``restock.plans.oracle`` so both engines see
identical inputs. Every view is a lazy DataFrame: its work grows with the
tables and Catalyst prunes the columns a query does not read.

Derivation rules (fixed values of the test layout):
  fc code            'F' || lpad(nation key, 3, '0'); nation 24 has no region
  locations          inactive when key % 12 = 11, inactive warehouse key 20,
                     other company key 21, warehouse type 1 key 22
  products           abc by p_size % 4; discontinued null/true/false by
                     p_size % 10 = 0 / 9 / other; private label Brand#13, null
                     when p_size % 7 = 0
  item attributes    one row per part: NEW_ITEM when key % 20 = 0 (id
                     prefixed 'RX' when key % 40 = 0), else CORE
  excess base        parts with key % 50 = 7 have no target row, so the inner
                     join of the regional base (R12) has items to drop
  vendors            buyer 'B' || key % 12; direct import key % 10 = 3 (null 7)
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.functions.columns import fc_code
from restock.params import Params

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _d(x: dt.date) -> Column:
    return F.lit(x)


class DriverTables:
    """Adapter views over ``<sf_dir>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.p = params or Params()
        self._raw: dict[str, DataFrame] = {}

    # -- raw scans ---------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        """One DataFrame per table (the file listing and schema are resolved
        once); every view below is a lazy plan, memoised per instance."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    # -- shared line view --------------------------------------------------
    @cached_property
    def lines(self) -> DataFrame:
        li = self.raw("lineitem")
        su = self.raw("supplier").select("s_suppkey", "s_nationkey")
        return li.join(su, li.l_suppkey == su.s_suppkey).select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
            "l_linestatus", "l_extendedprice", "l_discount", "l_shipdate",
            F.col("l_partkey").cast("string").alias("item"),
            F.col("l_partkey").alias("product_key"),
            F.col("s_nationkey").cast("bigint").alias("location_key"),
            fc_code(F.col("s_nationkey")).alias("fc"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            F.col("l_quantity"),
            F.col("l_shipdate").cast("date").alias("d"),
        )

    # -- dimensions ----------------------------------------------------------
    @cached_property
    def region_map(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return (
            n.join(r, n.n_regionkey == r.r_regionkey)
            .where(F.col("n_nationkey") != 24)
            .select(fc_code(F.col("n_nationkey")).alias("location_code"),
                    F.col("r_name").alias("region"))
        )

    @cached_property
    def locations(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.raw("nation").select(
            k.cast("bigint").alias("location_key"),
            fc_code(k).alias("location_code"),
            (k % 12 != 11).alias("fulfillment_active"),
            F.when(k == 20, 0).otherwise(1).cast("int").alias("active_warehouse"),
            F.when(k == 22, 1).otherwise(0).cast("int").alias("warehouse_type"),
            F.when(k == 21, F.lit("OTHER")).otherwise(F.lit(self.p.company)).alias("company"),
        )

    @staticmethod
    def _discontinued(size: Column) -> Column:
        return F.when(size % 10 == 0, F.lit(None).cast("boolean")).otherwise(size % 10 == 9)

    @staticmethod
    def _private_label(brand: Column, size: Column) -> Column:
        return (F.when(brand == "Brand#13", F.lit(True))
                .when(size % 7 == 0, F.lit(None).cast("boolean"))
                .otherwise(F.lit(False)))

    @staticmethod
    def _abc(size: Column) -> Column:
        m = size % 4
        return (F.when(m == 0, "A").when(m == 1, "B").when(m == 2, "C").otherwise("D"))

    @cached_property
    def products(self) -> DataFrame:
        p = self.raw("part")
        s = F.col("p_size")
        return p.select(
            F.col("p_partkey").alias("product_key"),
            F.col("p_partkey").cast("string").alias("product_part_number"),
            F.col("p_type").alias("merch_classification1"),
            F.col("p_brand").alias("merch_classification2"),
            F.col("p_name").alias("merch_classification3"),
            self._abc(s).alias("abc_code"),
            self._discontinued(s).alias("discontinued_flag"),
            (s % 2 == 0).alias("published_flag"),
            self._private_label(F.col("p_brand"), s).alias("private_label_flag"),
        )

    @cached_property
    def item_attr(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(
            F.when(k % 40 == 0, F.concat(F.lit("RX"), k.cast("string")))
            .otherwise(k.cast("string")).alias("item_id"),
            F.when(k % 20 == 0, F.lit(self.p.new_item_attr)).otherwise(F.lit("CORE")).alias("attr_cd"),
        )

    @cached_property
    def vendors(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.raw("supplier").select(
            k.alias("vendor_key"),
            k.cast("string").alias("vendor_number"),
            F.col("s_name").alias("vendor_name"),
            F.concat(F.lit("B"), (k % 12).cast("string")).alias("purchaser_code"),
            F.when(k % 3 == 0, "DIRECT").otherwise("WAREHOUSE").alias("distribution_method"),
            F.when(k % 10 == 3, F.lit(True)).when(k % 10 == 7, F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)).alias("direct_import_flag"),
        )

    # -- facts ---------------------------------------------------------------
    @staticmethod
    def _signed_qty() -> Column:
        return F.when(F.col("l_linestatus") == "F", F.col("qty")).otherwise(-F.col("qty"))

    @cached_property
    def inventory_snapshot(self) -> DataFrame:
        """item x FC x day. Day as_of holds the stock built by all earlier lines;
        the 90 days before it hold that day's net movement (the KPI history)."""
        a = self.p.as_of
        ln = self.lines
        keys = ["product_key", "location_key"]
        at_as_of = (ln.where(F.col("d") < _d(a)).groupBy(*keys)
                    .agg(F.sum(self._signed_qty()).alias("q"))
                    .withColumn("snapshot_dt", _d(a)))
        daily = (ln.where(F.col("d").between(_d(a - dt.timedelta(days=90)), _d(a - dt.timedelta(days=1))))
                 .groupBy("d", *keys).agg(F.sum(self._signed_qty()).alias("q"))
                 .withColumnRenamed("d", "snapshot_dt"))
        both = at_as_of.unionByName(daily)
        pk_lk = F.col("product_key") + F.col("location_key")
        return both.select(
            "product_key", "location_key",
            F.col("product_key").cast("string").alias("product_part_number"),
            fc_code(F.col("location_key")).alias("location_code"),
            (pk_lk % 6 != 0).alias("managed_flag"),
            F.when(pk_lk % 23 == 0, F.lit(None).cast("int")).otherwise(F.col("q").cast("int"))
            .alias("sellable_quantity"),
            "snapshot_dt",
        )

    @cached_property
    def product_lifecycle(self) -> DataFrame:
        a = self.p.as_of
        ln = (self.lines.where(F.col("d").between(_d(a - dt.timedelta(days=90)), _d(a - dt.timedelta(days=1))))
              .where(F.col("l_returnflag") != "A")
              .select(F.col("d").alias("snapshot_date"), "product_key").distinct())
        p = self.raw("part").select("p_partkey", "p_size")
        k = F.col("p_partkey")
        return ln.join(p, ln.product_key == p.p_partkey).select(
            "snapshot_date",
            k.cast("string").alias("product_part_number"),
            self._discontinued(F.col("p_size")).alias("discontinued_flag"),
            F.when(k % 13 == 0, F.lit(True)).when(k % 13 == 1, F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)).alias("dropship_flag"),
        )

    @cached_property
    def forecast_current(self) -> DataFrame:
        return (
            self.lines.where((F.col("d") >= _d(self.p.as_of)) & (F.col("l_linestatus") == "F"))
            .groupBy("product_key", "location_key", F.col("d").alias("forecast_dt"))
            .agg(F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("manual_quantity"),
                 F.sum("l_quantity").alias("statistical_quantity"))
        )

    @cached_property
    def _onorder_df(self) -> DataFrame:
        rf = F.col("l_returnflag")
        marker = F.when(rf == "R", "RS").when(rf == "N", "TR").otherwise("ZZ")
        return (self.lines
                .where((F.col("d") >= _d(self.p.as_of - dt.timedelta(days=14))) & (F.col("l_linestatus") == "O"))
                .withColumn("lotid", F.concat_ws("-", marker, F.col("l_orderkey").cast("string"),
                                                 F.col("l_suppkey").cast("string"))))

    @cached_property
    def onorder_detail(self) -> DataFrame:
        return self._onorder_df.select(
            "item", "lotid",
            F.year("d").cast("string").alias("year"),
            F.month("d").cast("string").alias("month"),
            F.dayofmonth("d").cast("string").alias("day"),
            F.col("qty").cast("int").alias("onordqty"),
        )

    @cached_property
    def procurement_document(self) -> DataFrame:
        return self._onorder_df.select(
            F.col("lotid").alias("document_number"), "location_key").distinct()

    @cached_property
    def _item_fc_df(self) -> DataFrame:
        return (self.lines.groupBy("product_key", "location_key").agg(F.max("l_suppkey").alias("max_supp"))
                .select(F.col("product_key").cast("string").alias("item"), "product_key", "location_key",
                        fc_code(F.col("location_key")).alias("fc"), "max_supp"))

    @cached_property
    def item_location(self) -> DataFrame:
        pk, lk = F.col("product_key"), F.col("location_key")
        s = pk + lk
        supplier = (F.when(s % 29 == 0, F.lit("?"))
                    .when(s % 31 == 0, F.concat(fc_code((lk + 1) % 25), F.lit("-T")))
                    .when(s % 37 == 0, F.lit(None).cast("string"))
                    .otherwise(F.concat_ws("-", F.col("max_supp").cast("string"), F.col("fc"))))
        return self._item_fc_df.select(
            "item", F.col("fc").alias("location"), supplier.alias("supplier"),
            (pk % 7 + 1).cast("int").alias("minresint"),
            ((pk * 7 + lk) % 200).cast("int").alias("minreslot"),
            ((pk % 50).cast("double") / 8.0).alias("avedemqty"),
        )

    @cached_property
    def proposals(self) -> DataFrame:
        """Proposals per item x FC from the lines shipping in the next 60 days: one
        each, and for some a fill-in beside the primary one (kind 1), one of a
        second supplier (2) or a second lot of the same supplier (3). status X / P / null when the highest return flag is A / N / R; a few
        suppliers are FC codes (self transfers); items with key % 11 = 0 carry
        the previous run date (stale proposals)."""
        a = self.p.as_of
        g = (self.lines.where(F.col("d").between(_d(a), _d(a + dt.timedelta(days=60))))
             .groupBy("product_key", "location_key")
             .agg(F.sum("qty").alias("q"), F.min("d").alias("duedate"),
                  F.max("l_returnflag").alias("mrf"), F.max("l_suppkey").alias("ms"))
             .withColumns({"item": F.col("product_key").cast("string"),
                           "fc": fc_code(F.col("location_key"))}))
        s = F.col("product_key") + F.col("location_key")
        more = lambda cond, kind: F.when(cond, F.array(F.lit(kind))).otherwise(F.array().cast("array<int>"))
        primary = F.col("mrf") == "N"
        g = g.withColumn("kind", F.explode(F.concat(F.array(F.lit(0)), more(primary & (s % 5 == 0), 1), more(s % 7 == 0, 2),
                                                    more(primary & (s % 6 == 0), 3))))
        kind = F.col("kind")
        run = F.when(F.col("product_key") % 11 == 0, _d(a - dt.timedelta(days=1))).otherwise(_d(a))
        return g.select(
            "item",
            F.concat(F.col("fc"), F.lit("-1")).alias("destwhs"),
            F.when(kind == 2, F.concat_ws("-", (F.col("ms") % 5 + 1).cast("string"), F.col("fc")))
            .when(s % 9 == 0, fc_code((F.col("location_key") + 1) % 25))
            .otherwise(F.concat_ws("-", F.col("ms").cast("string"), F.col("fc"))).alias("supplier"),
            run.alias("prundate"),
            "duedate",
            F.when(kind == 1, F.col("q") + 3).when(kind == 2, F.col("q") * 2 + 5).when(kind == 3, F.col("q") + 7)
            .otherwise(F.col("q")).cast("int").alias("qty"),
            F.when((F.col("mrf") == "A") | (kind == 1), F.lit("X")).when(F.col("mrf") == "N", F.lit("P"))
            .otherwise(F.lit(None).cast("string")).alias("status"),
            run.alias("create_date"),
        )

    @cached_property
    def stock_tunnel(self) -> DataFrame:
        """Planning targets per item x FC x date for every date on which the item
        has a proposal due."""
        dates = self.proposals.select("item", F.col("duedate").alias("date")).distinct()
        ifc = self._item_fc_df.select("item", "product_key", "location_key", "fc")
        pk, lk = F.col("product_key"), F.col("location_key")
        return ifc.join(dates, "item").select(
            "item",
            F.concat(F.col("fc"), F.lit("A")).alias("whouse"),
            "date",
            F.when((pk + lk) % 19 == 0, F.lit(None).cast("double"))
            .otherwise((40 + pk % 50 - lk).cast("double")).alias("stkmin"),
            ((pk * 7 + lk * 13) % 90 - 10).cast("double").alias("stkono"),
        )

    @cached_property
    def excess_base(self) -> DataFrame:
        """item x day target snapshot for as_of-3 .. as_of+1. Safety stock came in
        as zero on as_of-2 and as_of-1 (bad loads); parts with key % 100 = 1 are
        loaded twice on as_of-3; parts with key % 50 = 7 are missing."""
        a = self.p.as_of
        p = self.raw("part").where(F.col("p_partkey") % 50 != 7)
        days = F.sequence(_d(a - dt.timedelta(days=3)), _d(a + dt.timedelta(days=1)))
        rows = p.select("*", F.explode(days).alias("snapshot_date"))
        dup = rows.where((F.col("p_partkey") % 100 == 1) &
                         (F.col("snapshot_date") == _d(a - dt.timedelta(days=3))))
        rows = rows.unionByName(dup)
        k, s = F.col("p_partkey"), F.col("p_size")
        bad = F.col("snapshot_date").isin(a - dt.timedelta(days=2), a - dt.timedelta(days=1))
        ss = F.when(bad, F.lit(0.0)).otherwise(s.cast("double"))
        fc_lt = (s * 2).cast("double")
        oh = ((k * 3) % 50).cast("int")
        oo = (k % 40).cast("int")
        outl = ss + fc_lt
        above = F.greatest(F.lit(0.0), (oh + oo).cast("double") - outl)
        avg_fc = (s % 8).cast("double") / 4.0
        return rows.select(
            "snapshot_date",
            k.cast("string").alias("product_part_number"),
            avg_fc.alias("avg_daily_forecast"),
            oh.alias("oh"), ss.alias("ss"), fc_lt.alias("fcast_over_lt_rp"), oo.alias("oo"),
            outl.alias("outl"), (oh + oo).cast("int").alias("oh_oo"),
            above.alias("units_above_outl"),
            F.try_divide(above, F.nullif(avg_fc, F.lit(0.0))).alias("days_above_outl"),
            F.lit(self.p.company).alias("parent_company"),
            self._private_label(F.col("p_brand"), s).alias("private_label_flag"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("merch_classification1"),
            F.col("p_brand").alias("merch_classification2"),
            F.col("p_name").alias("merch_classification3"),
            F.when(s % 2 == 0, "Y").otherwise("N").alias("otb_flag"),
            self._abc(s).alias("abc_code"),
            (k % 9).cast("int").alias("units_aged_over_60_days"),
            (above * F.col("p_retailprice")).alias("excess_inventory"),
            F.when(above > 0, F.lit("OVER_OUTL")).otherwise(F.lit(None).cast("string"))
            .alias("reason_for_excess"),
        )

    # -- compliance inputs -----------------------------------------------------
    @cached_property
    def procurement_product(self) -> DataFrame:
        ln = F.col("l_linenumber")
        ok = F.col("l_orderkey")
        q = F.col("l_quantity").cast("int")
        return self.lines.select(
            "product_key", F.col("l_suppkey").alias("vendor_key"), "location_key",
            F.col("item").alias("product_part_number"),
            F.concat(F.lit("PO"), ok.cast("string")).alias("document_number"),
            # purchase documents are placed weekly, on the Monday of the ship week
            F.date_trunc("week", F.col("l_shipdate")).cast("timestamp_ntz").alias("document_order_dttm"),
            (F.col("l_shipdate") + F.expr("INTERVAL 7 DAYS")).alias("requested_delivery_dttm"),
            (F.col("l_shipdate") + F.expr("INTERVAL 10 DAYS")).alias("expected_receipt_dttm"),
            F.concat(F.lit("B"), (F.col("l_suppkey") % 12).cast("string")).alias("purchaser_code"),
            q.alias("original_quantity"),
            (q - ln % 2).cast("int").alias("last_version_quantity"),
            (q % 5).cast("int").alias("outstanding_quantity"),
            F.when(ln == 3, F.lit(0.0)).otherwise(F.round("l_extendedprice", 0)).alias("total_cost"),
            (ln == 6).alias("deleted_by_users"),
            F.when((F.col("l_returnflag") == "R") & (ln == 1), "Transfer").otherwise(self.p.document_type)
            .alias("document_type"),
            F.when(ok % 9 == 0, "LEGACY").otherwise(self.p.data_source).alias("data_source"),
            F.when(ok % 13 == 0, F.lit(True)).when(ok % 13 == 1, F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)).alias("wms_closed_flag"),
            F.when(ok % 17 == 0, F.lit(True)).when(ok % 17 == 1, F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)).alias("ready_to_reconcile_flag"),
        )

    @cached_property
    def item_uom(self) -> DataFrame:
        p = self.raw("part")
        k, s = F.col("p_partkey"), F.col("p_size")
        item = k.cast("string").alias("item_number")
        main = p.select(F.lit(self.p.uom_warehouse).alias("wh_id"), item,
                        F.when(s % 3 == 0, "NO").otherwise("YES").alias("cartonization_flag"))
        other = p.select(F.lit("F002").alias("wh_id"), item, F.lit("NO").alias("cartonization_flag"))
        extra = p.where(k % 9 == 0).select(F.lit(self.p.uom_warehouse).alias("wh_id"), item,
                                           F.lit("NO").alias("cartonization_flag"))
        return main.unionByName(other).unionByName(extra)

    @cached_property
    def merch_performance(self) -> DataFrame:
        a = self.p.as_of
        # money in whole units, margins as 1/4 and 1/8 of sales: exact binary
        # values, so sums do not depend on the order rows are added in
        sales = F.round("l_extendedprice", 0)
        return (
            self.lines.where(F.col("d").between(_d(a - dt.timedelta(days=100)), _d(a)))
            .groupBy("product_key", F.col("d").alias("activity_date"))
            .agg(F.sum("qty").cast("int").alias("units_sold"),
                 F.sum(sales).alias("gross_sales"),
                 (F.sum(sales) * 0.25).alias("gross_margin"),
                 (F.sum(sales) * 0.125).alias("contribution_margin"),
                 F.sum("l_linenumber").cast("bigint").alias("distinct_pdp_views"))
            .select(F.col("product_key").cast("string").alias("product_part_number"), "activity_date",
                    "units_sold", "gross_sales", "gross_margin", "contribution_margin", "distinct_pdp_views")
        )

    @cached_property
    def recommendation_file(self) -> DataFrame:
        """The recommendation hand-off file (action, item, region, FC, supplier,
        quantity, need fraction) for lines around the run date."""
        a = self.p.as_of
        rm = self.region_map
        ln = self.lines.where(F.col("d").between(_d(a - dt.timedelta(days=10)), _d(a + dt.timedelta(days=60))))
        g = (ln.groupBy("product_key", "location_key", "l_suppkey").agg(F.sum("qty").alias("q"))
             .withColumns({"item": F.col("product_key").cast("string"), "fc": fc_code(F.col("location_key"))}))
        g = g.join(rm, g.fc == rm.location_code)
        m = (F.col("product_key") + F.col("l_suppkey")) % 4
        return g.select(
            F.when(m == 0, "APPROVE").when(m == 1, "REJECT").when(m == 2, "APPROVE")
            .otherwise("REJECT: Did not Propose").alias("action"),
            F.col("item").alias("item_id"), "region", F.col("fc").alias("location_cd"),
            F.concat_ws("-", F.col("l_suppkey").cast("string"), F.col("fc")).alias("supplier"),
            F.col("q").cast("int").alias("proposed_qty"),
            F.round((F.col("product_key") % 10).cast("double") / 9.0, 2).alias("fc_region_need_percent"),
        )

    @cached_property
    def historical_file(self) -> DataFrame:
        r = self.recommendation_file
        return r.select(
            F.lit(self.p.as_of - dt.timedelta(days=1)).alias("snapshot_date"),
            F.col("action").alias("action_"), F.col("item_id").alias("item"), "supplier",
            F.col("proposed_qty").alias("proposed_fc_qty"),
            F.col("fc_region_need_percent").cast("decimal(18,6)").alias("fc_region_need_percent"),
        )

    # -- order KPI inputs ------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("order_key"),
                                         F.col("o_orderstatus").alias("order_status"))

    @staticmethod
    def _line_id() -> Column:
        return F.concat_ws("-", *[F.col(c).cast("string") for c in
                                  ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])

    @cached_property
    def order_line(self) -> DataFrame:
        return self.lines.select(
            F.col("l_orderkey").alias("order_key"), self._line_id().alias("order_line_id"),
            F.col("location_key").alias("fulfillment_center_key"), "product_key",
            F.col("l_shipdate").alias("released_dttm"))

    @cached_property
    def shipment_order_line(self) -> DataFrame:
        ln = self.lines
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        j = ln.join(o, ln.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
        return j.select(self._line_id().alias("order_line_id"),
                        (F.abs(F.col("c_nationkey") - F.col("location_key")) % 7 + 2).cast("int")
                        .alias("actual_zone"))
