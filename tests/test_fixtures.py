"""Hand-computed micro fixtures (FIXTURES.md section 6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from restock.operators import compliance as C
from restock.operators import forecast as FC
from restock.operators import inventory as I
from restock.operators import kpi as K
from restock.operators import onorder as OO
from restock.operators import proposals as PR
from restock.params import Params

P = Params()
A = P.as_of                                   # 2000-01-05, a Wednesday
MON = A - dt.timedelta(days=2)                # its Monday


@pytest.fixture()
def dims(spark):
    locs = spark.createDataFrame(
        [(0, "F000", True, 1, 0, P.company), (1, "F001", True, 1, 0, P.company),
         (2, "F002", False, 1, 0, P.company),           # inactive
         (3, "F003", True, 1, 0, P.company)],           # not in the region map
        "location_key long, location_code string, fulfillment_active boolean, active_warehouse int, "
        "warehouse_type int, company string")
    rm = spark.createDataFrame([("F000", "E"), ("F001", "E"), ("F002", "W")], "location_code string, region string")
    prods = spark.createDataFrame([(10, "10"), (11, "11")], "product_key long, product_part_number string")
    return locs, rm, prods


def test_inventory_base_edges(spark, dims):
    locs, rm, prods = dims
    snap = spark.createDataFrame(
        [(10, 0, "10", "F000", True, 5, A), (10, 1, "10", "F001", False, None, A),
         (10, 2, "10", "F002", True, 7, A), (10, 3, "10", "F003", True, 9, A),
         (11, 0, "11", "F000", True, -4, A), (11, 0, "11", "F000", True, 100, A - dt.timedelta(days=1)),
         (99, 0, "99", "F000", True, 1, A)],                                  # unknown product
        "product_key long, location_key long, product_part_number string, location_code string, "
        "managed_flag boolean, sellable_quantity int, snapshot_dt date")
    base = I.inventory_base(snap, prods, locs, rm, P)
    got = sorted((r.product_part_number, r.location_code, r.current_on_hand_fc) for r in base.collect())
    assert got == [("10", "F000", 5), ("10", "F001", None), ("11", "F000", -4)]
    reg = {r.product_part_number: r.current_on_hand_region for r in I.region_on_hand(base).collect()}
    assert reg == {"10": 5, "11": -4}                   # null quantities are skipped by the sum


def test_weekly_forecast_edges(spark, dims):
    locs, rm, prods = dims
    fc = spark.createDataFrame(
        [(10, 0, A, None, 3.0), (10, 1, A + dt.timedelta(days=1), 2.0, 9.0),      # manual wins
         (10, 0, A - dt.timedelta(days=1), None, 50.0),                            # before the run day
         (10, 0, A + dt.timedelta(days=6), None, 4.0),                             # next week (Monday)
         (10, 0, P.horizon_end + dt.timedelta(days=1), None, 70.0),                # past the horizon
         (10, 2, A, None, 80.0)],                                                  # inactive FC
        "product_key long, location_key long, forecast_dt date, manual_quantity double, "
        "statistical_quantity double")
    weekly = FC.weekly_forecast(fc, prods, locs, rm, P)
    got = sorted((r.region, r.week, r.forecast_region) for r in weekly.collect())
    assert got == [("E", MON, 5.0), ("E", MON + dt.timedelta(days=7), 4.0)]
    win = {r.week: r for r in FC.forecast_windows(weekly, P).collect()}
    assert win[MON].week_rank_region == 1 and win[MON + dt.timedelta(days=7)].cumulative_forecast_region == 9.0
    assert win[MON].daily_forecast_mean == pytest.approx(1.0)   # 5 units over the 5 days Wed..Sun


def test_weekly_on_order_edges(spark, dims):
    locs, rm, prods = dims
    oo = spark.createDataFrame(
        [("10", "RS-1", "2000", "1", "7", 4), ("10", "TR-2", "2000", "1", "12", 6),
         ("10", "ZZ-3", "2000", "1", "7", 50),                       # neither marker
         ("10", "RS-4", "2000", "1", "4", 70),                       # before the run day
         ("10", "RS-5", "2000", "01", "07", 1)],                     # padded parts parse too
        "item string, lotid string, year string, month string, day string, onordqty int")
    docs = spark.createDataFrame([("RS-1", 0), ("TR-2", 1), ("ZZ-3", 0), ("RS-4", 0), ("RS-5", 1)],
                                 "document_number string, location_key long")
    got = sorted((r.region, r.week, r.oo_region)
                 for r in OO.weekly_on_order(oo, prods, docs, locs, rm, P).collect())
    assert got == [("E", MON, 5), ("E", MON + dt.timedelta(days=7), 6)]


def test_stock_tunnel_clamps(spark):
    props = spark.createDataFrame(
        [("1", "F001", 5, "1", "9-F001", None, 1, 10, A, A, A, "E", "P")],
        "item string, location string, proposed_qty int, proposal_type string, supplier string, "
        "vendor_name string, review_period int, moq int, prundate date, duedate date, "
        "min_erdd_region date, region string, status string")
    st = spark.createDataFrame([("1", "F001A", A, None, -7.0), ("1", "F001A", A + dt.timedelta(days=1), 9.0, 1.0)],
                               "item string, whouse string, date date, stkmin double, stkono double")
    r = PR.fc_need(props, st, "fillin").collect()
    assert len(r) == 1                                            # matched on the regional due date
    assert (r[0].fc_outl, r[0].fc_ip, r[0].fc_need) == (0.0, 0.0, 0.0)
    assert r[0].is_fillin is False


def test_compliance_rollup_edges(spark):
    day = A - dt.timedelta(days=2)
    ts = dt.datetime.combine(day, dt.time())
    orders = spark.createDataFrame(
        [(day, "B1", "PO2", "F001", "7", "V7", "10", ts, ts, 5, 5, 1, 0.0),
         (day, "B1", "PO1", "F001", "7", "V7", "10", ts, ts, 3, 3, 0, 0.0)],      # zero cost, two documents
        "document_order_date date, purchaser_code string, document_number string, location_code string, "
        "vendor_number string, vendor_name string, product_part_number string, rdd timestamp, "
        "erdd timestamp, original_quantity int, last_version_quantity int, outstanding_quantity int, "
        "total_cost double")
    r = C.placed_orders_rollup(orders).collect()
    assert len(r) == 1 and r[0].orders_placed == "PO1,PO2" and r[0].original_quantity == 8
    assert r[0].units_per_cost is None and r[0].cost_per_unit == 0.0


def test_split_orders_window_and_fcs(spark, dims):
    locs, _, prods = dims
    start = A - dt.timedelta(days=P.split_window_days)
    t = lambda d: dt.datetime.combine(d, dt.time())
    lines = spark.createDataFrame(
        [(1, "1a", 0, 10, t(A - dt.timedelta(days=3))), (1, "1b", 1, 11, t(A - dt.timedelta(days=2))),  # split
         (2, "2a", 0, 10, t(start)), (2, "2b", 2, 11, t(A - dt.timedelta(days=1))),    # 2nd line ineligible FC
         (3, "3a", 0, 10, t(start - dt.timedelta(days=1))),                            # just out of the window
         (4, "4a", 0, 10, t(A - dt.timedelta(days=5))),                                # excluded status
         (5, "5a", 0, 10, t(A))],                                                      # released today
        "order_key long, order_line_id string, fulfillment_center_key long, product_key long, "
        "released_dttm timestamp")
    orders = spark.createDataFrame([(1, "O"), (2, "P"), (3, "O"), (4, "F"), (5, "O")],
                                   "order_key long, order_status string")
    got = {r.order_key: r.is_split for r in K.split_orders(lines, orders, locs, prods, P).collect()}
    assert got == {1: 1, 2: 0}
    rec = spark.createDataFrame([("11",)], "item_id string")
    items = K.split_order_items(K.split_orders(lines, orders, locs, prods, P), lines, prods)
    rate = {(r.order_released_date, r.contains_nbhg_item): (r.split_order_count, r.count_orders)
            for r in K.split_rate(items, rec).collect()}
    # order 2 holds item 11 only on its ineligible-FC line, yet counts as tracked (all lines re-joined)
    assert rate == {(A - dt.timedelta(days=3), 1): (1, 1), (start, 1): (0, 1)}
