"""A hot key (one item holding a third of all rows) gives the same results
when AQE splits the skewed partitions; checked against a pandas brute force."""

import datetime as dt
import random


from restock.operators import inventory as I
from restock.operators import kpi as K
from restock.params import Params

P = Params()


def _snapshot(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        item = 1 if i % 3 == 0 else rnd.randint(2, 400)                 # item 1: a third of all rows
        fc = rnd.randint(0, 5)
        day = P.kpi_start + dt.timedelta(days=rnd.randint(0, 20))
        q = rnd.choice([None, -3, 0, 2, 5])
        rows.append((item, fc, str(item), f"F{fc:03d}", True, q, day))
    for fc in range(6):                                                    # the run day for R2
        rows.append((1, fc, "1", f"F{fc:03d}", True, fc - 2, P.as_of))
    return spark.createDataFrame(rows, "product_key long, location_key long, product_part_number string, "
                                       "location_code string, managed_flag boolean, sellable_quantity int, "
                                       "snapshot_dt date")


def test_hot_item_region_oos_matches_brute_force(spark):
    snap = _snapshot(spark)
    rm = spark.createDataFrame([(f"F{k:03d}", "E" if k < 3 else "W") for k in range(6)],
                               "location_code string, region string")
    days = snap.select("snapshot_dt", "product_part_number").distinct()
    life = days.selectExpr("snapshot_dt AS snapshot_date", "product_part_number",
                           "CAST(NULL AS BOOLEAN) AS discontinued_flag", "false AS dropship_flag")
    rec = spark.createDataFrame([("1",)], "item_id string")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = K.region_oos_from_snapshot(snap, rm, life, rec, P).toPandas()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    pdf = snap.toPandas()
    pdf = pdf[(pdf.snapshot_dt >= P.kpi_start) & (pdf.snapshot_dt <= P.as_of - dt.timedelta(days=1))]
    pdf = pdf.merge(rm.toPandas(), on="location_code")
    pdf["u"] = pdf.sellable_quantity.fillna(0)
    want = pdf.groupby(["snapshot_dt", "product_part_number", "region"], as_index=False).u.sum()
    want["region_oos"] = (want.u <= 0).astype(int)
    a = sorted(zip(got.snapshot_date, got.product_part_number, got.region, got.region_oos))
    b = sorted(zip(want.snapshot_dt, want.product_part_number, want.region, want.region_oos))
    assert a == b
    assert all(h == (p == "1") for p, h in zip(got.product_part_number, got.hg_ordered_item))


def test_hot_item_inventory_base_keeps_every_row(spark):
    snap = _snapshot(spark)
    prods = spark.createDataFrame([(k, str(k)) for k in range(1, 401)], "product_key long, product_part_number string")
    locs = spark.createDataFrame([(k, f"F{k:03d}", True, 1, 0, P.company) for k in range(6)],
                                 "location_key long, location_code string, fulfillment_active boolean, "
                                 "active_warehouse int, warehouse_type int, company string")
    rm = spark.createDataFrame([(f"F{k:03d}", "E") for k in range(6)], "location_code string, region string")
    got = I.inventory_base(snap, prods, locs, rm, P).toPandas()
    assert len(got) == 6 and sorted(got.current_on_hand_fc) == [-2, -1, 0, 1, 2, 3]
    reg = I.region_on_hand(I.inventory_base(snap, prods, locs, rm, P)).toPandas()
    assert reg.current_on_hand_region.tolist() == [3]
