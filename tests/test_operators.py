"""Hand-computed micro fixtures for the operators and the reference quirks."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from restock.functions.columns import need_fraction
from restock.operators import decisions as D
from restock.operators import projection as PJ
from restock.operators import proposals as PR
from restock.operators import snapshots as S
from restock.params import Params

P = Params()


def test_need_fraction_cases(spark):
    rows = [(5.0, 10, 1.0), (0.0, 10, 1.0), (-4.0, 10, 0.6), (-5.0, 10, 0.5), (-6.0, 10, 0.4),
            (-10.0, 5, 0.0), (-10.0, None, 0.0), (None, 10, 0.0), (3.0, None, 1.0)]
    df = spark.createDataFrame(rows, "left double, qty int, want double")
    got = df.select(need_fraction(F.col("left"), F.col("qty")).alias("f"), "want").collect()
    for r in got:
        assert r.f == pytest.approx(r.want)


LADDER = ("supplier string, is_fillin boolean, projected_region_oos_erddweek boolean, "
          "fc_need_rank_in_region int, fc_region_need_percent double, want string")


def test_fillin_ladder_all_rungs(spark):
    rows = [
        (None, False, True, 1, 1.0, "REJECT: Did not Propose"),
        ("1-F001", True, True, 2, 0.0, "APPROVE"),
        ("1-F001", True, False, 1, 1.0, "REJECT: instock Fill-in"),
        ("1-F001", False, True, 1, 0.0, "APPROVE"),
        ("1-F001", False, True, 2, 0.3, "REJECT"),
        ("1-F001", False, False, 1, 0.5, "APPROVE"),
        ("1-F001", False, False, 1, None, None),
    ]
    df = spark.createDataFrame(rows, LADDER)
    for r in df.select(D.decision("fillin", P).alias("a"), "want").collect():
        assert r.a == r.want


def test_base_ladder_needs_negative_need_left(spark):
    rows = [("1-F001", True, 1, -3.0, 0.2, "APPROVE"),
            ("1-F001", True, 1, 2.0, 0.2, "REJECT"),
            ("1-F001", True, 2, -3.0, 0.7, "APPROVE"),
            (None, True, 1, -3.0, 1.0, "REJECT: Did not Propose")]
    df = spark.createDataFrame(rows, "supplier string, projected_region_oos boolean, fc_need_rank_in_region int, "
                                     "region_need_left_after_order_cummulative double, "
                                     "fc_region_need_percent double, want string")
    for r in df.select(D.decision("base", P).alias("a"), "want").collect():
        assert r.a == r.want


def test_high_moq(spark):
    rows = [(100, 0.0, False), (100, None, False), (60, 1.0, False), (61, 1.0, True), (0, 0.0004, False)]
    df = spark.createDataFrame(rows, "moq int, avg_daily_forecast double, want boolean")
    for r in df.select(D.high_moq(P).alias("h"), "want").collect():
        assert r.h == r.want


def _tunnel(spark, rows):
    return spark.createDataFrame(rows, "item string, location string, region string, proposed_qty int, "
                                       "proposal_type string, is_fillin boolean, fc_need double, "
                                       "fc_outl double, fc_ip double").selectExpr(
        "*", "concat('1-', location) AS supplier", "DATE'2022-05-02' AS duedate", "'P' AS status")


def test_ranks_tie_break_and_fillin_last(spark):
    rows = [("1", "F002", "E", 5, "1", False, 10.0, 10.0, 0.0),
            ("1", "F001", "E", 5, "1", False, 10.0, 10.0, 0.0),
            ("1", "F003", "E", 5, "2", True, 50.0, 50.0, 0.0)]
    out = {r.location: r for r in D.ranked_need(_tunnel(spark, rows), "fillin").collect()}
    assert out["F001"].fc_need_rank_in_region == 1
    assert out["F002"].fc_need_rank_in_region == 2
    assert out["F003"].fc_need_rank_in_region == 3          # fill-in ranked after primaries
    assert out["F003"].fc_need_rank_in_network == 1         # network rank ignores type
    assert out["F001"].total_reg_outl == 20.0          # fill-in row not counted
    assert out["F002"].region_proposed_qty_cummulative == 10


def test_region_with_only_fillin_rows_dropped(spark):
    rows = [("1", "F001", "E", 5, "2", True, 10.0, 10.0, 0.0),
            ("1", "F005", "W", 5, "1", False, 3.0, 3.0, 0.0)]
    out = D.ranked_need(_tunnel(spark, rows), "fillin").collect()
    assert [r.region for r in out] == ["W"]
    assert out[0].network_proposed_qty_cummulative == 5


def test_proposal_base_self_transfer_and_null_supplier(spark):
    il = spark.createDataFrame([("1", "F001", "9-F001", 1, 10, 1.0), ("1", "F002", None, 1, 10, 1.0),
                                ("1", "F003", "7-F003", 1, 10, 1.0)],
                               "item string, location string, supplier string, minresint int, minreslot int, "
                               "avedemqty double")
    rm = spark.createDataFrame([("F001", "E"), ("F002", "E"), ("F003", "E")], "location_code string, region string")
    prod = spark.createDataFrame([("1", None)], "product_part_number string, discontinued_flag boolean")
    a = P.as_of
    props = spark.createDataFrame(
        [("1", "F001-1", "F002", a, a + dt.timedelta(days=3), 5, "P", a),        # self transfer: dropped
         ("1", "F003-1", "7-F003", a, a + dt.timedelta(days=9), 4, "X", a)],     # fill-in
        "item string, destwhs string, supplier string, prundate date, duedate date, qty int, status string, "
        "create_date date")
    vend = spark.createDataFrame([("7", "V7")], "vendor_number string, vendor_name string")
    out = {r.location: r for r in PR.proposal_base(il, rm, prod, props, vend, P, "fillin").collect()}
    assert set(out) == {"F002", "F003"}
    assert out["F002"].supplier is None and out["F002"].proposal_type == "3"
    assert out["F003"].proposal_type == "2" and out["F003"].vendor_name == "V7"
    assert out["F003"].min_erdd_region is None                # X rows are left out of the min date


def _loop(on_hand, flows, mode):
    inv, s, res = on_hand, on_hand, []
    for oo, fc in flows:
        x = (oo or 0) - (fc or 0.0)
        s += x
        inv = max(0.0, inv + x) if mode == "floor" else s
        res.append(inv)
    return res


@settings(max_examples=15, deadline=None)
@given(on_hand=st.integers(-50, 50),
       flows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 40)),
                                st.one_of(st.none(), st.integers(0, 40).map(float))), min_size=1, max_size=12))
def test_projection_closed_form_equals_loop(spark, on_hand, flows):
    base = dt.date(2000, 1, 3)
    rows = [("1", "E", on_hand, base + dt.timedelta(weeks=i), fc, oo) for i, (oo, fc) in enumerate(flows)]
    df = spark.createDataFrame(rows, "product_part_number string, region string, current_on_hand_region bigint, "
                                     "week date, forecast_region double, oo_region_for_week bigint")
    for mode in ("floor", "net"):
        got = [r.inv for r in PJ.inventory_projection(df, mode).orderBy("week").collect()]
        assert got == pytest.approx(_loop(on_hand, flows, mode))


def _excess(spark, rows):
    return spark.createDataFrame(rows, "snapshot_date date, product_part_number string, ss double, oh int")


def test_repair_copies_last_good_day_and_is_idempotent(spark):
    d = [dt.date(2022, 5, k) for k in range(26, 31)]
    rows = [(d[0], "a", 1.0, 1), (d[0], "b", 2.0, 2), (d[1], "a", 3.0, 1), (d[1], "a", 3.0, 1),
            (d[2], "a", 0.0, 9), (d[3], "a", 0.0, 9), (d[4], "a", 5.0, 5)]
    eb = _excess(spark, rows)
    bad = sorted(r.snapshot_date for r in S.outl_bad_dates(eb).collect())
    assert bad == [d[2], d[3]]
    plan = {r.bad_date: r.source_date for r in S.repair_plan(eb).collect()}
    assert plan == {d[2]: d[1], d[3]: d[1]}                   # two bad days in a row: both from d[1]
    fixed = S.outl_repair(eb)
    by_day = {}
    for r in fixed.collect():
        by_day.setdefault(r.snapshot_date, []).append((r.product_part_number, r.ss, r.oh))
    assert by_day[d[2]] == [("a", 3.0, 1)]                    # duplicate of the source removed
    assert by_day[d[3]] == [("a", 3.0, 1)]
    assert sorted(S.outl_repair(fixed).collect()) == sorted(fixed.collect())


def test_repair_bad_first_day_stays_and_is_listed(spark):
    eb = _excess(spark, [(dt.date(2022, 5, 1), "a", 0.0, 1), (dt.date(2022, 5, 2), "a", 4.0, 1)])
    out = S.outl_repair(eb).collect()
    assert sorted(r.snapshot_date for r in out) == [dt.date(2022, 5, 1), dt.date(2022, 5, 2)]
    assert [r.snapshot_date for r in S.unrepaired_days(S.repair_plan(eb)).collect()] == [dt.date(2022, 5, 1)]


def test_repair_never_copies_a_zero_day(spark):
    d = [dt.date(2022, 5, k) for k in (1, 2, 3)]
    eb = _excess(spark, [(d[0], "a", 4.0, 1), (d[1], "a", 0.0, 2), (d[2], "a", 5.0, 3)])
    listed = spark.createDataFrame([(d[2],)], "snapshot_date date")
    assert [tuple(r) for r in S.repair_plan(eb, listed).collect()] == [(d[2], d[0])]


def test_delete_days_and_append_history(spark, tmp_path):
    d = [dt.date(2022, 5, k) for k in (1, 2)]
    path = str(tmp_path / "t")
    S.write_partitioned(_excess(spark, [(d[0], "a", 1.0, 1), (d[1], "a", 2.0, 1)]), path)
    more = _excess(spark, [(d[1], "b", 3.0, 2)])
    assert S.append_history(more, path) == 1 and S.append_history(more, path) == 0
    assert spark.read.parquet(path).count() == 3
    S.delete_days(spark, path, [d[0]])
    assert {r.snapshot_date for r in spark.read.parquet(path).collect()} == {d[1]}


def test_ranks_do_not_depend_on_input_order(spark):
    """Several proposals of one FC with equal need."""
    rows = [("1", "F001", "E", q, "1", False, 10.0, 10.0, 0.0) for q in (5, 50, 7, 50)]
    rows += [("1", "F002", "E", q, "2", True, 10.0, 10.0, 0.0) for q in (9, 1)]
    got = []
    for k in (1, 5):
        df = _tunnel(spark, rows if k == 1 else rows[::-1]).repartition(k)
        got.append(sorted(str(tuple(r)) for r in D.ranked_need(df, "fillin").collect()))
    assert got[0] == got[1]


def test_repair_table_overwrites_only_bad_partitions(spark, tmp_path):
    d = [dt.date(2022, 5, k) for k in (1, 2, 3)]
    eb = _excess(spark, [(d[0], "a", 2.0, 1), (d[1], "a", 0.0, 7), (d[2], "a", 3.0, 3)])
    path = str(tmp_path / "eb")
    S.write_partitioned(eb, path)
    S.repair_table(spark, path)
    got = {(r.snapshot_date, r.ss, r.oh) for r in spark.read.parquet(path).collect()}
    assert got == {(d[0], 2.0, 1), (d[1], 2.0, 1), (d[2], 3.0, 3)}


def test_latest_good_snapshot(spark):
    d = [dt.date(2022, 5, k) for k in (1, 2, 3)]
    eb = _excess(spark, [(d[0], "a", 2.0, 1), (d[1], "a", 0.0, 7), (d[2], "a", 3.0, 3)])
    assert S.latest_good_snapshot(eb, d[1]) == d[0]
    assert S.latest_good_snapshot(eb, d[2]) == d[2]


def test_outl_date_rule_latest_good(spark):
    from restock.plans.chain import OperatorChain
    from restock.plans.registry import inputs
    from tests.conftest import SF_SMALL
    src = inputs(spark, SF_SMALL)
    # the day before the run day is a bad load: the last good day is as_of - 3
    p = Params(as_of=P.as_of - dt.timedelta(days=1), outl_date_rule="latest_good")
    assert OperatorChain(src, p).p.outl_day == P.as_of - dt.timedelta(days=3)
    assert OperatorChain(src, Params(outl_date_rule="latest_good")).p.outl_day == P.as_of
