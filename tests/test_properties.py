"""Invariants of the operator outputs on the driver tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from restock.operators import kpi as K
from restock.operators.decisions import with_need_fraction
from restock.plans.registry import _pl
from tests.conftest import SF_SMALL

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pl(spark):
    return _pl(spark, SF)


def test_region_sums_equal_network(pl):
    reg = pl.region_on_hand.groupBy("product_part_number").agg(F.sum("current_on_hand_region").alias("s"))
    bad = reg.join(pl.network_on_hand, "product_part_number").where(
        ~F.col("s").eqNullSafe(F.col("current_on_hand_network")))
    assert bad.count() == 0
    reg_oo = pl.region_on_order.groupBy("product_part_number").agg(F.sum("oo_region").alias("s"))
    bad = reg_oo.join(pl.network_on_order, "product_part_number").where(F.col("s") != F.col("oo_network"))
    assert bad.count() == 0


@pytest.mark.parametrize("variant", ["base", "fillin"])
def test_ranks_are_permutations(pl, variant):
    r = pl.need_rank(variant)
    by_reg = r.groupBy("item", "region").agg(F.count(F.lit(1)).alias("n"),
                                              F.max("fc_need_rank_in_region").alias("mx"),
                                              F.countDistinct("fc_need_rank_in_region").alias("d"))
    assert by_reg.where((F.col("n") != F.col("mx")) | (F.col("n") != F.col("d"))).count() == 0
    by_net = r.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.max("fc_need_rank_in_network").alias("mx"))
    assert by_net.where(F.col("n") != F.col("mx")).count() == 0


@pytest.mark.parametrize("variant", ["base", "fillin"])
def test_need_fraction_bounds_and_monotone(pl, variant):
    f = with_need_fraction(pl.full_need(variant)).where(F.col("proposed_fc_qty").isNotNull())
    assert f.where(~F.col("fc_region_need_percent").between(0, 1)).count() == 0
    w = Window.partitionBy("item", "region").orderBy("fc_need_rank_in_region")
    prev = F.lag("fc_region_need_percent").over(w)
    assert f.select("*", prev.alias("prev")).where(
        F.col("fc_region_need_percent") > F.col("prev") + 1e-9).count() == 0


@pytest.mark.parametrize("variant", ["base", "fillin"])
def test_full_need_does_not_fan_out(pl, variant):
    assert pl.full_need(variant).count() <= pl.fc_need(variant).count()


def test_oos_rates_in_unit_interval(pl):
    r = K.region_oos_rate(pl.region_oos)
    assert r.where(~F.col("region_oos_percentage").between(0, 1)).count() == 0
    n = K.network_oos_rate(pl.network_oos)
    assert n.where(~F.col("network_oos_percentage").between(0, 1)).count() == 0


def test_repair_preserves_source_day_counts(spark):
    from restock.operators import snapshots as S
    p = _pl(spark, SF_SMALL)
    eb = p.excess_base
    plan = S.repair_plan(eb).collect()
    fixed = S.outl_repair(eb)
    for r in plan:
        src = eb.where(F.col("snapshot_date") == r.source_date).distinct().count()
        assert fixed.where(F.col("snapshot_date") == r.bad_date).count() == src


@pytest.mark.parametrize("mode", ["floor", "net"])
def test_projection_equals_grouped_loop(pl, mode):
    """R13 closed form (two running windows) equals the week-by-week recursion
    run per (item, region) group with applyInPandas (test-only cross-check)."""
    import pandas as pd

    from restock.operators.projection import inventory_projection

    base = pl.regional_base.where(F.col("week").isNotNull()).select(
        "product_part_number", "region", "week", "current_on_hand_region", "forecast_region",
        "oo_region_for_week")

    def loop(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("week")
        oh = g["current_on_hand_region"].fillna(0).astype(int).iloc[0]
        inv, s, out = float(oh), float(oh), []
        for oo, fc in zip(g["oo_region_for_week"].fillna(0), g["forecast_region"].fillna(0.0)):
            x = float(oo) - float(fc)
            s += x
            inv = max(0.0, inv + x) if mode == "floor" else s
            out.append(inv)
        return pd.DataFrame({"product_part_number": g["product_part_number"], "region": g["region"],
                             "week": g["week"], "want": out})

    want = base.groupBy("product_part_number", "region").applyInPandas(
        loop, "product_part_number string, region string, week date, want double")
    got = inventory_projection(pl.regional_base, mode)
    diff = got.join(want, ["product_part_number", "region", "week"], "full_outer").where(
        F.col("inv").isNull() | F.col("want").isNull() | (F.abs(F.col("inv") - F.col("want")) > 1e-9))
    assert diff.count() == 0
