"""Physical plan checks: no nested-loop or cartesian joins, no Python in the
hot path, and one shuffle on item for ranks + running sums."""

import __spark_entry__ as E
from restock.operators import decisions as D
from tests.conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_forbidden_operators(spark):
    for key in ("recommend_fillin", "recommend", "compliance_report", "region_oos_rate", "split_rate",
                "avg_zone", "outl_repair", "network_need_fraction"):
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        for f in FORBIDDEN:
            assert f not in plan, (key, f)


def test_rank_windows_share_one_exchange(spark):
    t = spark.createDataFrame([("1", "F001", "E", 5, "1", False, 1.0, 1.0, 0.0)],
                              "item string, location string, region string, proposed_qty int, "
                              "proposal_type string, is_fillin boolean, fc_need double, "
                              "fc_outl double, fc_ip double").selectExpr("*", "'1-F001' AS supplier", "current_date() AS duedate", "'P' AS status")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(D.ranked_need(t.repartition(4), "fillin"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert plan.count("Window ") >= 2


def test_stock_tunnel_match_prunes_date_partitions(spark, tmp_path):
    """Stored by date, the stock tunnel is read only for the proposals' due
    dates (dynamic partition pruning)."""
    from restock.operators import proposals as PR
    from restock.plans.registry import _pl
    pl = _pl(spark, SF_SMALL)
    path = str(tmp_path / "stock_tunnel")
    pl.src.stock_tunnel.write.partitionBy("date").parquet(path)
    df = PR.fc_need(pl.proposal_base("fillin"), spark.read.parquet(path), "fillin")
    assert "dynamicpruningexpression(date" in _plan(df)


def test_target_snapshot_read_for_one_day(spark, tmp_path):
    """Stored by day, the target snapshot contributes one partition to R12."""
    from restock.operators import projection as PJ
    from restock.plans.registry import _pl
    pl = _pl(spark, SF_SMALL)
    path = str(tmp_path / "excess_base")
    pl.excess_base.write.partitionBy("snapshot_date").parquet(path)
    df = PJ.regional_base(pl.region_on_hand, pl.network_on_hand, spark.read.parquet(path),
                          pl.network_on_order, pl.forecast_windows, pl.weekly_on_order, pl.p)
    scans = [line for line in _plan(df).split("\n")
             if "FileScan parquet" in line and "PartitionFilters: [isnotnull(snapshot_date" in line]
    assert scans and all("(snapshot_date" in s and "= 2000-01-05)" in s for s in scans), scans


def test_item_copartitioning_removes_shuffles(spark):
    """Within the daily run's scoped setting, item-keyed operators reuse the
    item partitioning of the proposal rows."""
    from restock.session import ITEM_COPARTITION_CONF, session_conf

    def shuffles():
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            p = _plan(E.queries()["recommend_fillin"](spark, SF_SMALL))
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        return sum(1 for ln in p.split("\n") if "Exchange hashpartitioning" in ln and "Reused" not in ln)

    default = shuffles()
    with session_conf(spark, ITEM_COPARTITION_CONF):
        scoped = shuffles()
    assert scoped < default, (scoped, default)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_cluster_conf_runs_and_keeps_results(spark, con):
    """The cluster settings are valid runtime SQL settings and do not change results."""
    from restock.session import CLUSTER_CONF, session_conf
    from tests.oracle_compare import compare
    with session_conf(spark, CLUSTER_CONF):
        for key in ("region_oos_rate", "recommend"):
            r = compare(E.queries()[key](spark, SF_SMALL), con, E.oracle_sql()[key])
            assert r["match"], (key, r)


def _below(plan, node):
    """The lines of the plan that stand below a line with ``node``."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    out, top = [], None
    for line in plan.split("\n"):
        if top is not None and depth(line) > top:
            out.append(line)
            continue
        top = depth(line) if node in line else None
    return out


def test_item_tables_are_not_broadcast(spark):
    """One row per item grows with the input, however small its files are."""
    for key in ("compliance", "compliance_detail", "placed_orders"):
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        assert "p_partkey" in plan and not [x for x in _below(plan, "BroadcastExchange") if "p_partkey" in x], key


def test_report_item_tables_are_not_broadcast(spark):
    for key in ("compliance_report", "trailing_performance"):
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        assert "p_partkey" in plan and not [x for x in _below(plan, "BroadcastExchange") if "p_partkey" in x], key


def test_demand_is_summed_before_it_is_sorted(spark):
    """The semi join of the ordered items sorts one row per item, not one per item and FC."""
    for key in ("network_demand", "compliance"):
        below = _below(_plan(E.queries()[key](spark, SF_SMALL)), "LeftSemi")
        assert any("functions=[sum(avedemqty" in x for x in below), key
