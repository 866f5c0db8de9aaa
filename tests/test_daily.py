"""Daily run: writes the persistent table, one partition per run day, rerun-safe."""

import csv

import __spark_entry__  # noqa: F401  (puts the repo on the path)
from restock.operators.snapshots import RECOMMENDATION_SCHEMA
from restock.params import Params
from restock.plans.daily import run_daily
from restock.plans.reports import write_reports
from restock.sources.adapters import DriverTables
from tests.conftest import SF_SMALL


def _lines(folder):
    out = []
    for f in sorted(folder.glob("part-*.csv")):
        with f.open(newline="") as h:
            out += list(csv.DictReader(h))
    return out


def test_sorted_files_are_in_row_order(spark, tmp_path):
    df = spark.range(5000).selectExpr("cast((id * 7919) % 97 as int) AS snapshot_date", "id AS x", "concat('r', id % 5) AS region")
    write_reports({"region_oos_rate": df.repartition(6)}, str(tmp_path))
    rows = [(r["region"], int(r["snapshot_date"])) for r in _lines(tmp_path / "region_oos_rate")]
    assert len(rows) == 5000 and rows == sorted(rows)


def test_run_daily_idempotent(spark, tmp_path):
    p = Params()
    src = DriverTables(spark, SF_SMALL, p)
    path = str(tmp_path / "rec")
    first = run_daily(src, p, path, handoff_csv=str(tmp_path / "handoff"))
    n = first.count()
    assert n > 0
    keys = [(r["supply_planner"], r["item"], r["region"], int(r["fc_need_rank_in_region"])) for r in _lines(tmp_path / "handoff")]
    assert len(keys) == n and keys == sorted(keys)
    assert sorted(first.columns) == sorted(f.name for f in RECOMMENDATION_SCHEMA.fields)
    run_daily(src, p, path)
    assert spark.read.parquet(path).count() == n
