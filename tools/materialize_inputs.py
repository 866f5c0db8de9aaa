"""Write the logical input views of a test folder as parquet tables (date
partitioned where the warehouse would be), for running the operators through
``WarehouseTables`` exactly as on a cluster.
python tools/materialize_inputs.py <sf_dir> <out_dir>"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from restock.session import local_session  # noqa: E402
from restock.sources.adapters import DriverTables  # noqa: E402
from restock.sources.warehouse import LOGICAL_TABLES  # noqa: E402

PARTITIONS = {"inventory_snapshot": "snapshot_dt", "forecast_current": "forecast_dt",
              "stock_tunnel": "date", "excess_base": "snapshot_date", "product_lifecycle": "snapshot_date",
              "merch_performance": "activity_date"}


def materialize(spark, sf_dir: str, out: str) -> dict[str, str]:
    src = DriverTables(spark, sf_dir)
    paths = {}
    for name in LOGICAL_TABLES:
        df = getattr(src, name)
        w = df.write.mode("overwrite")
        if name in PARTITIONS:
            w = w.partitionBy(PARTITIONS[name])
        paths[name] = os.path.join(out, name)
        w.parquet(paths[name])
    return paths


if __name__ == "__main__":
    s = local_session(8)
    print(materialize(s, sys.argv[1], sys.argv[2]))
