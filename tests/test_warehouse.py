"""The operators over materialised warehouse tables (``WarehouseTables``) give
the same results as over the adapter views."""

import __spark_entry__  # noqa: F401
from restock.params import Params
from restock.plans.chain import OperatorChain
from restock.plans.registry import inputs
from restock.sources.warehouse import WarehouseTables
from tests.conftest import SF_SMALL
from tools.materialize_inputs import materialize


def test_warehouse_tables_match_adapters(spark, tmp_path):
    paths = materialize(spark, SF_SMALL, str(tmp_path))
    p = Params()
    wh = OperatorChain(WarehouseTables(spark, paths, p), p)
    ad = OperatorChain(inputs(spark, SF_SMALL, p), p)
    for get in (lambda c: c.recommend("fillin"), lambda c: c.compliance_report,
                lambda c: c.region_oos, lambda c: c.order_zone):
        a, b = get(wh), get(ad)
        assert sorted(map(tuple, a.select(sorted(a.columns)).collect()), key=str) == \
            sorted(map(tuple, b.select(sorted(b.columns)).collect()), key=str)
