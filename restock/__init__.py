"""restock: regional replenishment analytics as lazy Spark DataFrame operators.

Every public operator is a pure function ``DataFrame(s), Params -> DataFrame``
built from native joins, aggregates and window functions, so Catalyst plans the
whole chain as one DAG (predicate pushdown, column pruning, partial
aggregation, one shuffle per key change).

Entry points: ``OperatorChain`` (operators wired over a source of logical
inputs), ``WarehouseTables`` (real tables by logical name), ``DriverTables``
(inputs derived from the test tables), ``run_daily`` (daily recommendation
write) and ``Params`` (run date, thresholds, allowlists).
"""

from restock.params import Params


def __getattr__(name):  # lazy imports keep `import restock` light
    if name == "OperatorChain":
        from restock.plans.chain import OperatorChain
        return OperatorChain
    if name == "WarehouseTables":
        from restock.sources.warehouse import WarehouseTables
        return WarehouseTables
    if name == "DriverTables":
        from restock.sources.adapters import DriverTables
        return DriverTables
    if name == "run_daily":
        from restock.plans.daily import run_daily
        return run_daily
    raise AttributeError(name)


__all__ = ["Params", "OperatorChain", "WarehouseTables", "DriverTables", "run_daily"]
