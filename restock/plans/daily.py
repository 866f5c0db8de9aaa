"""Daily recommendation run (S6/S10): compute the labelled proposals and
write them to the persistent recommendation table, one partition per run day.

Writing uses dynamic partition overwrite, so re-running a day replaces only
that day (idempotent), and long sub-plans are checkpointed into the cluster's
shared checkpoint folder so a lost executor does not replay the whole DAG.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.operators import decisions as D
from restock.operators import snapshots as S
from restock.params import Params
from restock.plans.chain import OperatorChain
from restock.session import ITEM_COPARTITION_CONF, session_conf


def recommendations(src, params: Params, variant: str = "base") -> DataFrame:
    return OperatorChain(src, params).recommend(variant)


def run_daily(src, params: Params, table_path: str, variant: str = "base",
              handoff_csv: str | None = None) -> DataFrame:
    """Write the day's recommendations to ``table_path`` (and, optionally, the
    hand-off CSV, sorted over its part files). Returns the written rows, read back.

    The whole run - including the eager checkpoints of the long sub-plans -
    is planned with item co-partitioning (see ``session.ITEM_COPARTITION_CONF``)."""
    p = params.with_(checkpoint_stages=True)
    spark = src.excess_base.sparkSession
    with session_conf(spark, ITEM_COPARTITION_CONF):
        rec = OperatorChain(src, p).recommend(variant)
        table = (S.to_recommendation_table(rec, p.as_of) if variant == "base"
                 else rec.withColumn("snapshot_date", F.lit(p.as_of)))
        S.write_partitioned(table, table_path)
    written = spark.read.parquet(table_path).where(F.col("snapshot_date") == F.lit(p.as_of))
    if handoff_csv:
        # a range-partitioned sort: the part files in name order are the rows in order
        (D.presentation_order(written, variant).write.mode("overwrite")
         .option("header", True).csv(handoff_csv))
    return written
