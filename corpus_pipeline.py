"""Training-data pipeline over ``documents``: quality classifier, SimHash
near-dedup, suffix-array dedup, secret scans, packing.

Each stage is written as Parquet below the shared checkpoint folder and read
again by the next. All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from restock.llm.common import stage, table
from restock.llm.packing import stage_packing
from restock.llm.quality import stage_quality
from restock.llm.secret_scan import stage_secrets
from restock.llm.simhash import stage_near_dedup
from restock.llm.suffix_dedup import stage_repeats

STAGES = [
    ("quality classifier", stage_quality),
    ("simhash near-dedup", stage_near_dedup),
    ("suffix-array dedup", stage_repeats),
    ("secret scans", stage_secrets),
    ("packing", stage_packing),
]

# fitted models, components of links and subword encoding are beyond SQL
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
