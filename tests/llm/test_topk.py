import math
from fractions import Fraction

import duckdb
import numpy as np
from pyspark.sql import functions as F

from restock.llm import topk as T
from tests.llm.helpers import SF

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, k=5):
    ok = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in ok if i % 50 == 0}:
        qv = next(v for i, v in ok if i == q)
        s = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(qv, v)))), i) for i, v in ok if i != q and len(v) == len(qv))
        out |= {(q, n + 1, i, -t) for n, (t, i) in enumerate(s[:k])}
    return out


def got(df):
    rows = [tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force_and_sql(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = got(T.query(spark, SF))
    assert found == plain(rows)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert found == set(con.execute(T.ORACLE).fetchall())


def test_small_blocks_nodes_and_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist(), 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for nodes in (1, 2, 6, 9):
        found = got(T.search(df, df.where("vec_id % 50 = 0"), nodes=nodes, block=64))
        assert found == plain([r[:2] for r in rows])


def test_odd_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.5, -0.001], 1), (1, [0.0, 0.0], 1), (2, None, 1), (3, [nan, 1.0], 1), (4, [inf, 0.0], 1), (5, [None, 0.0], 1), (6, [], 1),
            (None, [1.0, 1.0], 1), (7, [2.0, 1.0], 1), (7, [2.0, 1.0], 1), (50, [1.0], 1), (100, [1e300, 1.0], 1), (8, [1e17, -3.7], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("cutoff", F.lit(1))
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    rows_ = T.query(spark, str(tmp_path)).collect()
    # vector 7 stands twice, so it is in the list twice
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in rows_} == plain([r[:2] for r in rows])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert T.query(spark, str(tmp_path)).count() == 0


def test_different_vectors_of_a_query_all_ask(spark, tmp_path):
    rows = [(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (0, [0.001, 1.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.5, 0.25], 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got(T.query(spark, str(tmp_path))) == set(con.execute(T.ORACLE).fetchall())
