import numpy as np
from pyspark.sql import functions as F

from restock.llm import ann as A
from tests.llm.helpers import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, k=5):
    ids = np.array([i for i, _ in rows])
    vs = np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if i % 50 == 0:
            keep = ids != i
            s = A.cosine(np.array(v, float), vs[keep])
            top = np.lexsort((ids[keep], -s))[:k]
            out[i] = [(int(ids[keep][j]), float(s[j])) for j in top]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = exact(rows)
    got = by_query(A.query(spark, "/root/testdata/sf0.1"))
    assert set(got) == set(want)
    hits = 0
    vec = dict(rows)
    for q, found in got.items():
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        for _, v, s in found:
            assert s == A.cosine(np.array(vec[q], float), np.array([vec[v]], float))[0]
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hits / (5 * len(want)) >= 0.9


def test_bad_vectors_ties_and_repeated_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], None), (2, [3.0, 0.0], 1), (2, [3.0, 0.0], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [nan, 1.0], 1),
            (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (50, [1.0, 1.0, 1.0], 1), (9, [], 1), (100, [0.0, 0.0], 1), (0, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("block", F.lit(2))
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = by_query(A.query(spark, str(tmp_path)))
    assert got == {0: [(1, 1, 1.0), (2, 2, 1.0), (3, 2, 1.0), (4, 8, 0.0)]}


def test_all_rows_are_candidates_when_few(spark, tmp_path):
    spark.createDataFrame([(i, [float(i + 1), 1.0], 0) for i in range(4)], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = by_query(A.search(spark.read.parquet(f"{tmp_path}/embeddings.parquet"), spark.read.parquet(f"{tmp_path}/embeddings.parquet"), share=1.0))
    assert all(len(x) == 3 for x in got.values()) and len(got) == 4


def test_ascent_covers_all_prefixes():
    rng = np.random.default_rng(1)
    vs = rng.standard_normal((300, 8))
    h, o = A.forest(vs, 4, 16, 3)
    h, o = np.frombuffer(h, "<u4").reshape(4, -1), np.frombuffer(o, "<i4").reshape(4, -1)
    strings = A.hash_strings(vs, 4, 16, 3)
    q = A.hash_strings(rng.standard_normal((1, 8)), 4, 16, 3)[:, 0]
    shared = np.max([[32 - int(a ^ b).bit_length() for a in strings[t]] for t, b in enumerate(q)], axis=0)
    shared = np.minimum(shared, 16)
    for least in (1, 20, 150, 300):
        found = A.candidates(A.flat(h), o, q, least, 16)
        level = min(shared[found])
        assert found.sum() >= least and (found == (shared >= level)).all()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert A.query(spark, str(tmp_path)).count() == 0


def test_few_rows_at_the_production_share(spark, tmp_path):
    """Of up to ten rows each query gets k others, or all if fewer."""
    rng = np.random.default_rng(5)
    rows = [(50 * dim + i, rng.standard_normal(dim).tolist(), 0) for dim, n in ((4, 4), (8, 8), (10, 10)) for i in range(n)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = by_query(A.query(spark, str(tmp_path)))
    assert {q: len(x) for q, x in got.items()} == {200: 3, 400: 5, 500: 5}


def test_different_vectors_of_a_query_all_ask(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)], SCHEMA)
    got = by_query(A.search(df, df.where("vec_id = 0"), k=2))
    assert got == {0: [(1, 1, 1.0), (2, 2, 1.0)]}
