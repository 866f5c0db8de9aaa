"""Exact top-k by integer inner product with a three-phase uniform threshold.

A node is a slice of the dimensions of a block of vectors; its score of a vector
is the inner product over its slice, and a vector's score the sum over the
``nodes`` slices of its block.

1. Every node lists its ``k`` best vectors for each query; the scores of the
   listed vectors are completed, and the k-th best of all blocks' completed
   scores is a safe cutoff: at least k vectors reach it.
2. The cutoff is sent with the queries. A vector whose score reaches it has a
   node's score of at least the cutoff divided by ``nodes``, so the nodes
   collect the entries that reach that, and no other vector can matter.
3. The remaining scores of the collected entries are resolved exactly; of those
   that reach the cutoff, the best k of each block, then of all, remain.

Components are floor(256 x). Sums are exact: in doubles while they stay below
2**53, else in whole numbers without pruning; a score beyond a long is cut to
the nearest long. Vectors that are null or hold null or non-finite components
take no part, nor do rows without an id or component; zero vectors do. A query's
own row, by id, is no candidate; repeated rows of another id are one candidate
each; ties go to the smaller id. Each different vector (of whole components) of a
query's id asks, and the best of what all of them find remain. Vectors of different lengths are compared with
those of the query's length only.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from restock.llm.ann import EVERY, QUERIES, best, blocks, every_pair, ranked, usable
from restock.llm.common import stage, table

NODES = 4
BLOCK = 8192
K = 5
NONE = -(2.0**62)  # cutoff of a query with fewer than k vectors


def whole(x: np.ndarray) -> np.ndarray:
    """floor(256 x), as doubles if they are exact, else as Python numbers."""
    y = np.floor(x * 256)
    if not len(y) or np.abs(y).max() < 2**53:
        return y
    return np.array([[math.floor(256 * Fraction(v)) for v in row] for row in x.tolist()], object)


def node_scores(qs: np.ndarray, vs: np.ndarray, nodes: int) -> list[np.ndarray]:
    """Scores of each node: queries x vectors."""
    exact = qs.dtype != object and vs.dtype != object and np.abs(qs).max() * np.abs(vs).max() * qs.shape[1] < 2**53
    if not exact:
        qs, vs = (x if x.dtype == object else np.array([[int(v) for v in r] for r in x.tolist()], object) for x in (qs, vs))
    cuts = np.linspace(0, qs.shape[1], min(nodes, qs.shape[1]) + 1).astype(int)
    return [qs[:, a:b] @ vs[:, a:b].T for a, b in zip(cuts, cuts[1:])]


def _pairs(batches, names):
    for b in batches:
        for dim, ids, vs, q_ids, q_vs, *more in zip(*(b.column(c).to_pylist() for c in ("dim", "ids", "vs", "q_ids", "q_vs", *names))):
            ids, qi = np.frombuffer(ids, "<i8"), np.frombuffer(q_ids, "<i8")
            vs, qs = np.frombuffer(vs, "<f8").reshape(len(ids), -1), np.frombuffer(q_vs, "<f8").reshape(len(qi), -1)
            yield ids, whole(vs), qi, whole(qs[:, :dim]), qs[:, dim:]


def _long(x):
    return max(-(1 << 63), min((1 << 63) - 1, int(x)))


def _within(total):
    """Scores that fit a long; doubles are exact here and do."""
    return np.clip(total, -(1 << 63), (1 << 63) - 1) if total.dtype == object else total


def _batch(out, last):
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())],
                                      ["query_id", "vec_id", last])


def search(df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, nodes: int = NODES,
           block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's best rows of ``df``."""
    index = stage(blocks(usable(df, key, vector, zero=True), block), "vectors")
    floored = F.transform("v", lambda x: F.when(F.abs(x) < 2.0**45, F.floor(x * 256).cast("double") / 256).otherwise(x))
    asked = stage(usable(queries, key, vector, zero=True).withColumn("v", floored).dropDuplicates(["id", "v"]), "asked")

    def lists(batches):
        for ids, vs, qi, qs, _ in _pairs(batches, ()):
            part = node_scores(qs, vs, nodes)
            total = _within(sum(part))
            out: list[list] = [[], [], []]
            for i, q in enumerate(qi):
                other = np.flatnonzero(ids != q)
                listed = set()
                for p in part:
                    listed.update(other[best(ids[other], p[i][other], k)].tolist())
                own = np.array(sorted(listed), np.int64)
                top = own[best(ids[own], total[i][own], k)]
                out[0] += [int(q)] * len(top)
                out[1] += ids[top].tolist()
                out[2] += [_long(x) for x in total[i][top]]
            yield _batch(out, "score")

    first = every_pair(index, stage(blocks(asked, QUERIES), "queries")).mapInArrow(lists, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    cutoff = (first.withColumn("n", F.row_number().over(order)).where(F.col("n") == k)
              .select("query_id", F.col("score").cast("double").alias("cutoff")))
    sent = asked.join(cutoff, F.col("id") == F.col("query_id"), "left").select(
        "id", F.concat("v", F.array(F.coalesce("cutoff", F.lit(NONE)))).alias("v"), "dim")
    sent = stage(blocks(sent, QUERIES), "queries-cutoff")

    def resolve(batches):
        for ids, vs, qi, qs, cut in _pairs(batches, ()):
            part = node_scores(qs, vs, nodes)
            out: list[list] = [[], [], []]
            for i, q in enumerate(qi):
                least = cut[i, 0] if part[0].dtype != object else None  # beyond exact doubles all entries are collected
                entries = ids != q
                if least is not None:
                    some = np.zeros(len(ids), bool)
                    for p in part:
                        some |= p[i] * len(part) >= least
                    entries &= some
                own = np.flatnonzero(entries)
                total = _within(sum(p[i][own] for p in part))
                if least is not None:
                    own, total = own[total >= least], total[total >= least]
                top = best(ids[own], total, k)
                out[0] += [int(q)] * len(top)
                out[1] += ids[own][top].tolist()
                out[2] += [_long(x) for x in total[top]]
            yield _batch(out, "score")

    found = every_pair(index, sent).mapInArrow(resolve, "query_id long, vec_id long, score long")
    return ranked(found, k)


def query(spark, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return search(e, e.where(F.col("vec_id") % EVERY == 0))


# the same by comparing every query with every row
ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id AS query_id, e AS qe FROM v WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id, CAST(list_sum(list_transform(list_zip(qe, e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM q JOIN v ON vec_id <> query_id AND len(qe) = len(e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
