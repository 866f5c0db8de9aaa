"""Resharding by minimum-cost flow.

Old shards have sizes, new shards capacities. A minimum-cost flow over (old
shard -> new shard), where a byte that stays costs nothing and a moved byte its
price, says how many bytes go from where to where. Old shards are blocks (size
class and hash, so that no shard, source or group of copies makes a large one);
block sums, a number bounded by parameters, are all that the driver sees. The
transfers become intervals of each shard's byte order, large rows first, so
cuts fall among small rows; whole blocks lie in one interval but for those at a
cut, whose rows are placed by a running sum within the block. Shards that
neither give nor receive are left alone, the others are rewritten.

The law of the query is ``bytes``: capacities are equal, and shards differ by
the rows at the cuts at most. The old layout is by source (null: empty), which
is as uneven as the sources. Size: UTF-8 bytes (null: none) plus 1. Repeated
rows are placed each for itself; null ids come first in their block.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from restock.llm.common import stage, table

SHARDS = 8
SPLIT = 64  # blocks of each size class of a shard


def min_cost_flow(sizes: list[int], capacities: list[int], cost=None) -> list[list[int]]:
    """``flow[i][j]`` bytes from old shard i to new shard j at least cost:
    successive shortest paths in the residual graph. ``cost(i, j)``: price of a
    byte, by default 0 if the shard stays the same and 1 otherwise."""
    if sum(capacities) < sum(sizes):
        raise ValueError("the capacities do not hold the shards")
    price = cost or (lambda i, j: int(i != j))
    n, m = len(sizes), len(capacities)
    flow = [[0] * m for _ in range(n)]
    left, room = list(sizes), list(capacities)
    while any(left):
        # nodes: old shards 0..n-1, new shards n..n+m-1; start at old shards with bytes left
        dist = [0 if i < n and left[i] else float("inf") for i in range(n + m)]
        back: list[int | None] = [None] * (n + m)
        todo, queued = deque(i for i in range(n) if left[i]), set(i for i in range(n) if left[i])
        while todo:
            u = todo.popleft()
            queued.discard(u)
            if u < n:
                steps = [(n + j, price(u, j)) for j in range(m)]
            else:
                steps = [(i, -price(i, u - n)) for i in range(n) if flow[i][u - n]]
            for v, c in steps:
                if dist[u] + c < dist[v]:
                    dist[v], back[v] = dist[u] + c, u
                    if v not in queued:
                        todo.append(v)
                        queued.add(v)
        end = min((n + j for j in range(m) if room[j]), key=lambda v: (dist[v], v))
        path = [end]
        while back[path[-1]] is not None:
            path.append(back[path[-1]])
        path.reverse()
        amount = min([left[path[0]], room[end - n], *(flow[v][u - n] for u, v in zip(path, path[1:]) if u >= n)])
        for u, v in zip(path, path[1:]):
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


@dataclass
class Plan:
    flow: list[list[int]]
    moved: int
    affected: set[int]


def reshard(df: DataFrame, old: str, capacities=None, shards: int = SHARDS, size: str = "size", key: str = "doc_id",
            crc: str = "text_crc32", split: int = SPLIT, cost=None) -> tuple[DataFrame, Plan]:
    """Rows of ``df`` (with columns ``size`` and ``crc``, and the old shard
    0..n-1 in ``old``) with ``shard int`` and ``slot long``, and the plan.
    Capacities default to equal shares of all bytes."""
    klass = (-F.floor(F.log2(F.col(size).cast("double")))).cast("int")
    sub = F.pmod(F.xxhash64(key, crc), F.lit(split)).cast("int")
    rows_ = df.withColumns({"class__": klass, "sub__": sub})
    block = [old, "class__", "sub__"]
    sums = {(r[0], r[1], r[2]): (r[3], r[4]) for r in rows_.groupBy(*block).agg(F.sum(size), F.count("*")).collect()}
    total = sum(s for s, _ in sums.values())
    if capacities is None:
        capacities = [total // shards + (j < total % shards) for j in range(shards)]
    n_old = max([k[0] for k in sums], default=0) + 1
    sizes = [sum(s for k, (s, _) in sums.items() if k[0] == i) for i in range(n_old)]
    flow = min_cost_flow(sizes, list(capacities), cost)
    moved = sum(f for i, row in enumerate(flow) for j, f in enumerate(row) if i != j)
    affected = {j for j in range(len(capacities)) if any(row[j] for i, row in enumerate(flow) if i != j)
                or (j < n_old and flow[j][j] != sizes[j])}

    # intervals of each old shard's byte order: what stays comes first
    cuts: dict[int, list[tuple[int, int]]] = {}
    for i, row in enumerate(flow):
        at, own = 0, []
        for j in sorted(range(len(row)), key=lambda j: (j != i, j)):
            if row[j]:
                at += row[j]
                own.append((at, j))
        cuts[i] = own
    starts, at = {}, [0] * n_old
    for k in sorted(sums):
        starts[k] = at[k[0]]
        at[k[0]] += sums[k][0]
    spec = "class__ int, sub__ int, old__ int, start__ long, cuts__ array<struct<upto:long,shard:int>>"
    spark = df.sparkSession
    where = spark.createDataFrame([(c, s, i, starts[i, c, s], cuts[i]) for i, c, s in sums], spec)

    def placed(some: DataFrame) -> DataFrame:
        # the block table is bounded: old shards x size classes (64 at most) x split
        on = [some["class__"] == where["class__"], some["sub__"] == where["sub__"], some[old] == where["old__"]]
        j = some.join(F.broadcast(where), on).drop(where["class__"], where["sub__"], "old__")
        order = Window.partitionBy(*block).orderBy(key, crc, size)
        before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        mid = F.col("start__") + before + F.floor(F.col(size) / 2)
        hit = F.filter("cuts__", lambda x: x["upto"] > mid)
        return j.withColumn("shard", F.coalesce(F.get(hit, F.lit(0))["shard"], F.element_at("cuts__", -1)["shard"]))

    cut_blocks = {k for k in sums if any(starts[k] < c < starts[k] + sums[k][0] for c, _ in cuts[k[0]])}
    counts = {}
    if cut_blocks:
        some = spark.createDataFrame(sorted(cut_blocks), "o__ int, c__ int, s__ int")
        light = rows_.select(old, "class__", "sub__", size, key, crc).join(
            F.broadcast(some), (F.col(old) == F.col("o__")) & (F.col("class__") == F.col("c__")) & (F.col("sub__") == F.col("s__")), "left_semi")
        counts = {(r[0], r[1], r[2], r[3]): r[4] for r in placed(light).groupBy(*block, "shard").count().collect()}
    for k in sums.keys() - cut_blocks:
        counts[(*k, next((j for c, j in cuts[k[0]] if c > starts[k]), cuts[k[0]][-1][1]))] = sums[k][1]
    slot, offsets = [0] * len(capacities), []
    for k in sorted(counts):
        offsets.append((*k, slot[k[3]]))
        slot[k[3]] += counts[k]
    base = spark.createDataFrame(offsets, "o__ int, c__ int, s__ int, j__ int, base__ long")
    p = placed(rows_)
    p = p.withColumn("row__", F.row_number().over(Window.partitionBy(*block, "shard").orderBy(key, crc, size)))
    p = p.join(F.broadcast(base), (p[old] == F.col("o__")) & (p["class__"] == F.col("c__")) & (p["sub__"] == F.col("s__"))
               & (p["shard"] == F.col("j__")))
    out = p.select(*[F.col(f"`{c}`") for c in df.columns], "shard", (F.col("base__") + F.col("row__") - 1).alias("slot"))
    return out, Plan(flow, moved, affected)


def rewritten(rows_: DataFrame, plan: Plan, name: str = "shards") -> DataFrame:
    """Writes the affected shards (one folder each, below the shared folder) and
    returns their rows from there, with those of the shards left alone."""
    affected = F.col("shard").isin(sorted(plan.affected))
    spark = rows_.sparkSession
    from restock.llm.common import releasing
    from restock.session import staging_path

    path = staging_path(spark, name)
    with releasing(spark):
        rows_.where(affected).write.partitionBy("shard").parquet(path)
    out = spark.read.schema(rows_.schema).parquet(path) if plan.affected else rows_.where("false")
    alone = {j for j in range(len(plan.flow[0]))} - plan.affected if plan.flow else set()
    return out.unionByName(rows_.where(~affected)) if alone else out


def documents_by_source(spark, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return d.select("doc_id", "text", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                    F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
                    F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit(""))), F.lit(SHARDS)).cast("int").alias("old_shard"))


def query(spark, sf_dir: str) -> DataFrame:
    """``documents`` moved from shards by source to 8 equal ones; the rows are
    read back from the rewritten shards."""
    rows_, plan = reshard(documents_by_source(spark, sf_dir), "old_shard")
    new = rewritten(rows_, plan)
    return new.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                      F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "old_shard")
