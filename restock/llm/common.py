"""Helpers shared by the operators: staged tables in the shared folder, text
columns read safely, Arrow batches cut into small runs, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.session import session_conf, staging_path

# Shuffle files of a finished write are not read again: release them then, so
# that the disk a job needs is that of its largest step and not of all steps.
RELEASE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                    "spark.sql.shuffleDependency.fileCleanup.enabled": "true"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def releasing(spark: SparkSession):
    with session_conf(spark, RELEASE_SHUFFLES):
        yield


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder (in folders of
    the column ``by``, if given) and read it back: cuts the lineage, and survives
    lost executors."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    schema = df.schema
    with releasing(spark):
        (df.write.partitionBy(by) if by else df.write).option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete a table made by :func:`stage` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:  # whole folders, not the files alone
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(conf).delete(p, True)


def signed(values) -> list[int]:
    """Unsigned 64-bit numbers as the signed ones that Spark's long holds."""
    return [v - (1 << 64) if v >> 63 else v for v in values]


def text_runs(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 1 << 21):
    """Yield (batch, first, last) so that the rows first..last-1 hold about
    ``max_bytes`` of UTF-8 text, or one row if that is longer."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first = total = 0
        for i, n in enumerate(sizes):
            if i > first and total + n > max_bytes:
                yield batch, first, i
                first, total = i, 0
            total += n
        if first < len(sizes):
            yield batch, first, len(sizes)


def utf8(batch: pa.RecordBatch, first: int, last: int, column: str = "text") -> list[bytes]:
    """The texts of some rows as bytes; null as empty."""
    col = batch.column(column).slice(first, last - first)
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def unused_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores until no column of ``df`` has that name
    (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: ``(node, root)`` for every
    node that has an edge to another; the root is the smallest node.

    Alternating large-star and small-star steps. Each step takes the smallest
    neighbour of a node by a partial aggregate and joins it back, so that the
    edges of a hub are spread by Spark's skew join rather than gathered in one
    group. Each round is written to the shared folder."""
    pairs = edges.select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v")).where("u < v").distinct()
    cur = stage(pairs, "cc")
    state = _state(cur)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        nxt = stage(_small_star(_large_star(cur)), "cc")
        new = _state(nxt)
        drop_staged(cur)
        cur, old, state = nxt, state, new
        if new == old:
            break
    else:
        raise RuntimeError("connected components did not settle")
    # now every edge is (root, node)
    return cur.select(F.col("v").alias("node"), F.col("u").alias("root"))


def _state(df: DataFrame):
    r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _both(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(e: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to its smallest neighbour or itself."""
    b = _both(e)
    m = b.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (b.where("v > u").join(m, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest one."""
    low = e.select(F.col("v").alias("n"), F.col("u").alias("w"))
    m = low.groupBy("n").agg(F.min("w").alias("m"))
    out = low.join(m, "n")
    return (out.select(F.col("m").alias("u"), F.col("w").alias("v"))
            .unionByName(m.select(F.col("m").alias("u"), F.col("n").alias("v")))
            .where("u < v").distinct())


class Forest:
    """Union-find over the links of one task; yields a spanning forest."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (p := parent.get(root, root)) != root:
            root = p
        while (p := parent.get(x, x)) != root:
            parent[x] = root
            x = p
        return root

    def link(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def rows(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
