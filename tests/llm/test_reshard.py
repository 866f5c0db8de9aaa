import itertools
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from restock.llm import reshard as R
from tests.llm.helpers import DOCUMENTS, SF, docs, put


def check(spark, folder, texts, slack):
    rows = R.query(spark, folder).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sizes = [sum(r.size for r in by[j]) for j in range(8)]
    assert max(sizes) - min(sizes) <= slack, sizes
    return rows


def test_query_on_table(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sizes = [len((r.text or "").encode()) + 1 for r in d]
    total = sum(sizes)
    rows = check(spark, SF, [(r.doc_id, r.text) for r in d], max(sizes))
    old = defaultdict(int)
    for r in rows:
        old[r.old_shard] += r.size
    moved = sum(r.size for r in rows if r.old_shard != r.shard)
    least = sum(max(0, old[i] - total / 8) for i in range(8))
    assert abs(moved - least) < 0.05 * total


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = [(1, "a" * 10, None, None, None)] * 30 + [(None, None, None, "s1", None)] * 7 + [(2, "é" * 50, None, "s2", None), (2, "", None, "s2", None)]
    check(spark, put(spark.createDataFrame(rows, DOCUMENTS), tmp_path), [(r[0], r[1]) for r in rows], 101)


def test_one_long_row(spark, tmp_path):
    texts = ["x" * 200_000] + ["y" * 100] * 50
    rows = check(spark, put(docs(spark, texts), tmp_path), list(enumerate(texts)), 200_001)
    assert len(rows) == 51


def test_empty_table(spark, tmp_path):
    assert R.query(spark, put(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0


def brute(sizes, caps, price):
    """Least cost over all ways to send whole units."""
    best = None
    units = [i for i, s in enumerate(sizes) for _ in range(s)]
    for to in itertools.product(range(len(caps)), repeat=len(units)):
        if all(to.count(j) <= c for j, c in enumerate(caps)):
            cost = sum(price(i, j) for i, j in zip(units, to))
            best = cost if best is None else min(best, cost)
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=3), st.lists(st.integers(0, 4), min_size=1, max_size=3), st.integers(0, 99))
def test_flow_is_cheapest(sizes, caps, seed):
    rng = random.Random(seed)
    table = {(i, j): rng.randint(0, 5) for i in range(3) for j in range(3)}
    price = lambda i, j: table[i, j]
    if sum(caps) < sum(sizes):
        return
    flow = R.min_cost_flow(sizes, caps, price)
    assert [sum(r) for r in flow] == sizes and all(sum(r[j] for r in flow) <= c for j, c in enumerate(caps))
    assert sum(f * price(i, j) for i, r in enumerate(flow) for j, f in enumerate(r)) == brute(sizes, caps, price)


def test_untouched_shards_are_left_alone(spark):
    df = docs(spark, ["a" * 9] * 8).selectExpr("doc_id", "text", "10L as size", "crc32(text) as text_crc32",
                                               "case when doc_id < 4 then 0 when doc_id < 6 then 1 else 2 end as old")
    rows, plan = R.reshard(df, "old", capacities=[40, 30, 10])
    assert plan.moved == 10 and plan.affected == {1, 2}
    new = R.rewritten(rows, plan).collect()
    assert len(new) == 8 and sum(r.shard == 0 and r.old == 0 for r in new) == 4
