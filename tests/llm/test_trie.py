import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from restock.llm import trie as R
from restock.session import session_conf
from tests.llm.helpers import SF, put

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """Rebuilt conversations as lists of (role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn, tie, (role, text)))
    own = {c: [x[3] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, order(x[2])))] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


def order(md5):
    import base64

    return base64.b64encode(md5)


def brute(seqs):
    number, up, words, depth = {}, {0: None}, {0: 0}, {0: 0}  # nodes are numbered, 0 is the root
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in seqs.items():
        members[0].append(c)
        at = 0
        for turn in s:
            above, at = at, number.setdefault((at, turn), len(number) + 1)
            up[at], depth[at], words[at] = above, depth[above] + 1, len(re.findall(r"[^\x20\x09-\x0D]+", turn[1]))
            members[at].append(c)
        ends[at].append(c)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for above, _ in number:
        children[above] += 1
    for node, m in members.items():
        above = node
        while above is not None:
            saved[above] += (len(m) - 1) * words[node]
            leaves[above] += not children[node]
            above = up[above]
    return {(min(m), depth[node], min(members[up[node]]) if node else None, len(m), children[node], leaves[node], saved[node],
             hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, m in members.items()}


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_query_equals_brute_force_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(sequences(rows))
    df = R.query(spark, SF)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for n, t in df.dtypes if n != "ends_sha256"} == {"bigint"}
    assert got(df) == want
    con = duckdb.connect()
    con.execute(f"create view conversations as from '{SF}/conversations.parquet'")
    assert set(con.execute(R.ORACLE).fetchall()) == want


def some(seed):
    """Conversations over few turns, some long, so that paths meet and part often."""
    rng = random.Random(seed)
    out = []
    for c in range(160):
        n = rng.choice([1, 2, 3, 5, 8, 13])
        start = rng.choice([[], ["a b"] * 5, ["a b", "c"] * 4])
        for i, x in enumerate([*start, *(rng.choice(["a b", "c", "d e f"]) for _ in range(n))]):
            out.append((c, i, "user", x))
    return out


@pytest.mark.parametrize("band, limit", [(1, 1), (2, 3), (3, 1), (4, 1000), (1000, 2), (1000, 1000)])
def test_bands_and_bursts_equal_brute_force(spark, band, limit):
    rows = some(band + limit)
    df = R.nodes(R.rebuilt(R.turns(spark.createDataFrame(rows, SCHEMA))), band, limit)
    assert got(df) == brute(sequences(rows))


def test_containers_fit(spark):
    p = R.pieces(R.rebuilt(R.turns(spark.createDataFrame(some(5), SCHEMA))), 6)
    boxes = R.burst(R.suffixes(p), 4)
    sizes = boxes.groupBy("c1", "c2").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 4 and sizes[1] > 10


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 5, "user", "x" * 300_000), (1, 3, "", "tie"), (1, 3, "b", "tie"),
            (2, None, None, None), (None, 1, "user", "nobody"), (-7, 0, "u", "n"), (-40, 0, "u", "m"), (-40, 1, "u", "n"), (9 << 55, 0, "u", "n"),
            (0, 0, "user", "first"), (0, 1, "user", "a\tb\x1fc   d\n")]
    rows += [(c, 0, "user", "first") for c in range(20, 40)] + [(c, 1, "user", "first") for c in range(20, 40)] * 2
    want = brute(sequences(rows))
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(R.query(spark, put(df, tmp_path, "conversations"))) == want
    extra = df.withColumns({n: F.lit(i) for i, n in enumerate(["ids", "words", "k1", "band", "pos", "depth", "N"])})
    assert got(R.query(spark, put(extra, tmp_path, "conversations"))) == want


def test_hot_conversations(spark):
    """Many equal conversations, and one far longer than a band."""
    rows = [(c, i, "u", f"t{i}") for c in range(20_000, 20_900) for i in range(3)] + [(7, i, "u", f"w{i % 9} x") for i in range(3_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(R.nodes(R.rebuilt(R.turns(df)), 100, 50)) == brute(sequences(rows))


def test_turns_of_a_hot_conversation_are_numbered_in_many_runs(spark):
    """One conversation with most rows: ties, null turns and repeats, dealt out to several partitions."""
    rng = random.Random(3)
    rows = [(8, rng.choice([None, 1, 2]), "u", f"t{rng.randrange(400)}") for _ in range(1_000)] + [(8, 1, "u", "again")] * 1_500
    rows += [(c, i, "u", f"t{i}") for c in range(30, 60) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        assert R.sorted_runs(df).where("conv_id = 8").select("run").distinct().count() > 1
        t = R.turns(df)
        assert [r.pos for r in t.where("conv_id = 8").orderBy("pos").collect()] == list(range(1, 2_501))
        assert got(R.nodes(R.rebuilt(t), 100, 50)) == brute(sequences(rows))


def test_empty_table(spark, tmp_path):
    assert R.query(spark, put(spark.createDataFrame([], SCHEMA), tmp_path, "conversations")).count() == 0
