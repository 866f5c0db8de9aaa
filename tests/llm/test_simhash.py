import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from restock.llm import simhash as S
from restock.llm.common import components
from tests.llm.helpers import DOCUMENTS, SF, docs, put

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(text)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))


def plain_groups(fps):
    """fps: {id: fingerprint}; smallest id reachable, by comparing all pairs."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x in ids:
        for y in ids:
            if x < y and (fps[x] ^ fps[y]).bit_count() <= 2:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def check(spark, folder, texts):
    got = {r.doc_id: r for r in S.query(spark, folder).collect()}
    want = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in want.items()}
    assert {i: r.component_id for i, r in got.items()} == plain_groups(want)


def test_query_matches_brute_force(spark):
    check(spark, SF, {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()})


def test_odd_texts(spark, tmp_path):
    texts = ["", None, "one", "One  two", "a b c", "A\tb\x0bc", " ", "x\x1cy z w", "Éa b c d", "q " * 5000, "", "a b c"]
    check(spark, put(docs(spark, texts), tmp_path), dict(enumerate(texts)))


def test_long_text_in_blocks():
    rng = random.Random(3)
    t = " ".join(rng.choice(["ab", "CD", "efg"]) for _ in range(900_000))
    w = t.lower().split()
    hs = np.array([xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(len(w) - 2)], np.uint64)
    want = sum(1 << j for j in range(64) if 2 * int((hs >> np.uint64(j) & np.uint64(1)).sum()) > len(hs))
    assert S.fingerprint(t.encode()) == want


def test_every_link_is_found(spark):
    """Random fingerprints with planted chains and a crowd around one word."""
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:
        for _ in range(3):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 2)))
            fps.add(f)
    crowd = rng.getrandbits(64)
    fps |= {crowd ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(400)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.root for r in components(S.links(df)).collect()}
    want = plain_groups({s: s % (1 << 64) for s in signed})
    assert {f: got.get(f, f) for f in signed} == want


def test_many_homes_lookup_equals_comparison(monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(-2**62, 2**62, 40)
    fps = np.unique(np.concatenate([base, base ^ 1, base ^ (1 << 50) ^ 4, base ^ 7]))
    out = {}
    for many in (10**6, 1):
        monkeypatch.setattr(S, "MANY_HOMES", many)
        forest, edges = S.Forest(), []
        S.compare(fps, fps, 2, forest, edges)
        out[many] = {int(f): forest.find(int(f)) for f in fps}
    assert out[1] == out[10**6]


def test_pipeline_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"word{i}" for i in range(400))
    texts = [text, text, text.upper(), "other words entirely here", "", None, "other  words entirely here"]
    df = docs(spark, texts).withColumn("fp", F.lit(1)).withColumn("ROW_KEY", F.lit(2))
    df = df.unionByName(df.where("doc_id = 3")).unionByName(df.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    out = S.stage_near_dedup(spark, df, "").collect()
    assert sorted(r.doc_id for r in out) == [0, 3, 4]
    assert list(out[0].asDict()) == df.columns


def test_empty_table(spark, tmp_path):
    assert S.query(spark, put(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0
