import hashlib
import random

from pyspark.sql import functions as F

from restock.llm import suffix_dedup as S
from tests.llm.helpers import DOCUMENTS, docs, put


def plain(texts):
    """Brute force over all 100-byte strings; texts: list of (id, text)."""
    seen, out = {}, {}
    order = sorted({(S.LAST_ID if i is None else i, hashlib.sha256((t or "").encode()).digest(), (t or "").encode()) for i, t in texts})
    for i, sha, b in order:
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\x01" * 100
            else:
                seen[w] = (i, s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i, sha] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, folder, texts):
    want = plain(texts)
    expect = sorted(str((i, *want[S.LAST_ID if i is None else i, hashlib.sha256((t or "").encode()).digest()])) for i, t in texts)
    got = sorted(str(tuple(r)) for r in S.query(spark, folder).collect())
    assert got == expect


def corpus(seed, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 8)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(60) for _ in range(5)] + ["=" * 150, "ab" * 130, prose(12)]
    out = []
    for _ in range(n):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : a + rng.randint(20, len(p))], prose(rng.randint(0, 30))]
        out.append(rng.choice(["", " "]).join(parts))
    return out + out[3:8] + [out[0][:-1] + "x", out[1] + "tail", "y" + out[2]]


def test_matches_brute_force(spark, tmp_path):
    for seed in (1, 2):
        texts = corpus(seed)
        check(spark, put(docs(spark, texts), tmp_path / str(seed)), list(enumerate(texts)))


def test_crowds_are_settled_alike(spark):
    """Entries with the same selected bytes, resolved in place or by hashes."""
    rng = random.Random(8)
    cores = ["".join(rng.choice("abcdefgh ") for _ in range(70)) for _ in range(2)]
    noise = lambda k: "".join(rng.choice("xyzw") for _ in range(k))
    rows = []
    for rid in range(60):
        left, right = noise(3) + "left side text "[: rng.randint(3, 15)], cores[rid >= 50] + "right side of it"[: rng.randint(5, 16)] + noise(14)
        rows.append((1 if rid < 50 else 2, right.encode(), left.encode(), rid, 50))
    df = spark.createDataFrame(rows, S.SEGMENT)
    covered = []
    for limit in (3, 1000):
        got = set()
        for r in S.shared_strings(df, 60, limit).collect():
            got |= {(r.rid, x) for x in range(r.a, r.b)}
        covered.append(got)
    assert covered[0] == covered[1] and covered[0]


def test_edge_cases(spark, tmp_path):
    long = "z" * 99
    texts = ["", None, long, long, long + "z", "a" * 5000, "a" * 100, "a" * 99, "é" * 60, "xé" + "é" * 60, "", "q" * 100, "q" * 100]
    rows = list(enumerate(texts))
    rows += [(3, long + "w" * 120), (3, long + "w" * 120), (None, "a" * 101), (None, "k" * 130), (20, "k" * 130)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
    check(spark, put(df, tmp_path), rows)


def test_one_long_text_is_scanned_in_chunks(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    t = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    texts = [t + t[100:700] + "u" + t[8000:], t[4000:4500], "v" + t[2040:2200]]
    want = plain(list(enumerate(texts)))
    # tasks read the module by name, so a smaller chunk is tried on the function itself
    import numpy as np
    b = t.encode()
    whole = S.select(b, np.array([0, len(b)]), 100, 32)
    assert len(whole[0]) and (whole[1] <= whole[2]).all() and (whole[2] <= whole[3] + 68).all()
    check(spark, put(docs(spark, texts), tmp_path), list(enumerate(texts)))
    assert want


def test_pipeline_stage_cuts_passages(spark):
    p = " ".join(f"passage{i}" for i in range(30))
    texts = ["one " + p + " two", "é" + p, "three", None, "", "one " + p + " two"]
    df = docs(spark, texts).withColumn("sha", F.lit(1)).withColumn("ranges", F.lit(2)).withColumn("rid", F.lit(3))
    out = S.stage_repeats(spark, df, "").orderBy("doc_id").collect()
    assert [r.text for r in out] == [texts[0], "é", "three", None, "", ""]
    assert out[1].n_chars == 1 and out[3].n_chars is None and list(out[0].asDict()) == df.columns


def test_empty_table(spark, tmp_path):
    assert S.query(spark, put(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0


def test_hot_passage_and_repeated_rows(spark, tmp_path):
    """A passage that many documents share, at different places, over many tasks,
    and one document repeated in all of them."""
    rng = random.Random(9)
    noise = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    hot, again = noise(260), noise(400)
    rows = [(i, noise(rng.randint(0, 40)) + hot + noise(rng.randint(0, 150))) for i in range(150)] + [(7000, again)] * 40 + [(7001, "x" + again)] * 3
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS).repartition(12)
    check(spark, put(df, tmp_path), rows)
    made = []
    verdict = S.repeats(df.select("doc_id", "text"), "doc_id", "text", made)
    assert verdict.where("ranges is not null").count() == 150
    segments = [x for x in made if "left" in x.columns and "batch" in x.columns]
    marked = segments[0].where("suffix is null").count()
    assert marked > segments[0].count() / 4  # settled before the shuffle


def test_frequent_grams_are_spread(spark):
    """All but a few rows of a frequent gram pass without meeting the others."""
    texts = spark.createDataFrame([(i, "shared beginning of all, " * 6 + f"own {i} ending " * 9) for i in range(400)], "rid long, text string").coalesce(2)
    found = S.entries(texts, 100, 32)
    of = lambda kind: F.count_if(F.col("kind") == kind)
    hot = found.groupBy("gram").agg(of(S.SEVERAL).alias("several"), of(S.WITNESS).alias("met"), of(S.SINGLE).alias("single")).orderBy(F.desc("several")).first()
    assert hot.several >= 390 and hot.met + hot.single <= 10
    kept = S.recurring(found).where(F.col("kind") != S.AGAIN).select("gram", "rid", "p").collect()
    counts = {}
    for r in found.where(~F.col("kind").isin(S.AGAIN, S.WITNESS)).collect():
        counts.setdefault(r.gram, []).append((r.gram, r.rid, r.p))
    assert sorted(map(tuple, kept)) == sorted(x for own in counts.values() if len(own) > 1 for x in own)
