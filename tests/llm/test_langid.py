import zlib

import numpy as np
from pyspark.sql import functions as F

from restock.llm import langid as L
from tests.llm.helpers import DOCUMENTS, SF, docs, put


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = L.query(spark, folder).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id][0] for r in held)
    assert right / len(held) > 0.98, (right, len(held))


def plain_counts(texts):
    out = {}
    for t in texts:
        low = [(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else None for c in t]
        low = [None, *low, None]
        for a, b, c in zip(low, low[1:], low[2:]):
            if b:
                out[a, b, c] = out.get((a, b, c), 0) + 1
    return out


def test_counts_equal_brute_force(spark):
    texts = ["Hello, World! ß", "éé 12 日本", "", None, "ǅa İx", "a" * 30]
    df = docs(spark, texts, lang="x").unionByName(docs(spark, ["skipped"], lang=None))
    code = lambda c: ord(c) if c else 0
    want = {code(a) << 42 | code(b) << 21 | code(c): n for (a, b, c), n in plain_counts([t or "" for t in texts]).items()}
    assert {r.gram: r.n for r in L.gram_counts(df).collect()} == want


def test_filter_has_no_false_negatives_and_corrects_false_positives():
    rng = np.random.default_rng(0)
    f = L.Filter([f"l{i:03}" for i in range(70)], slots=1 << 12)
    own = {i: rng.integers(0, 1 << 62, 600) for i in range(70)}
    for i, g in own.items():
        f.add(i, g)
    for i, g in own.items():
        assert (f.masks(g, i // 64) >> np.uint64(i % 64) & np.uint64(1)).all()
    other = rng.integers(0, 1 << 62, 20000)
    seen = np.mean((f.masks(other, 1) >> np.uint64(3) & np.uint64(1)).astype(float))
    assert abs(seen - f.false_positives()[67]) < 0.01


def test_undetermined_and_ties(spark, tmp_path):
    texts = [None, "", "12 !", "the cat", "der hund", "the cat"]
    df = docs(spark, texts).withColumn("lang", F.when(F.col("text").startswith("der"), "de").otherwise("en"))
    train = df.unionByName(df)
    model = L.train(train)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(df.withColumn("Score", F.lit(1)), model).collect()}
    assert got[0] == got[1] == got[2] == ("und", 0.0)
    assert got[3][0] == got[5][0] == "en" and got[4][0] == "de"
    empty = L.train(train.where("false"))
    assert {r.lang_pred for r in L.predict(df, empty).collect()} == {"und"}


def test_empty_table(spark, tmp_path):
    assert L.query(spark, put(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0


def test_filters_in_parts_give_the_same(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    whole, parts = L.train(df), L.train(df, max_bytes=1 << 14)
    assert whole.parts == 1 and parts.parts > 1 and parts.slots <= 1 << 14
    some = df.union(docs(spark, [None, "", "12", "the the"]).select("doc_id", "text", "lang")).withColumn("Found", F.lit(1))
    a, b = ({(r.doc_id, r.text): r for r in L.predict(some, m).collect()} for m in (whole, parts))
    assert a.keys() == b.keys()
    for k, r in a.items():
        assert r.Found == b[k].Found == 1 and abs(r.score - b[k].score) < 0.02
    assert sum(r.lang_pred == b[k].lang_pred for k, r in a.items()) >= 0.99 * len(a)
    assert len([f for f in parts.filters()]) == parts.parts


def test_rare_trigrams_of_a_large_script_are_learned(spark):
    rng = np.random.default_rng(1)
    script = ["".join(chr(0x4E00 + i) for i in rng.integers(0, 3000, 400)) for _ in range(300)]
    latin = ["the quick brown fox jumps over the lazy dog " * 9] * 300
    model = L.train(docs(spark, script, lang="zz").unionByName(docs(spark, latin, lang="aa")))
    some = docs(spark, [t[100:130] for t in script])
    rows = L.predict(some, model).collect()
    assert all(r.lang_pred == "zz" and r.score > 0.8 for r in rows)


def test_stray_trigrams_stay_with_their_language(spark):
    en, de = ["the house and the garden " * 40] * 50, ["der hund und das haus " * 40] * 50
    model = L.train(docs(spark, [*en, "der hund"], lang="en").unionByName(docs(spark, de, lang="de")))
    (f,) = model.filters()
    grams, _ = L.trigrams(["hund"])
    assert not (f.masks(grams, 0) & np.uint8(1 << model.languages.index("en"))).all()
    assert (f.masks(grams, 0) & np.uint8(1 << model.languages.index("de"))).all()


def test_languages_of_every_width():
    for n in (1, 8, 9, 20, 40, 64, 65, 130):
        f = L.Filter([str(i) for i in range(n)], slots=4096)
        for i in range(n):
            f.add(i, np.array([i + 1]))
        hits = f.hits(np.arange(1, n + 1), np.arange(n), n)
        assert (np.diag(hits) == 1).all() and f.bits.itemsize * len(f.bits) == L._width(n)
