import pytest
from pyspark.sql import functions as F

from restock.llm import quality as Q
from tests.llm.helpers import DOCUMENTS, docs, put

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    """Half of the labels train, the other half judges."""
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    model = Q.train(d, labels.where(half))
    judged = Q.score(d, model, ("a", "b", "s")).join(labels.where(~half), "doc_id").select("s", "quality").collect()
    good = [r.s >= Q.KEEP for r in judged if r.quality == 1]
    bad = [r.s < Q.KEEP for r in judged if r.quality == 0]
    assert sum(good) / len(good) > 0.985, sum(good) / len(good)
    assert sum(bad) / len(bad) > 0.85, sum(bad) / len(bad)


def test_query_scores_every_row_and_odd_rows(spark, tmp_path):
    texts = (["plain words of some length here and there, again."] * 30 + ["BUY!! NOW!! BUY!! NOW!!"] * 30 + ["", None, "x" * 100_000, " \n "])
    df = docs(spark, texts)
    df = df.unionByName(df.limit(2)).unionByName(df.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENTS]))
    put(df, tmp_path)
    labels = [(i, int(i < 30), 0) for i in range(60)] + [(0, None, 1), (None, 1, 1), (3, 0, 0), (3, 1, 0), (999, 1, 0)]
    put(spark.createDataFrame(labels, LABELS), tmp_path, "labels")
    rows = Q.query(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 3 and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r.keep for r in rows}
    assert all(got[i] for i in range(30)) and not any(got[i] for i in range(30, 60))


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (1, 1, 0)], [(0, None, 0)]])
def test_without_two_classes_nothing_is_rejected(spark, tmp_path, labels):
    put(spark.createDataFrame(labels, LABELS), tmp_path, "labels")
    df = docs(spark, ["a", "b"]).withColumn("view_t", F.lit(1)).withColumn("y", F.lit(2))
    out = Q.stage_quality(spark, df, str(tmp_path))
    assert out.count() == 2 and out.columns == df.columns


def test_empty_table(spark, tmp_path):
    put(spark.createDataFrame([], DOCUMENTS), tmp_path)
    put(spark.createDataFrame([], LABELS), tmp_path, "labels")
    assert Q.query(spark, str(tmp_path)).count() == 0


def test_all_confident_documents_of_the_pool_are_fitted(spark, monkeypatch):
    """More unlabelled documents than any bound, each plainly good or bad."""
    n = 24_000
    good = F.col("doc_id") % 2 == 0
    d = spark.range(n).select(F.col("id").alias("doc_id")).select(
        "doc_id", F.when(good, F.lit("plain words of some length here and there, again.")).otherwise(F.lit("BUY!! NOW!! BUY!! NOW!!")).alias("text"),
        F.lit("en").alias("lang"), F.when(good, F.lit("a")).otherwise(F.lit("b")).alias("source"), F.lit(30).cast("long").alias("n_chars"))
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(200)], LABELS)
    told, fit = [], Q._fit

    def counting(train, view):
        told.append(train.where("w < 1").count())
        return fit(train, view)

    monkeypatch.setattr(Q, "_fit", counting)
    Q.train(d, labels, rounds=2)
    assert max(told) == n - 200


def rare(spark, n_good, n_bad):
    """Documents and labels; the bad ones come last."""
    texts = ["plain words of some length here and there, again."] * n_good + ["BUY!! NOW!! BUY!! NOW!!"] * n_bad
    return docs(spark, texts), spark.createDataFrame([(i, int(i < n_good), 0) for i in range(len(texts))], LABELS)


@pytest.mark.parametrize("n_bad", [1, 2, 3])
def test_a_rare_class_is_learned(spark, n_bad):
    d, labels = rare(spark, 400, n_bad)
    model = Q.train(d, labels, rounds=1, max_labelled=50)
    assert model.prior == 400 / (400 + n_bad)
    got = {r.doc_id: r.s for r in Q.score(d, model, ("a", "b", "s")).select("doc_id", "s").collect()}
    assert max(got[400 + i] for i in range(n_bad)) < min(got[i] for i in range(400))


def test_with_bad_labels_only_all_is_kept(spark, tmp_path):
    d, labels = rare(spark, 0, 12)
    put(d, tmp_path)
    put(labels, tmp_path, "labels")
    assert Q.stage_quality(spark, d, str(tmp_path)).count() == 12
    assert all(r.keep for r in Q.query(spark, str(tmp_path)).collect())


def test_each_source_and_language_counts_for_itself(spark):
    """Texts are alike; every other one of 200 sources is bad, and of 'es' and 'de' one."""
    rows = [(i, "some words", "es" if i % 2 else "de", f"host{i % 200}", 10) for i in range(1200)]
    d = spark.createDataFrame(rows, DOCUMENTS)
    for good in (lambda i: i % 200 // 2 % 2 == 0, lambda i: i % 2 == 0):
        labels = spark.createDataFrame([(i, int(good(i)), 0) for i in range(1000)], LABELS)
        model = Q.train(d, labels, rounds=1)
        got = {r.doc_id: r.b for r in Q.score(d, model, ("a", "b", "s")).select("doc_id", "b").collect()}
        assert all((got[i] > 0.5) == good(i) for i in range(1000, 1200))
