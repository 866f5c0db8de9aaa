"""Quality classifier by co-training.

Two views of a document: its text content (statistics of the whole text: lengths,
repetition of words and lines, character classes and pairs of them) and its
metadata (source, language, stated length); every source and language of the
documents that take part is a value of its own, and one not seen there has weight 0.
Each view has a logistic classifier.
They start from the labelled documents; in each round, each view's classifier
labels the pool, all unlabelled documents, and those it is confident of
(calibrated probability beyond ``sure`` either way) are all training data of the
*other* view's classifier in the next round. A part of the labelled documents is
kept back to calibrate both views (Platt scaling) and never trained on; the
calibrated log-odds of the views add up, less the prior's, to the score of all
documents. A document is kept if its probability of good quality is a half or
more.

Of the labelled documents, ``max_labelled`` are used: half of each class, or more
where the other class has less, those with the smallest hash of the id, weighted
so that each class counts as it does among all labels. Every fifth of a class in
the order of the hash calibrates, the second first; a class of one document only
trains, and then the views stay uncalibrated. The pool has no bound. The views of both are staged once, and fits
are distributed over them. Scoring is one pass over all documents with the fitted
weights: some hundred numbers, and one for each source and language, which the
driver and the executors hold.

A null text is empty; null metadata are values of their own. Documents labelled
more than once take the mean, ties are good; null labels and ids don't train.
Without two classes among the labels, nothing can be learned: every document gets
the share of good ones (1 without labels), and all are kept.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.llm.common import drop_staged, stage, table, text_runs, unused_name, utf8

if TYPE_CHECKING:
    from pyspark.ml.classification import LogisticRegressionModel

MAX_LABELLED = 20_000
ROUNDS = 3
SURE = 0.98
KEEP = 0.5
FIT_TASKS = 6
FIT, HELD, POOL, SPARE = range(4)  # parts of the documents: fitted, calibrating, unlabelled, labelled beyond the bound
BINS = 10


def _classes() -> np.ndarray:
    """Byte -> class: lower, upper, digit, blank, line end, full stop or comma,
    exclamation or question, other signs, beyond ASCII, control."""
    out = np.full(256, 9)
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:'\"()-", "!?")):
        out[[ord(c) for c in chars]] = k
    out[[c for c in range(33, 127) if out[c] == 9]] = 7
    out[128:] = 8
    return out


CLASSES = _classes()
N_TEXT = 9 + 10 + 100


def text_features(t: bytes) -> np.ndarray:
    out = np.zeros(N_TEXT)
    w, lines = t.split(), t.split(b"\n")
    n, nw = len(t), len(w)
    if not nw:
        return out
    chunks = [w[i : i + 64] for i in range(0, nw, 64)]
    distinct = sum(len(set(c)) for c in chunks) / nw
    again = sum(map(operator.eq, w, w[1:])) / nw
    out[:9] = (math.log1p(n), math.log1p(nw), n / nw, distinct, distinct**2, again, math.sqrt(again), len(set(lines)) / len(lines), len(lines) / nw)
    c = CLASSES[np.frombuffer(t, np.uint8)]
    out[9:19] = np.bincount(c, minlength=10) / n
    out[19:] = np.sqrt(np.bincount(c[:-1] * 10 + c[1:], minlength=100) / n)
    return out


def with_text_view(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the text view as an array of doubles."""
    columns = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(batches):
        for batch, a, b in text_runs(batches):
            x = np.array([text_features(x) for x in utf8(batch, a, b)]).reshape(b - a, -1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, lists], [*columns, name])

    return df.mapInArrow(run, f"{schema}, `{name}` array<double>")


def size() -> Column:
    return F.log1p(F.greatest(F.lit(0), F.coalesce("n_chars", F.lit(0))).cast("double"))


def values() -> Column:
    """The values of the metadata view; the first letter tells their kind."""
    value = lambda kind, c: F.coalesce(F.concat(F.lit(kind), F.col(c).cast("string")), F.lit(kind.upper()))
    length = F.when(F.col("n_chars").isNull(), "N").otherwise(F.concat(F.lit("n"), F.least(F.lit(BINS - 1), size().cast("int")).cast("string")))
    return F.array(value("s", "source"), value("l", "lang"), length)


def with_meta_view(df: DataFrame, vocabulary: list[str], name: str) -> DataFrame:
    """``df`` with the metadata view as a sparse vector: the values, then the size."""
    from pyspark.ml.feature import CountVectorizerModel, VectorAssembler

    columns = [F.col(f"`{c}`") for c in df.columns]
    some, ones, long_ = (unused_name(df, f"{name}_{x}") for x in ("values", "ones", "size"))
    counted = CountVectorizerModel.from_vocabulary(vocabulary, some, ones, minTF=1.0, binary=True)
    joined = VectorAssembler(inputCols=[ones, long_], outputCol=name)
    return joined.transform(counted.transform(df.withColumn(some, values()).withColumn(long_, size()))).select(*columns, name)


@dataclass
class Linear:
    """A logistic classifier of a view, and its calibration."""

    fitted: LogisticRegressionModel
    a: float = 1.0
    b: float = 0.0

    def logit(self, df: DataFrame, view: str, out: str) -> DataFrame:
        """``df`` with the calibrated log-odds as ``out``."""
        from pyspark.ml.functions import vector_to_array

        raw = unused_name(df, f"{out}_raw")
        scorer = self.fitted.copy().setFeaturesCol(view).setRawPredictionCol(raw).setProbabilityCol("").setPredictionCol("")
        columns = [F.col(f"`{c}`") for c in df.columns]
        return scorer.transform(df).select(*columns, (vector_to_array(raw)[1] * self.a + self.b).alias(out))


@dataclass
class Model:
    text: Linear | None
    meta: Linear | None
    prior: float
    vocabulary: list[str]

    @property
    def learned(self) -> bool:
        return self.text is not None and self.meta is not None

    def keep(self, score: str) -> Column:
        return F.col(score) >= KEEP if self.learned else F.lit(True)

    def scores(self, a: str, b: str) -> tuple[Column, Column, Column]:
        """Probabilities of good quality by the log-odds of text and metadata: by
        text, by metadata, together."""
        sigmoid = lambda z: F.lit(1.0) / (F.exp(-z) + 1.0)
        a, b = F.col(a), F.col(b)
        return sigmoid(a), sigmoid(b), sigmoid(a + b - F.lit(math.log(self.prior / (1 - self.prior))))


def _fit(train: DataFrame, view: str) -> Linear:
    from pyspark.ml.classification import LogisticRegression

    data = train.select(F.col(view).alias("features"), F.col("y").cast("double").alias("label"), F.col("w").cast("double").alias("w"))
    return Linear(LogisticRegression(maxIter=30, regParam=1e-3, weightCol="w").fit(data))


def _calibrated(linear: Linear, held: DataFrame, view: str) -> Linear:
    from pyspark.ml.functions import array_to_vector

    one = linear.logit(held, view, "z").withColumn("z", array_to_vector(F.array("z")))
    platt = _fit(one, "z").fitted
    linear.a, linear.b = max(float(platt.coefficients[0]), 1e-3), float(platt.intercept)
    return linear


def labelled_sample(y: DataFrame, max_labelled: int) -> tuple[list[tuple], dict[int, int]]:
    """``(doc_id, part, weight)`` of the sample of ``y``, and the labelled
    documents of each class."""
    counts = {r.y: r.n for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    out = []
    for c, n in counts.items():
        take = min(n, max(max_labelled // 2, max_labelled - counts.get(1 - c, 0)))
        ids = y.where(F.col("y") == c).orderBy(F.xxhash64(F.col("doc_id"), F.lit("quality"))).limit(take).select("doc_id").collect()
        out += [(r.doc_id, HELD if k % 5 == 1 else FIT, n / take) for k, r in enumerate(ids)]
    return out, counts


def views(docs: DataFrame, y: DataFrame, sample: list[tuple]) -> DataFrame:
    """The text view ``t`` and the metadata of all unlabelled documents and of the
    sample of the others, staged by ``part``; ``y`` and ``w`` are null in the pool."""
    kind = y.schema["doc_id"].dataType.simpleString()
    some = y.sparkSession.createDataFrame(sample, f"doc_id {kind}, part int, w double")
    told = y.join(F.broadcast(some), "doc_id", "left").withColumn("part", F.coalesce("part", F.lit(SPARE)))
    viewed = with_text_view(docs.where("doc_id is not null").select("doc_id", "text", "source", "lang", "n_chars"), "t")
    small = viewed.drop("text").withColumn("t", F.col("t").cast("array<float>"))
    parts = small.join(told, "doc_id", "left").withColumn("part", F.coalesce("part", F.lit(POOL))).where(F.col("part") != SPARE)
    return stage(parts.drop("doc_id"), "quality-views", "part")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rounds: int = ROUNDS, sure: float = SURE,
          max_labelled: int = MAX_LABELLED) -> Model:
    from pyspark.ml.functions import array_to_vector

    y = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    y = stage(y.join(docs.select("doc_id"), "doc_id", "left_semi"), "quality-labels")
    sample, counts = labelled_sample(y, max_labelled)
    good, total = counts.get(1, 0), sum(counts.values())
    prior = good / total if total else 1.0
    if not 0 < good < total:
        drop_staged(y)
        return Model(None, None, prior, [])
    staged = views(docs, y, sample)
    drop_staged(y)
    vocabulary = sorted(r.v for r in staged.select(F.explode(values()).alias("v")).distinct().collect())
    data = with_meta_view(staged.withColumn("t", array_to_vector("t")), vocabulary, "m").select("y", "w", "t", "m", "part")
    calibrated = min(counts.values()) > 1
    # the labelled sample is bounded, and each of the many steps of a fit runs a task for each partition
    labelled = data.where(F.col("part") == FIT).coalesce(FIT_TASKS)
    held, pool = data.where(F.col("part") == HELD).coalesce(FIT_TASKS), data.where(F.col("part") == POOL)
    models: dict[str, Linear] = {}
    for n in range(rounds):
        for view, other in (("t", "m"), ("m", "t")):
            more = labelled
            if n:  # what the other view is sure of, from the round before
                edge = math.log(sure / (1 - sure))
                told = last[other].logit(pool, other, "z").where(F.abs("z") >= edge).withColumn("y", (F.col("z") > 0).cast("int")).withColumn("w", F.lit(0.5))
                more = labelled.unionByName(told.select(*labelled.columns))
            models[view] = _fit(more, view)
            if calibrated:
                models[view] = _calibrated(models[view], held, view)
        last = dict(models)
    drop_staged(staged)
    return Model(models["t"], models["m"], prior, vocabulary)


def score(df: DataFrame, model: Model, names: tuple[str, str, str]) -> DataFrame:
    """``df`` with the three probabilities under ``names``."""
    from pyspark.ml.functions import array_to_vector

    columns = [F.col(f"`{c}`") for c in df.columns]
    if not model.learned:
        return df.select(*columns, *[F.lit(model.prior).alias(n) for n in names])
    t, m, a, b = (unused_name(df, f"view_{x}") for x in ("t", "m", "a", "b"))
    viewed = with_meta_view(with_text_view(df, t).withColumn(t, array_to_vector(t)), model.vocabulary, m)
    odds = model.meta.logit(model.text.logit(viewed, t, a), m, b)
    return odds.select(*columns, *[x.alias(n) for x, n in zip(model.scores(a, b), names)])


def query(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    out = score(docs.select("doc_id", "text", "source", "lang", "n_chars"), model, ("text_score", "meta_score", "score"))
    return out.select("doc_id", "text_score", "meta_score", "score", model.keep("score").alias("keep"))


def stage_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose probability of good quality is below a
    half go; the columns stay."""
    model = train(docs, table(spark, sf_dir, "labels"))
    if not model.learned:
        return docs
    names = tuple(unused_name(docs, f"quality_{x}") for x in "tms")
    return score(docs, model, names).where(model.keep(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])
