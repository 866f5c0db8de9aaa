"""Language identification with language-bitmask n-gram filters.

Training counts the character trigrams of each learned language over all given
texts (lower case, letters only; anything else is a gap, and a trigram's middle
is a letter). A trigram belongs to every language whose share of it (its count
over the language's trigrams plus ``smooth``) is at least ``min_ratio`` of the
largest share of any language, so each trigram belongs to one language or more,
however rare it is, and a stray foreign one not to the language it strayed into.
They enter a bit-sliced Bloom filter: a row of bits per slot, one bit per
language, so that one look-up (the AND of ``hashes`` rows) returns all languages
that contain a trigram. A filter has ``SPACE`` slots for each trigram of the
largest language; where it would outgrow ``max_bytes``, the trigrams are dealt
out to several filters, and the texts pass through one after the other.

A text's trigrams are looked up; the popcount of each language, corrected for
the filter's false positives (its filled share to the power of ``hashes``),
over the number of trigrams is the language's score, and the largest wins (ties:
the smaller name).

A null text, or one without a letter, is ``und`` with score 0; so is every text
if no language was learned. Texts are read whole; rows without language or text
are not learned from; repeated rows count and are predicted each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.common import drop_staged, stage, table, text_runs, unused_name, utf8

SPACE = 16
HASHES = 3
MIN_RATIO = 0.05
SMOOTH = 50_000
MAX_BYTES = 32 << 20
MAX_LANGUAGES = 4096
UND = "und"


@lru_cache(None)
def _letters() -> np.ndarray:
    """Code point -> its lower-case code point if it is a letter, else 0."""
    out = np.zeros(0x110000, np.int64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All trigrams of some texts, and the index of each one's text."""
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    gap = np.zeros(1, np.uint32)
    x = _letters()[np.concatenate([gap, *(y for p in parts for y in (p, gap))])]
    who = np.repeat(np.arange(len(parts)), [len(p) + 1 for p in parts])  # of x[1:]
    mid = np.flatnonzero(x[1:-1]) + 1
    return x[mid - 1] << 42 | x[mid] << 21 | x[mid + 1], who[mid - 1]


def gram_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, gram, n)``: trigram counts of every language over all texts."""
    def run(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for name, some in held.items():
                g = np.concatenate([x for x, _ in some])
                c = np.concatenate([x for _, x in some])
                u, at = np.unique(g, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(u)), pa.array(u), pa.array(np.bincount(at, weights=c, minlength=len(u)).astype(np.int64))],
                    ["lang", "gram", "n"])

        for batch, a, b in text_runs(batches):
            langs = batch.column("lang").slice(a, b - a).to_pylist()
            grams, who = trigrams([t.decode() for t in utf8(batch, a, b)])
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])[who] if len(who) else who
            for k, name in enumerate(names):
                u, c = np.unique(grams[number == k], return_counts=True)
                held.setdefault(name, []).append((u, c))
                size += len(u)
            if size > 2_000_000:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    some = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    return some.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _slots(grams: np.ndarray, hashes: int, slots: int):
    h = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    one, two = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for i in range(hashes):
        yield ((one + np.uint64(i) * two) % np.uint64(slots)).astype(np.int64)


def _width(languages: int) -> int:
    """Bytes of a slot: the narrowest whole number that has a bit for each."""
    return next((w for w in (1, 2, 4) if languages <= 8 * w), 8 * max(1, -(-languages // 64)))


class Filter:
    """A Bloom filter for each language, sliced so that a slot is a bitmask."""

    def __init__(self, languages: list[str], slots: int, hashes: int = HASHES):
        self.languages, self.hashes = languages, hashes
        width = _width(len(languages))
        self.type = np.dtype(f"u{min(width, 8)}").type
        self.bits = np.zeros((max(1, width // 8), slots), self.type)

    def add(self, language: int, grams: np.ndarray) -> None:
        word, bit = divmod(language, 64)
        for s in _slots(grams, self.hashes, self.bits.shape[1]):
            self.bits[word][s] |= self.type(1 << bit)

    def _has(self, mask: np.ndarray, language: int) -> np.ndarray:
        return (mask & self.type(1 << language % 64)) != 0

    def false_positives(self) -> np.ndarray:
        slots = self.bits.shape[1]
        fill = [np.count_nonzero(self._has(self.bits[i // 64], i)) / slots for i in range(len(self.languages))]
        return np.array(fill) ** self.hashes

    def masks(self, grams: np.ndarray, word: int) -> np.ndarray:
        out = None
        for s in _slots(grams, self.hashes, self.bits.shape[1]):
            out = self.bits[word][s] if out is None else out & self.bits[word][s]
        return out

    def hits(self, grams: np.ndarray, who: np.ndarray, texts: int) -> np.ndarray:
        """How many of each text's trigrams each language contains."""
        out = np.zeros((texts, len(self.languages)))
        for word in range(self.bits.shape[0]):
            mask = self.masks(grams, word)
            for i in range(word * 64, min(len(self.languages), word * 64 + 64)):
                out[:, i] = np.bincount(who[self._has(mask, i)], minlength=texts)
        return out


class Model:
    """The trigrams of the languages, dealt out to ``parts`` filters."""

    def __init__(self, languages: list[str], grams: DataFrame | None = None, parts: int = 1, slots: int = 1, hashes: int = HASHES):
        self.languages, self.grams, self.parts, self.slots, self.hashes = languages, grams, parts, slots, hashes

    def filters(self) -> Iterator[Filter]:
        for part in range(self.parts):
            out = Filter(self.languages, self.slots, self.hashes)
            if self.grams is not None:
                # a filter has SPACE bits a trigram and at most max_bytes
                some = self.grams.where(F.col("gram") % self.parts == part).toPandas()
                for i, own in some.groupby("i").gram:
                    out.add(int(i), own.to_numpy(np.int64))
            yield out


def train(df: DataFrame, text: str = "text", lang: str = "lang", min_ratio: float = MIN_RATIO, smooth: int = SMOOTH,
          max_bytes: int = MAX_BYTES, hashes: int = HASHES) -> Model:
    counts = stage(gram_counts(df, text, lang), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).limit(MAX_LANGUAGES + 1).collect()
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not totals:
        return Model([], hashes=hashes)
    totals.sort(key=lambda r: r.lang)
    languages = [r.lang for r in totals]
    # one row a language, MAX_LANGUAGES at most
    numbers = F.broadcast(df.sparkSession.createDataFrame([(i, r.lang, r.total) for i, r in enumerate(totals)], "i int, lang string, total long"))
    share = F.col("n") / (F.col("total") + F.lit(smooth))
    top = F.max("share").over(Window.partitionBy("gram"))  # a row a language
    own = counts.join(numbers, "lang").select("i", "gram", share.alias("share")).withColumn("top", top)
    grams = stage(own.where(F.col("share") >= F.lit(min_ratio) * F.col("top")).select("i", "gram"), "language-grams")
    drop_staged(counts)

    def largest(parts: int) -> int:
        return grams.groupBy("i", F.col("gram") % parts).count().agg(F.max("count")).first()[0]

    parts, width = 1, _width(len(languages))
    while (slots := SPACE * largest(parts)) * width > max_bytes and slots > SPACE:
        parts = -(-parts * slots * width // max_bytes) | 1  # odd, so that all three letters count
    return Model(languages, grams, parts, slots, hashes)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred string, score double`` (these names replaced)."""
    some = df.select(*(c for c in df.columns if c.lower() not in ("lang_pred", "score")))
    found = unused_name(some, "found")
    # of every row: corrected hits and the trigrams left, by language, of the filters so far
    before = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.schema)
    columns = len(some.columns)
    for part, filt in enumerate(model.filters()):
        last = part == model.parts - 1
        run = _pass(filt, part, model.parts, columns, text, found)
        read = some
        some = read.mapInArrow(run, f"{before}, lang_pred string, score double" if last else f"{before}, `{found}` array<double>")
        if not last:
            some = stage(some, "languages")
            if part:
                drop_staged(read)
    return some


def _pass(filt: Filter, part: int, parts: int, columns: int, text: str, found: str):
    languages = filt.languages
    false = filt.false_positives()

    def run(batches):
        for batch, a, b in text_runs(batches, text):
            rows, size = b - a, len(languages)
            grams, who = trigrams([t.decode() for t in utf8(batch, a, b, text)])
            n = np.bincount(who, minlength=rows)
            mine = grams % parts == part
            here = np.bincount(who[mine], minlength=rows)[:, None] * np.ones(size)
            sums = np.stack([filt.hits(grams[mine], who[mine], rows) - here * false, here * (1 - false)], axis=1)
            if part:
                held = batch.column(columns).slice(a, rows)
                sums += held.flatten().to_numpy().reshape(rows, 2, size)
            kept = batch.slice(a, rows).columns[:columns]
            names = batch.schema.names[:columns]
            if part < parts - 1:
                offsets = pa.array(np.arange(rows + 1) * 2 * size, pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))
                yield pa.RecordBatch.from_arrays([*kept, lists], [*names, found])
                continue
            pred, best = [UND] * rows, np.zeros(rows)
            if size:
                scores = np.clip(sums[:, 0] / np.maximum(sums[:, 1], 1e-9), 0.0, 1.0)
                at = scores.argmax(axis=1)
                best = np.where(n > 0, scores[np.arange(rows), at], 0.0)
                pred = [languages[i] if k else UND for i, k in zip(at, n)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pred), pa.array(best)], [*names, "lang_pred", "score"])

    return run


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1).alias("held_out")
    model = train(docs.where(~held))
    return predict(docs.select("doc_id", held, "text"), model).drop("text")
