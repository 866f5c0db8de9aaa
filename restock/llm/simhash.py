"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits: each word shingle of a text is hashed (XXH64, seed
42), and a bit is set if it is set in over half the hashes. Two fingerprints
link if they differ in at most ``max_bits`` bits; groups are the connected
components of the links.

Anchors are the words of a covering code: the direct sum of two perfect binary
Golay codes [23, 12] with covering radius 3 each, over the first 46 bits (2^24
anchors). A fingerprint is at home at the one anchor within radius 3 in either
half, and is replicated to every anchor within the covering radius plus the
threshold: distances d1 and d2 in the halves with max(0, d1-3) + max(0, d2-3)
<= max_bits (68 anchors or fewer for 2 bits). If x and y differ in t bits, y is
within t bits more of x's home, hence replicated to it, so every link is found
there. At each anchor, homes are compared with replicas on all 64 bits.

Equal fingerprints are one row from the start, so copies cost nothing. The
replicas of an anchor are dealt over ``salts`` tasks, each with all the homes;
replicas are streamed, and only links that join two parts of a task's spanning
forest leave it, so a crowded anchor neither fills a task nor emits all pairs.
Where an anchor has very many homes, each replica looks up all words within
``max_bits`` of it among them instead of comparing with each.

A null text counts as empty; an empty text (no words) has fingerprint zero and
is linked like any other; fewer words than a shingle make one shingle. Repeated
rows and null ids are kept; a group whose ids are all null has a null id.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import Forest, components, rows, stage, table, text_runs, unused_name, utf8

SEED = 42
WORDS = 3
MAX_BITS = 2
SALTS = 8
HALF = 23
RADIUS = 3
GOLAY = 0b101011100011  # fixed value: generator polynomial of the [23, 12] code
MANY_HOMES = 20_000
SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; cuts fall on white space."""
    at = 0
    while len(text) - at > size:
        m = SPACE.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()].lower().split()
        at = m.end()
    yield text[at:].lower().split()


def fingerprint(text: bytes, words: int = WORDS) -> int:
    import xxhash

    digest, n, ones, carry, any_word = xxhash.xxh64_intdigest, 0, np.zeros(64, np.int64), [], []
    for block in word_blocks(text):
        w = carry + block
        if len(w) >= words:
            shingles = map(b" ".join, zip(*(w[i:] for i in range(words))))
            h = np.array([digest(s, SEED) for s in shingles], np.uint64)
            n += len(h)
            for part in np.array_split(h, len(h) // 65536 + 1):
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        carry = w[-(words - 1):] if words > 1 else []
        any_word = any_word or w[:words]
    if n == 0:
        if not any_word and not carry:
            return 0
        return digest(b" ".join(carry if words > 1 else any_word), SEED)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``(key, fp long)`` for every row."""
    kind = df.schema[key].dataType

    def run(batches):
        for batch, a, b in text_runs(batches):
            fps = [fingerprint(t, words) for t in utf8(batch, a, b)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(a, b - a), pa.array(np.array(fps, np.uint64).view(np.int64))], ["key", "fp"])

    return (df.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind.simpleString()}, fp long").withColumnRenamed("key", key))


@lru_cache(None)
def _code(max_bits: int):
    """For each syndrome of a half: the error patterns of weight up to the
    radius plus ``max_bits`` and by how much each exceeds the radius, padded."""
    def remainder(x: np.ndarray) -> np.ndarray:
        for bit in range(HALF - 1, 10, -1):
            x = np.where(x >> bit & 1, x ^ (GOLAY << (bit - 11)), x)
        return x

    patterns = np.array([sum(1 << i for i in c) for w in range(RADIUS + max_bits + 1) for c in itertools.combinations(range(HALF), w)])
    excess = np.maximum(np.bitwise_count(patterns.astype(np.uint64)).astype(np.int64) - RADIUS, 0)
    syndrome = remainder(patterns)
    order = np.argsort(syndrome, kind="stable")
    count = np.bincount(syndrome, minlength=2048)
    first = np.cumsum(count) - count
    col = np.arange(len(order)) - np.repeat(first, count)
    shape = (2048, count.max())
    pat, exc = np.zeros(shape, np.int64), np.full(shape, 99, np.int64)
    pat[syndrome[order], col], exc[syndrome[order], col] = patterns[order], excess[order]
    bytes_ = [remainder(np.arange(256) << s) if s < 16 else remainder(np.arange(128) << s) for s in (0, 8, 16)]
    return pat, exc, bytes_


def anchors(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the fingerprint, anchor, at home) for every anchor in reach."""
    pat, exc, by = _code(max_bits)
    halves = [(fps.view(np.uint64) >> np.uint64(s)).astype(np.int64) & ((1 << HALF) - 1) for s in (0, HALF)]
    syn = [by[0][x & 255] ^ by[1][x >> 8 & 255] ^ by[2][x >> 16] for x in halves]
    over = exc[syn[0]][:, :, None] + exc[syn[1]][:, None, :]
    row, i, j = np.nonzero(over <= max_bits)
    a = (halves[0][row] ^ pat[syn[0][row], i]) | (halves[1][row] ^ pat[syn[1][row], j]) << HALF
    return row, a, over[row, i, j] == 0


def compare(homes: np.ndarray, replicas: np.ndarray, max_bits: int, forest: Forest, out: list) -> None:
    """Link replicas to homes within ``max_bits``; ``out`` gets forest edges."""
    def linked(a, b):
        ra, rb = (np.array([forest.find(int(x)) for x in s], np.int64) for s in (homes[a], replicas[b]))
        for x, y in set(zip(ra.tolist(), rb.tolist())):
            if x != y and forest.link(x, y):
                out.append((x, y))

    if len(homes) <= MANY_HOMES:
        step = max(1, (1 << 20) // len(homes))
        for k in range(0, len(replicas), step):
            near = np.bitwise_count(homes[:, None].view(np.uint64) ^ replicas[None, k : k + step].view(np.uint64)) <= max_bits
            a, b = np.nonzero(near)
            linked(a, b + k)
        return
    flips = np.array([sum(1 << i for i in c) for w in range(max_bits + 1) for c in itertools.combinations(range(64), w)], np.uint64)
    homes = np.sort(homes)
    for k, r in enumerate(replicas):
        want = (r.view(np.uint64) ^ flips).view(np.int64)
        at = np.minimum(np.searchsorted(homes, want), len(homes) - 1)
        hit = at[homes[at] == want]
        if len(hit):
            linked(hit, np.full(len(hit), k))


def links(fps: DataFrame, max_bits: int = MAX_BITS, salts: int = SALTS) -> DataFrame:
    """``(a, b)``: a spanning set of the links between different fingerprints
    of ``fps (fp long)``, which must be distinct."""
    def place(batches):
        for batch in batches:
            every = batch.column(0).to_numpy()
            for k in range(0, len(every), 4096):
                fp = every[k : k + 4096]
                row, anchor, home = anchors(fp, max_bits)
                salt = (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % salts
                replica = (anchor * salts + salt[row]) * 2 + 1
                at_home = ((anchor[home] * salts)[:, None] + np.arange(salts)[None, :]) * 2
                key = np.concatenate([replica, at_home.ravel()])
                who = np.concatenate([fp[row], np.repeat(fp[row[home]], salts)])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(who)], ["place", "fp"])

    def meet(batches):
        forest = Forest()
        last, held = None, np.empty(0, np.int64)
        for batch in batches:
            place_, fp = (batch.column(i).to_numpy() for i in range(2))
            if last is not None and len(place_) and place_[0] >> 1 == last:
                place_ = np.concatenate([np.full(len(held), last * 2), place_])
                fp = np.concatenate([held, fp])
            if not len(place_):
                continue
            key = place_ >> 1
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            end = np.r_[first[1:], len(key)]
            homes = np.add.reduceat(1 - (place_ & 1), first)
            out: list = []
            for a, h, b in zip(first.tolist(), homes.tolist(), end.tolist()):
                if h and b - a > h and not (h == 1 and b - a == 2 and fp[a] == fp[a + 1]):
                    compare(fp[a : a + h], fp[a + h : b], max_bits, forest, out)
            last = int(key[-1])
            held = fp[first[-1] : first[-1] + homes[-1]]
            if out:
                yield rows(EDGE, list(zip(*out)))

    EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    placed = fps.select("fp").mapInArrow(place, "place long, fp long")
    return placed.repartition(F.expr("place >> 1")).sortWithinPartitions("place").mapInArrow(meet, "a long, b long")


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS,
           salts: int = SALTS) -> DataFrame:
    """``(key, fp, component)`` for every row of ``df``; the component is the
    smallest key that links lead to, its own included."""
    prints = stage(with_fingerprints(df, key, text, words), "fingerprints")
    reps = prints.groupBy("fp").agg(F.min(key).alias("first"))
    comp = components(stage(links(reps.select("fp"), max_bits, salts), "links"))
    joined = reps.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component"))
    name = stage(joined.join(smallest, "root").select("fp", "component"), "fp-groups")
    return prints.join(name, "fp").select(key, "fp", "component")


def query(spark, sf_dir: str) -> DataFrame:
    g = groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def stage_near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates the document with the
    smallest doc_id stays (of repeated rows of that id, one; among rows without
    id, one for each fingerprint group). The columns stay."""
    row = unused_name(docs, "row_key")
    numbered = stage(docs.withColumn(row, F.struct(F.col("doc_id"), F.monotonically_increasing_id().alias("n"))), "near-dedup-input")
    # rows without an id come last, so they stay only in groups that have no other
    light = numbered.select(F.struct(F.col(f"{row}.doc_id").isNull().alias("z"), F.coalesce(F.col(f"{row}.doc_id"), F.lit(0)).alias("id"),
                                     F.col(f"{row}.n").alias("n")).alias("k"), "text")
    keep = groups(light, "k", "text").where("k = component").select(F.col("k.n").alias("kept_n"))
    return numbered.join(keep, F.col(f"{row}.n") == F.col("kept_n"), "left_semi").select(*docs.columns)
