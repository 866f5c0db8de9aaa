"""Spelling variants of words: grouping by single edits, by dense prefix-suffix tiling.

Words are the runs of letters of all texts, counted (:func:`words`). Two words
are near if they differ by exactly one inserted, deleted or replaced code point:
that is, if common prefix plus common suffix reach the longer length less one.
A word's form is its near word of largest count (ties: the smallest in
code-point order), if that count is at least ``ratio`` times its own; its root is
where the forms lead.

*Tiles.* Near words of longer length m, at an edit in the places a..b-1, share
their first a and their last m-b code points. The places are halved: each word
goes, for m its own length and one more, to the group of its first m/2 code
points and to that of its last m - m/2. Groups over ``tile`` words are halved
again, until a group has at most ``tile`` or its edits have one place only, so
that all its words are near each other. Rows are sorted by group and laid out as
padded matrices of code points; each block of rows is compared with itself and
with the blocks before it that share a group, all pairs of rows at once, column
by column: prefix lengths, suffix lengths, and whether the two reach m - 1. A pair
counts in the group that has the end of its common prefix among its places, so
once. Blocks emit, for each word, its number of near words and the best of them,
never the pairs.

A block holds at most ``CELLS`` code points, so words of any length can be
compared. A null text has no words, a null id counts as empty in the hash;
repeated rows count each time. Columns other than id and text play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import drop_staged, stage, table, text_runs, utf8

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
ONE_IN = 31
TILE = 2048  # words of a group, from which it is halved
BLOCK = 256  # rows of a block
TASK = 1 << 17  # rows of a task, about
CELLS = 1 << 20  # code points of a block, but for a single longer word
FLUSH = 200_000  # words that a task counts before it passes them on
RUN = "[a-zÀ-ÿ]"


def words(df: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
          one_in: int = ONE_IN) -> DataFrame:
    """``(word, n)``: the runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z in
    lower case, of ``min_length`` code points and ``min_count`` occurrences or
    more. Where ``one_in`` divides h, the CRC-32 of id, colon and run, the run's
    code point number h % length is deleted first; none is, if ``one_in`` is 0."""
    find = re.compile(f"{RUN}{{{min_length},}}").findall  # a shorter run gives no word, deleted or not

    def run(batches):
        counts: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch, first, last in text_runs(batches):
            keys = batch.column("key").slice(first, last - first).to_pylist()
            for k, t in zip(keys, utf8(batch, first, last)):
                seed = zlib.crc32(f"{'' if k is None else k}:".encode())
                for w, n in Counter(find(t.lower().decode())).items():  # of bytes, lower() takes A-Z only
                    h = zlib.crc32(w.encode(), seed)
                    if one_in and h % one_in == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < min_length:
                            continue
                    counts[w] += n
                if len(counts) >= FLUSH:
                    yield flush()
        if counts:
            yield flush()

    parts = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _key(a, b):
    """The group of a word by its places a..b-1: longer length, places, and two
    hashes of what it has before and after them."""
    before = F.substring("word", F.lit(1), a)
    after = F.substring("word", F.col("size") - (F.col("m") - b) + 1, F.col("m") - b)
    return F.struct(F.col("m").alias("m"), a.alias("a"), b.alias("b"), F.xxhash64(before, after).alias("x"),
                    F.xxhash64(F.lit("2"), after, before).alias("y")).alias("grp")


def _halved(df: DataFrame) -> DataFrame:
    """Each row with places a..b-1 as two rows, for the halves."""
    mid = F.col("a") + F.floor((F.col("b") - F.col("a")) / 2).cast("int")
    both = F.explode(F.array(F.struct(F.col("a").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b").alias("b"))))
    return df.select("word", "n", "size", "m", both.alias("p")).select("word", "n", "size", "m", _key(F.col("p.a"), F.col("p.b")))


def groups(counted: DataFrame, tile: int = TILE) -> DataFrame:
    """``(grp, word, n)``: the words in all their groups of two or more words."""
    some = counted.select("word", "n", F.length("word").alias("size"))
    some = some.select("*", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("m"))
    rows = stage(_halved(some.select("*", F.lit(0).alias("a"), F.col("m").alias("b"))), "spelling-groups")
    done = None
    while True:
        sizes = rows.groupBy("grp").agg(F.count("*").alias("rows")).where("rows > 1")
        marked = rows.join(sizes, "grp").select("grp", "word", "n", "size",
                                                ((F.col("rows") > tile) & (F.col("grp.b") - F.col("grp.a") > 1)).alias("hot"))
        marked = stage(marked, "spelling-marked", by="hot")
        drop_staged(rows)
        cold = marked.where("not hot").select("grp", "word", "n")
        done = cold if done is None else done.unionByName(cold)
        hot = marked.where("hot")
        if hot.isEmpty():
            return done
        rows = stage(_halved(hot.select("word", "n", "size", "grp.m", "grp.a", "grp.b")), "spelling-groups")


class Block:
    """Rows of groups as a padded matrix of code points, from the left and from the right."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.n = words, counts
        wide = max("".join(words), default="") > "\xff"
        kind = np.uint32 if wide else np.uint8
        self.size = np.array([len(w) for w in words], np.int64)
        width = max(1, int(self.size.max()))
        self.left = np.zeros((len(words), width), kind)
        self.right = np.zeros((len(words), width), kind)
        for i, w in enumerate(words):
            row = np.frombuffer(w.encode("utf-32-le") if wide else w.encode("latin-1"), "<u4" if wide else np.uint8)
            self.left[i, : len(w)] = row
            self.right[i, : len(w)] = row[::-1]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of ``a`` and each of ``b``. Zeros
    pad the rows, so two that are equal up to the shorter's end stop there, or
    run on if both have ended."""
    same = a[:, None, 0] == b[None, :, 0]
    out = same.astype(np.int32)
    for j in range(1, min(a.shape[1], b.shape[1])):
        if not same.any():
            break
        same &= a[:, None, j] == b[None, :, j]
        out += same
    return out


def near(x: Block, y: Block, ids_x: np.ndarray, ids_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, of ``x`` and of ``y``, that are near and count in their
    group; ``ids``: the rows' groups as (number, m, a, b)."""
    m, a, b = (ids_x[:, i][:, None] for i in (1, 2, 3))
    pair = ids_x[:, 0][:, None] == ids_y[:, 0][None, :]
    longer = np.maximum(x.size[:, None], y.size[None, :])
    pair &= longer == m
    if x is y:
        pair &= np.arange(len(x.words))[:, None] < np.arange(len(x.words))[None, :]
    shorter = np.minimum(x.size[:, None], y.size[None, :])
    prefix = np.minimum(_common(x.left, y.left), shorter)
    pair &= (prefix >= a) & (prefix < b)
    if pair.any():
        suffix = np.minimum(_common(x.right, y.right), shorter)
        pair &= prefix + suffix >= longer - 1
    return np.nonzero(pair)


def _runs(batches):
    """Blocks of sorted rows: at most ``BLOCK`` rows and ``CELLS`` code points."""
    ids, words, counts, width = [], [], [], 0
    for batch in batches:
        cols = [batch.column(i) for i in range(batch.num_columns)]
        for row in zip(*(c.to_pylist() for c in cols)):
            g, w, n = row[:5], row[5], row[6]
            if words and (len(words) == BLOCK or (len(words) + 1) * max(width, len(w)) > CELLS):
                yield ids, words, counts
                ids, words, counts, width = [], [], [], 0
            ids.append(g)
            words.append(w)
            counts.append(n)
            width = max(width, len(w))
    if words:
        yield ids, words, counts


def _compare(batches):
    """Sorted rows (m, a, b, x, y, word, n) -> (word, n_near, form_n, form), several a word."""
    number, newest, waiting = 0, None, []  # blocks before, as long as they share a group with the newest
    for ids, words, counts in _runs(batches):
        waiting = [w for w in waiting if w[2] == ids[0]]
        rows = []
        for g in ids:
            number += g != newest
            newest = g
            rows.append((number, *g[:3]))
        rows = np.array(rows, np.int64)
        block = Block(words, counts)
        found: dict[str, list] = {}
        for other, its in [*((w[0], w[1]) for w in waiting), (block, rows)]:
            for i, j in zip(*(k.tolist() for k in near(other, block, its, rows))):
                for p, i_, q, j_ in ((other, i, block, j), (block, j, other, i)):
                    w, best = p.words[i_], (-q.n[j_], q.words[j_])
                    if (f := found.get(w)) is None:
                        found[w] = [1, best]
                    else:
                        f[0] += 1
                        if best < f[1]:
                            f[1] = best
        waiting.append((block, rows, newest))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([f[0] for f in found.values()], pa.int64()),
                                              pa.array([-f[1][0] for f in found.values()], pa.int64()),
                                              pa.array([f[1][1] for f in found.values()], pa.string())], ["word", "n_near", "form_n", "form"])


def variants(counted: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``counted``
    (word, n), whose words are distinct."""
    counted = stage(counted.select("word", "n"), "spelling-words")
    tiles = groups(counted, tile)
    cols = [F.col(f"grp.{c}").alias(c) for c in "mabxy"]
    # by rows, as a few bytes of words are much work
    tasks = 1 + tiles.count() // TASK
    spread = tiles.select(*cols, "word", "n").repartition(tasks, "m", "a", "b", "x", "y").sortWithinPartitions("m", "a", "b", "x", "y", "word")
    found = spread.mapInArrow(_compare, "word string, n_near long, form_n long, form string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    rows = counted.join(best, "word", "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    rows = stage(rows.select("word", F.when(enough, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                             F.when(enough, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(rows.where("form is not null").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Follow forms to the last: each round, a word's root becomes that of its
    root, so paths halve. Counts grow along a path, which therefore ends."""
    cur = stage(links, "spelling-roots")
    while True:
        up = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stage(cur.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                    "spelling-roots")
        drop_staged(cur)
        cur = new.select("word", "root")
        if new.where("moved").isEmpty():
            return cur


def query(spark, sf_dir: str) -> DataFrame:
    return variants(words(table(spark, sf_dir, "documents")))


# CRC-32 byte by byte; the table of 256 steps is made by its rule. Near words meet
# at the string that is left when one code point is deleted.
ORACLE = """
with recursive bits as (
  select i as b, i::bigint as c, 0 as k from range(256) t(i)
  union all
  select b, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
steps as (select list(c order by b) as t from bits where k = 8),
found as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
  from documents where text is not null),
runs as (select doc_id, run, count(*) as n from found where length(run) >= 7 group by all),
coded as (select run, n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as x from runs),
hashed as (
  select run, n, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i::int + 1, 2))::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) as h
  from coded, steps),
results as (
  select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n from hashed),
words as (select word, sum(n)::bigint as n from results where length(word) >= 7 group by word having sum(n) >= 2),
less as (
  select word, n, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
pairs as (
  select a.word as a, b.word as b, b.n as n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select less.word, words.word, words.n from less join words on less.rest = words.word
  union select words.word, less.word, less.n from less join words on less.rest = words.word),
best as (
  select a, count(*) as n_near, arg_min(b, (-n, b)) as form, max(n) as form_n from pairs group by a),
forms as (
  select word, n, coalesce(n_near, 0) as n_near, case when form_n >= 10 * n then form end as form, case when form_n >= 10 * n then form_n end as form_n
  from words left join best on word = a),
chains as (
  select word, word as tip, 0 as k from forms
  union all
  select chains.word, forms.form, k + 1 from chains join forms on tip = forms.word where forms.form is not null),
roots as (select word, arg_max(tip, k) as root from chains group by word)
select word, form, root, n, n_near, form_n from forms join roots using (word)
"""
