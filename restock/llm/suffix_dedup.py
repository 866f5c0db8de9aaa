"""Removal of repeated passages with a logarithmic family of suffix arrays.

A byte is removed if a string of ``length`` bytes (100) that covers it also
starts earlier: in a document of smaller id, or earlier in the same document.
Strings lie within one document and are judged on the input.

* *Suffixes.* Of the bytes of a text, only some positions start an entry: each
  string of 100 bytes selects the 32 bytes within it whose hash is smallest (the
  leftmost of equals). Equal strings select alike, so nothing is lost. The
  strings that select one position are consecutive; an entry holds the suffix
  from there to the end of the last of them, the bytes to its left from the
  start of the first, and where it stands.
* *Rare entries go early.* An entry whose 32 selected bytes occur once in the
  corpus cannot repeat; one pass over the entries' hashes in order finds the
  others, and only they get their bytes attached.
* *Family.* Entries come in batches by document order. A batch becomes a suffix
  array: spread by the hash of its entries, sorted by suffix in each part. It is merge-scanned against the arrays of the levels: one pass over the
  merged order, where an entry equal to the one before it (older levels first)
  is a repeat as a whole. The others enter as level 0, and levels of equal rank
  merge into the next rank, so each entry is rewritten a logarithmic number of
  times.
* *Partial repeats.* Entries of the final array with the same selected bytes but
  different surroundings share some of their strings at most. One scan of the
  array settles which stand earlier; crowds of such entries are settled by
  128-bit hashes of their strings and partial aggregates instead.

The scans hold a bounded number of entries. Whole copies of a text are settled first, by
SHA-256: all but those with the smallest id are removed entirely (if of 100
bytes or more) and take no further part, so a large group of copies is one text.
Entries that many texts share are reduced before they are shuffled: a task marks
those it has had at an earlier place, and passes on the others. Different entries
of a frequent gram are spread by their bytes.

A null text is empty; a null id comes after all others; rows that share an id
are told apart by their texts, and repeated rows (same id and text) are one
document, each row with its result. Positions are bytes of UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import drop_staged, rows, stage, table, text_runs, unused_name, utf8

LENGTH = 100
GRAM = 32
BATCHES = 4
CHUNK = 1 << 23  # bytes scanned at once; positions have 24 bits
LAST_ID = (1 << 63) - 1
RANGE = "array<struct<a:int,b:int>>"
SINGLE, AGAIN, SEVERAL, WITNESS = range(4)  # kinds of the rows of entries()
FOUND = "gram long, rid long, a int, p int, b int, kind int"
SEEN = 200_000  # entries that a task remembers to reduce equal ones


def select(data: bytes, starts: np.ndarray, length: int, gram: int):
    """For texts laid end to end in ``data`` (``starts``: where each begins, and
    the end): hash, first string, position and last string of each entry."""
    n, w = len(data), length - gram + 1
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none, none
    words = [np.ndarray((n - gram + 1,), "<u8", data, k, (1,)) for k in range(0, gram, 8)]
    h = words[0] * np.uint64(0x9E3779B97F4A7C15)
    for x in words[1:]:
        h ^= h >> np.uint64(29)
        h += x
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    low = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if w > size:
        low = np.minimum(low[: size - w], low[w - size :])
    at = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    inside = np.ones(len(at), bool)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        inside[max(a, b - length + 1) : b] = False
    s = np.flatnonzero(inside)
    if not len(s):
        return none, none, none, none
    p = at[s]
    new = np.r_[True, p[1:] != p[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(s) - 1]
    return h[p[new]].view(np.int64), s[new], p[new], s[last]


def entries(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``(gram, rid, a, p, b, kind)`` from ``(rid, text)``: the strings that
    start at a..b select position p. Entries whose bytes are an entry earlier in
    the text already come as ranges of such strings, ``AGAIN``. Entries whose
    hash is that of another one in the same task's present texts are known to
    recur: they are ``SEVERAL`` and need not meet the others of that hash, for
    which one ``WITNESS`` goes instead, so that frequent ones are spread."""
    def run(batches):
        for batch, i, j in text_runs(batches):
            rid = batch.column("rid").slice(i, j - i).to_numpy()
            parts = utf8(batch, i, j)
            total = sum(map(len, parts))
            if total <= CHUNK:
                yield from emit(rid, parts, np.zeros(len(parts), np.int64))
            else:  # one long text (text_runs joins short ones only)
                for k in range(0, max(1, total - length + 1), CHUNK - length):
                    yield from emit(rid, [parts[0][k : k + CHUNK - 1]], np.array([k]))

    def emit(rid, parts, offset):
        data = b"".join(parts)
        starts = np.cumsum([0, *map(len, parts)])
        h, a, p, b = select(data, starts, length, gram)
        if not len(h):
            return
        doc = np.searchsorted(starts, a, "right") - 1
        again = np.zeros(len(h), bool)
        order = np.lexsort((p, h, doc))
        same = (h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        k = 0
        hits = np.flatnonzero(same)
        seen: set = set()
        previous = -2
        for k in hits.tolist():
            if k != previous + 1:
                x = order[k]
                seen = {(p[x] - a[x], data[a[x] : b[x] + length])}
            x = order[k + 1]
            key = (p[x] - a[x], data[a[x] : b[x] + length])
            again[x] = key in seen
            seen.add(key)
            previous = k
        base = offset[doc] - starts[doc]
        # what repeats within the text goes as merged ranges, under hashes that spread them
        x = np.flatnonzero(again)
        if len(x):
            open_ = np.r_[True, (doc[x[1:]] != doc[x[:-1]]) | (a[x[1:]] > b[x[:-1]] + length)]
            first, last = x[open_], x[np.r_[np.flatnonzero(open_)[1:] - 1, len(x) - 1]]
            spread = (rid[doc[first]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (a[first].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
            yield batch_of(spread.view(np.int64), rid[doc[first]], a[first] + base[first], a[first] + base[first], b[last] + base[first], AGAIN)
        x = np.flatnonzero(~again)
        if len(x):
            grams, back, n = np.unique(h[x], return_inverse=True, return_counts=True)
            yield batch_of(h[x], rid[doc[x]], a[x] + base[x], p[x] + base[x], b[x] + base[x], np.where(n[back] > 1, SEVERAL, SINGLE))
            if len(grams := grams[n > 1]):
                zero = np.zeros(len(grams), np.int64)
                yield batch_of(grams, zero, zero, zero, zero, WITNESS)

    def batch_of(h, rid, a, p, b, kind):
        return pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(rid), *(pa.array(np.broadcast_to(x, len(h)).astype(np.int32)) for x in (a, p, b, kind))],
            ["gram", "rid", "a", "p", "b", "kind"])

    return texts.select("rid", "text").mapInArrow(run, FOUND)


def recurring(found: DataFrame) -> DataFrame:
    """The entries whose selected bytes (by their hash) are not those of one
    entry alone, and all that repeat within their text: one pass over the
    entries in the order of the hash, a batch of light rows at a time. What is
    known to recur already passes wherever it is."""
    def run(batches):
        last, before = None, None  # the last row so far, and the hash before it
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if last is None else pa.concat_batches([last, batch])
            g = held.column(0).to_numpy()
            same = g[1:] == g[:-1]
            kind = held.column(5).to_numpy()
            keep = np.r_[same, False] | np.r_[before is not None and before == g[0], same]
            keep = (keep | (kind == AGAIN) | (kind == SEVERAL)) & (kind != WITNESS)
            # the last row waits for its successor
            out = held.slice(0, len(g) - 1).filter(pa.array(keep[:-1]))
            if out.num_rows:
                yield out
            before = g[-2] if len(g) > 1 else before
            last = held.slice(len(g) - 1)
        if last is not None:
            kind = last.column(5)[0].as_py()
            if kind in (AGAIN, SEVERAL) or kind == SINGLE and before == last.column(0)[0].as_py():
                yield last

    to = F.when(F.col("kind") == SEVERAL, F.xxhash64("rid", "p")).otherwise(F.col("gram"))
    return found.repartition(to).sortWithinPartitions("gram").mapInArrow(run, FOUND)


def with_bytes(found: DataFrame, length: int) -> DataFrame:
    """``(gram, suffix, left, rid, p, a, b)`` from ``(rid, text, list of entries)``.
    An entry whose bytes the task has had at an earlier place is a repeat: it comes
    as the bytes a..b of its text, without suffix. So an entry that many texts
    share goes on a few times a task, not once a text."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]):
        seen: dict[bytes, tuple[int, int]] = {}  # entry -> its earliest place so far
        out: list[list] = [[] for _ in SCAN_ARROW]
        for batch, i, j in text_runs(batches):
            rid = batch.column("rid").slice(i, j - i).to_pylist()
            for r, t, es in zip(rid, utf8(batch, i, j), batch.column("es").slice(i, j - i).to_pylist()):
                for e in es:
                    a, p, b = e["a"], e["p"], e["b"] + length
                    key = xxhash.xxh3_128_digest(t[a:b], p - a)
                    place = (r, p)
                    first = seen.get(key)
                    again = first is not None and first < place
                    if not again:
                        seen[key] = place
                    for o, x in zip(out, (e["gram"], None if again else t[p:b], None if again else t[a:p], r, p, a, b)):
                        o.append(x)
                if len(seen) > SEEN:
                    seen.clear()
                if len(out[0]) >= 20_000:
                    yield rows(SCAN_ARROW, out)
                    out = [[] for _ in SCAN_ARROW]
        if out[0]:
            yield rows(SCAN_ARROW, out)

    return found.select("rid", "text", "es").mapInArrow(run, SEGMENT + ", a int, b int")


SEGMENT_NAMES = ["gram", "suffix", "left", "rid", "p"]
SEGMENT = "gram long, suffix binary, left binary, rid long, p int"
SEGMENT_ARROW = pa.schema([("gram", pa.int64()), ("suffix", pa.binary()), ("left", pa.binary()), ("rid", pa.int64()), ("p", pa.int32())])
SCAN_ARROW = pa.schema([*SEGMENT_ARROW, ("a", pa.int32()), ("b", pa.int32())])
SHARED_ARROW = pa.schema([("rid", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("key", pa.binary())])
RUN_LIMIT = 4096  # entries of the same selected bytes that are resolved in one place
ORDER = ["gram", "suffix", "left", "rid", "p"]


def suffix_array(segments: DataFrame, *by: str) -> DataFrame:
    """Entries in order, dealt out by their bytes, so that only equal ones meet
    and those of a frequent gram are spread; or by the columns ``by``."""
    return segments.repartition(*(by or ("gram", "suffix", "left"))).sortWithinPartitions(*ORDER)


def merge_scan(batch: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """One pass over the merged order of a batch and the older levels: the
    batch's entries as ``(gram, suffix, left, rid, p, a, b)``, where ``a..b`` are
    the bytes of the text they cover. Entries whose bytes stand in an older level
    or earlier in the batch come without them (null suffix)."""
    rows_ = batch.select(*SEGMENT_NAMES, F.lit(True).alias("fresh"))
    for level in levels:
        rows_ = rows_.unionByName(level.select(*SEGMENT_NAMES, F.lit(False).alias("fresh")))

    def run(batches):
        last = at = None
        for batch_ in batches:
            cols: list[list] = [[] for _ in SCAN_ARROW]
            for g, s, le, rid, p, fresh in zip(*(c.to_pylist() for c in batch_.columns)):
                key, place = (g, s, le), (rid, p)
                if fresh and place != at:  # repeated rows bring the same place again
                    new = key != last
                    for o, x in zip(cols, (g, s if new else None, le if new else None, rid, p, p - len(le), p + len(s))):
                        o.append(x)
                last, at = key, place
            if cols[0]:
                yield rows(SCAN_ARROW, cols)

    # document order is rid order and levels are older, so the first of equals is the earliest
    return suffix_array(rows_).mapInArrow(run, SEGMENT + ", a int, b int")


class Family:
    """Levels of suffix arrays; the rank of a level is the logarithm of the
    number of batches in it."""

    def __init__(self, made: list[DataFrame]):
        self.levels: dict[int, DataFrame] = {}
        self.made = made  # staged tables, for the caller to drop

    def add(self, batch: DataFrame) -> DataFrame:
        """Scan a batch, take it in, and return the repeated entries."""
        scanned = stage(merge_scan(batch, list(self.levels.values())), "suffix-scan")
        self.made.append(scanned)
        level, rank = scanned.where("suffix is not null").select(*SEGMENT_NAMES), 0
        while rank in self.levels:
            old = self.levels.pop(rank)
            level = stage(suffix_array(level.unionByName(old)), "suffix-level")
            self.made.append(level)
            rank += 1
        self.levels[rank] = level
        return scanned.where("suffix is null").select("rid", "a", "b")

    def all(self) -> DataFrame:
        first, *rest = self.levels.values()
        for x in rest:
            first = first.unionByName(x)
        return first


def shared_strings(array: DataFrame, length: int, limit: int = RUN_LIMIT, made: list[DataFrame] | None = None) -> DataFrame:
    """``(rid, a, b)``: the bytes of strings of the array's entries that stand
    earlier in another entry. Entries that can share strings have the same
    selected bytes and so are neighbours. Up to ``limit`` of them are resolved
    where they are, by a set of their strings; of more, which never meet in one
    task, the strings are emitted as hashes, and the earliest of each is found
    with partial aggregates."""
    import xxhash

    def run(batches):
        held: list[tuple] = []

        def resolve(out):
            seen: set[bytes] = set()
            for _, suffix, left, rid, p in sorted(held, key=lambda r: (r[3], r[4])):
                t, a = left + suffix, p - len(left)
                since = None
                own = []
                for k in range(len(t) - length + 1):
                    s = t[k : k + length]
                    own.append(s)
                    if s in seen:
                        since = k if since is None else since
                    elif since is not None:
                        emit(out, rid, a + since, a + k - 1 + length)
                        since = None
                if since is not None:
                    emit(out, rid, a + since, a + len(t))
                seen.update(own)

        def emit(out, rid, a, b, key=None):
            for o, x in zip(out, (rid, a, b, key)):
                o.append(x)

        for b in batches:
            out: list[list] = [[], [], [], []]
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and held[0][0] != row[0]:
                    if len(held) > 1:
                        resolve(out)
                    held = []
                held.append(row)
                if len(out[0]) >= 50_000:
                    yield rows(SHARED_ARROW, out)
                    out = [[], [], [], []]
            if out[0]:
                yield rows(SHARED_ARROW, out)
        out = [[], [], [], []]
        if len(held) > 1:
            resolve(out)
        if out[0]:
            yield rows(SHARED_ARROW, out)

    def strings(batches):
        for b in batches:
            out: list[list] = [[], [], [], []]
            for _, suffix, left, rid, p in zip(*(c.to_pylist() for c in b.columns)):
                t, a = left + suffix, p - len(left)
                for k in range(len(t) - length + 1):
                    for o, x in zip(out, (rid, a + k, a + k + length, xxhash.xxh3_128_digest(t[k : k + length]))):
                        o.append(x)
                if len(out[0]) >= 50_000:
                    yield rows(SHARED_ARROW, out)
                    out = [[], [], [], []]
            if out[0]:
                yield rows(SHARED_ARROW, out)

    schema = "rid long, a int, b int, key binary"
    crowds = stage(array.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("gram"), "suffix-crowds")
    few = suffix_array(array.join(crowds, "gram", "left_anti").select(*SEGMENT_NAMES), "gram").mapInArrow(run, schema)
    many = array.join(crowds, "gram", "left_semi").select(*SEGMENT_NAMES).mapInArrow(strings, schema)
    found = stage(few.unionByName(many), "suffix-shared")
    if made is not None:
        made += [crowds, found]
    hashed = found.where("key is not null")
    first = hashed.groupBy("key").agg(F.min(F.struct("rid", "a")).alias("f"))
    later = hashed.join(first, "key").where((F.col("rid") != F.col("f.rid")) | (F.col("a") != F.col("f.a")))
    return found.where("key is null").select("rid", "a", "b").unionByName(later.select("rid", "a", "b"))


def thinned(rows_: DataFrame) -> DataFrame:
    """Rows (sha, id, text), each id and text once a task or a little more, so
    that rows repeated very often are few before they are shuffled."""
    def run(batches):
        seen: set = set()
        for b in batches:
            pairs = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            new = []
            for x in pairs:
                new.append(x not in seen)
                seen.add(x)
            if any(new):
                yield b if all(new) else b.filter(pa.array(new))
            if len(seen) > SEEN:
                seen.clear()

    return rows_.select("sha", "id", "text").mapInArrow(run, "sha binary, id long, text string")


def repeats(df: DataFrame, key: str, text: str, made: list[DataFrame], length: int = LENGTH, gram: int = GRAM,
            batches: int = BATCHES) -> DataFrame:
    """``(sha, first_id, ranges)`` for each different text of ``df``: its
    smallest id (null ids as the largest long), and the byte ranges that repeat
    there, or null. Texts are matched to ``df`` by ``sha2(text, 256)``. ``made``
    gets the staged tables that the result is computed from."""
    sha = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rows_ = df.select(sha.alias("sha"), F.coalesce(F.col(key), F.lit(LAST_ID)).cast("long").alias("id"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
    firsts = stage(rows_.groupBy("sha").agg(F.min("id").alias("first_id")).orderBy("first_id", "sha")
                   .select("sha", "first_id", F.monotonically_increasing_id().alias("rid")), "texts")
    long_enough = thinned(rows_.where(F.octet_length("text") >= length))
    texts = long_enough.join(firsts, [long_enough.sha == firsts.sha, F.col("id") == F.col("first_id")]).select("rid", "text")
    made.append(firsts)
    hits = stage(recurring(entries(texts, length, gram)), "recurring")
    # a set, as a document can come from several tasks
    lists = hits.where(F.col("kind") != AGAIN).groupBy("rid").agg(F.collect_set(F.struct("gram", "a", "p", "b")).alias("es"))
    placed = lists.join(firsts, "rid").withColumnsRenamed({"sha": "sha_"})
    found = long_enough.join(placed, [F.col("sha") == F.col("sha_"), F.col("id") == F.col("first_id")]).select("rid", "text", "es")
    cuts = (firsts.agg(F.percentile_approx("rid", F.array(*[F.lit(i / batches) for i in range(1, batches)]))).first()[0] or []) if batches > 1 else []
    number = sum([(F.col("rid") > c).cast("int") for c in cuts], F.lit(0))
    segments = stage(with_bytes(found, length).withColumn("batch", number), "segments", "batch")
    made += [hits, segments]
    lost = hits.where(F.col("kind") == AGAIN).select("rid", "a", (F.col("b") + length).alias("b"))
    lost = lost.unionByName(segments.where("suffix is null").select("rid", "a", "b"))
    segments = segments.where("suffix is not null").select(*SEGMENT_NAMES, "batch")

    family = Family(made)
    for i in range(len(cuts) + 1):
        lost = lost.unionByName(family.add(segments.where(F.col("batch") == i)))
    lost = lost.unionByName(shared_strings(family.all(), length, made=made))
    ranges = lost.groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    return firsts.join(ranges, "rid", "left").select("sha", "first_id", "ranges")


def merged(ranges, n: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in ranges or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def removed(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
            batches: int = BATCHES) -> DataFrame:
    """``(key, text, later, ranges)`` for each row: ``later`` marks a copy of a
    text with a smaller id, of which everything goes if it is long enough."""
    made: list[DataFrame] = []
    verdict = stage(repeats(df, key, text, made, length, gram, batches), "verdict")
    for x in made:
        drop_staged(x)
    left = df.withColumn("sha__", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    joined = left.join(verdict, F.col("sha__") == F.col("sha"))
    later = (F.coalesce(F.col(key), F.lit(LAST_ID)) != F.col("first_id")) & (F.octet_length(text) >= length)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(later, F.lit(False)).alias("later__"), F.col("ranges").alias("ranges__"))


def _kept(t: bytes, later: bool, ranges) -> tuple[bytes, list[tuple[int, int]]]:
    gone = [(0, len(t))] if later else merged(ranges, len(t))
    at, kept = 0, []
    for a, b in gone:
        kept.append(t[at:a])
        at = b
    return b"".join([*kept, t[at:]]), gone


def query(spark, sf_dir: str) -> DataFrame:
    def digest(batches):
        for batch, i, j in text_runs(batches):
            ids, later, ranges = (batch.column(c).slice(i, j - i) for c in ("doc_id", "later__", "ranges__"))
            out: list[list] = [[], [], [], []]
            for t, la, r in zip(utf8(batch, i, j), later.to_pylist(), ranges.to_pylist()):
                kept, gone = _kept(t, la, r)
                for o, x in zip(out, (len(t), len(t) - len(kept), len(gone), hashlib.sha256(kept).hexdigest())):
                    o.append(x)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(o) for o in out)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def stage_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages are cut out of the texts. A character
    of which a cut takes some bytes goes whole; a document that loses all its
    text stays, empty. Texts without a repeat, null included, are unchanged."""
    row, new = unused_name(docs, "row_n"), unused_name(docs, "new_text")

    def cut(batches):
        for batch, i, j in text_runs(batches):
            later, ranges = (batch.column(c).slice(i, j - i).to_pylist() for c in ("later__", "ranges__"))
            out = [_kept(t, la, r)[0].decode("utf-8", "ignore") for t, la, r in zip(utf8(batch, i, j), later, ranges)]
            yield pa.RecordBatch.from_arrays([batch.column("n").slice(i, j - i), pa.array(out, pa.string())], ["n", "t"])

    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "repeats-input")
    found = removed(numbered.select("doc_id", "text", F.col(row).alias("n")))
    touched = found.where("later__ or ranges__ is not null").mapInArrow(cut, "n long, t string").withColumnsRenamed({"n": "cut_n", "t": new})
    out = numbered.join(touched, F.col(row) == F.col("cut_n"), "left")
    text = F.coalesce(F.col(new), F.col("text"))
    return out.select(*[text.alias(c) if c == "text" else F.when(F.col(new).isNotNull(), F.length(new).cast("long")).otherwise(F.col(c)).alias(c)
                        if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
