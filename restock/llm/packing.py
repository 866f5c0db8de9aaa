"""Packing of tokenised documents into fixed windows by multiway differencing.

A document is its token ids and an end id. It is cut into whole windows and a
rest, the rest again at ``piece`` ids, so that there are several pieces a window
to balance. Whole windows stand alone. The other pieces of a task are taken some
thousands at a time (in input order, no shuffle) and partitioned into windows by
Karmarkar-Karp multiway differencing: every piece starts as a partial partition
of its own; the two partial partitions with the largest difference between
largest and smallest part merge, the largest parts of one with the smallest of
the other, until one is left. If a window then exceeds the capacity, the number
of windows rises and the pieces are partitioned again.

Ids are those of the tokenizer file, whose path is a parameter: texts are
normalised and split into words as that file says, and each different word is
encoded once, by the merges of that file, and remembered (a bounded cache);
texts with characters beyond U+02FF, ASCII separators or the special tokens'
strings are encoded whole by the ``tokenizers`` library, as are long words. The
tests hold the ids against the library's.

A null text is empty; a document without ids is its end id. Repeated rows are
packed each for itself. Sequence ids are unique and ascending within a task:
task number * 2**33 + count.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import table, text_runs, utf8

CAPACITY = 2048
PIECE = 512
END = 1
GROUP = 8192  # pieces that are partitioned together
CACHE = 1_000_000  # words remembered by a worker, about 200 bytes each
LONG_WORD = 64
NEVER = 1 << 30
SPECIAL = ("<|startoftext|>", "<|endoftext|>")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Token ids of texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        model = json.loads(self.tokenizer.to_str())["model"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.id_of = {piece: np.array([i], "<u4").tobytes() for piece, i in model["vocab"].items()}
        # byte -> the character that stands for it: printable ones for themselves, the others from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.symbol = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        low = [chr(i) for i in range(0x300)]
        kind = {c: unicodedata.category(c)[0] for c in low}
        chars = {k: re.escape("".join(c for c in low if kind[c] == k)) for k in "LN"}
        space = r" \t\n\x0b\x0c\r\x85\xa0"
        # the split pattern of the tokenizer file, over the characters below U+0300
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{chars['L']}]+|[{chars['N']}]|[^{space}{chars['L']}{chars['N']}]+").findall
        self.rare = re.compile(r"[\x1c-\x1fİ̀-\U0010ffff]|" + "|".join(map(re.escape, SPECIAL))).search

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Ids of one word: the pair of lowest rank merges first, leftmost first."""
        if len(word) > LONG_WORD:
            return self.whole(word)
        sym = [self.symbol[b] for b in word.encode()]
        sym[-1] += "</w>"
        rank = self.rank.get
        ranks = [rank(p, NEVER) for p in zip(sym, sym[1:])]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            sym[i : i + 2] = [sym[i] + sym[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((sym[i - 1], sym[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank((sym[i], sym[i + 1]), NEVER)
        return b"".join(map(self.id_of.__getitem__, sym))

    def __call__(self, text: str) -> bytes:
        if self.rare(text):
            return self.whole(text)
        words, cache = self.split(text.lower()), self.cache
        new = set(words).difference(cache)
        if new:
            if len(cache) + len(new) > CACHE:
                cache.clear()
                new = set(words)
            for w in new:
                cache[w] = self.word(w)
        return b"".join(map(cache.__getitem__, words))


@lru_cache(None)
def words(path: str) -> Words:
    return Words(path)


def difference(sizes: list[int], m: int) -> tuple[list[int], list[list[int]]]:
    """Multiway differencing of ``sizes`` into ``m`` parts: sums and members."""
    left: list = [None] * len(sizes)  # joined parts as a binary forest: node -> its two
    heap: list = []
    for i, s in enumerate(sizes):
        heap.append((-s if m > 1 else 0, i, np.array([s], np.int64), np.array([i], np.int64)))
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, s1, i1 = heapq.heappop(heap)
        _, _, s2, i2 = heapq.heappop(heap)
        over = len(s1) + len(s2) - m
        if over > 0:  # the ``over`` smallest of each meet: largest with smallest
            a, b = len(s1) - over, len(s2) - over
            sums = np.concatenate([s1[:a], s2[:b], s1[a:] + s2[b:][::-1]])
            joined = np.arange(len(left), len(left) + over)
            left.extend(zip(i1[a:].tolist(), i2[b:][::-1].tolist()))
            ids = np.concatenate([i1[:a], i2[:b], joined])
        else:
            sums, ids = np.concatenate([s1, s2]), np.concatenate([i1, i2])
        order = np.argsort(-sums, kind="stable")
        sums, ids = sums[order], ids[order]
        n += 1
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == m else 0)), n, sums, ids))
    members = []
    for node in heap[0][3].tolist():
        stack, own = [node], []
        while stack:
            x = stack.pop()
            if left[x] is None:
                own.append(x)
            else:
                stack.extend(left[x])
        members.append(sorted(own))
    return heap[0][2].tolist(), members


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Partition pieces into as few near-equal windows as differencing finds."""
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        sums, members = difference(sizes, m)
        if max(sums) <= capacity:
            return members
        m += max(1, m // 200)


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, piece: int = PIECE,
         group: int = GROUP) -> DataFrame:
    """One row per piece: ``key, start, length, ids binary, doc_tokens,
    sequence_id, offset``; ids are little-endian unsigned 32-bit numbers."""
    if not 0 < piece <= capacity:
        raise ValueError("piece must be between 1 and the capacity")
    kind = df.schema[key].dataType.simpleString()
    names = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        ids_of = words(path)
        wait: list[tuple] = []

        def flush(some):
            nonlocal number
            out = []
            for own in windows([x[2] for x in some], capacity) if some else []:
                at = 0
                for i in own:
                    out.append((*some[i], number, at))
                    at += some[i][2]
                number += 1
            return out

        def batch_of(out):
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], type_of_key), *(pa.array(c, pa.binary() if n == "ids" else pa.int64())
                                               for n, c in zip(names[1:], cols[1:]))], names)

        type_of_key = None
        for batch, a, b in text_runs(batches):
            type_of_key = batch.column("key").type
            out = []
            for k, t in zip(batch.column("key").slice(a, b - a).to_pylist(), utf8(batch, a, b)):
                ids = ids_of(t.decode()) + end
                n = len(ids) // 4
                whole = n - n % capacity
                for start in [*range(0, whole, capacity), *range(whole, n, piece)]:
                    size = capacity if start < whole else min(piece, n - start)
                    row = (k, start, size, ids[4 * start : 4 * (start + size)], n)
                    if size == capacity:
                        out.append((*row, number, 0))
                        number += 1
                    else:
                        wait.append(row)
            while len(wait) >= 2 * group:
                out += flush(wait[:group])
                wait = wait[group:]
            if out:
                yield batch_of(out)
        if wait:  # fewer than two groups are left: one partition of all is better than a small last one
            yield batch_of(flush(wait))

    return (df.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
            .withColumnRenamed("key", key))


def query(spark, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def stage_packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of all documents with their ids."""
    return pack(docs.select("doc_id", "text"), tokenizer_path())
