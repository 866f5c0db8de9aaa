"""Subword encoding with seeded merge-dropout, and its decoding.

The vocabulary is that of a merge-type SentencePiece model file (its path is a
parameter) with pieces for single bytes. A text becomes symbols, one a
character (blanks as U+2581, one put in front); an agenda holds the adjacent
pairs that make a piece, best score first, then leftmost; each candidate that is
taken from it is skipped if a keyed hash of the seed, the segment, the place and
the piece falls below ``dropout``, else the pair merges and new pairs enter.
Characters that are no piece become byte pieces; so does U+2581 itself, which
makes decoding give back every text exactly, whatever was skipped. Without
dropout the ids are those of the library.

Merges cannot cross from one segment of a text to the next (:class:`Encoder`
derives the segments from the vocabulary: a cut lies where no piece joins the
two characters), so segments are encoded apart. The key of the hash has the seed,
the document, the segment's place in it, the symbol's place in the segment and
the piece, so each occurrence of a word is skipped for itself. What is remembered
(in a bounded cache) doesn't depend on the key: a segment's candidates, in order,
and its ids without a skip. The hashes of all occurrences are tested against these
candidates at once; an occurrence without a skip takes the remembered ids, the
others go through the agenda, thousands of them side by side: in each step, every
segment takes its best candidate and skips or merges it. Segments of more than
``LONG`` symbols have a heap each.

A null or empty text has no ids. Texts are encoded whole; repeated rows (same id
and text) are encoded alike.
"""

from __future__ import annotations

import heapq
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import table, text_runs, utf8

BLANK = "▁"
DROPOUT = 0.1
SEED = 20
CACHE = 700_000  # segments remembered by a worker, about 300 bytes each
LONG = 64  # symbols beyond which the agenda is a heap
ROWS = 1 << 14  # segments side by side
NEVER = (1 << 31) - 1
WORD = (1 << 64) - 1


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def mixed(keys: np.ndarray) -> np.ndarray:
    """Keys of occurrences, from the document's number plus the segment's place."""
    keys = keys * np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(32)
    keys *= np.uint64(0xD6E8FEB86659FD93)
    return keys ^ keys >> np.uint64(32)


def hashed(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The keyed hash of candidates, given as place << 32 | cost; see ``_skipped``."""
    h = (keys ^ codes) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


class Pairs:
    """Cost and piece of pairs of symbols: a table with open addressing, looked
    up for many pairs at once."""

    def __init__(self, found: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([a << 32 | b for a, b in found], np.uint64)
        values = np.array(list(found.values()), np.int32).reshape(-1, 2)
        self.shift = np.uint64(64 - max(4, (8 * len(found)).bit_length()))
        size = 1 << 64 - int(self.shift)
        self.keys = np.full(size, (1 << 64) - 1, np.uint64)
        self.values = np.zeros((size, 2), np.int32)
        self.probes = 0
        left = np.arange(len(keys))
        while len(left):
            at = self._slot(keys[left], self.probes)
            self.probes += 1
            free = left[self.keys[at] == (1 << 64) - 1]
            at = self._slot(keys[free], self.probes - 1)
            at, first = np.unique(at, return_index=True)
            self.keys[at], self.values[at] = keys[free[first]], values[free[first]]
            left = np.setdiff1d(left, free[first])

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        at = (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        return (at + probe) & (len(self.keys) - 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs (``NEVER`` for no piece) and pieces."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        cost, made = np.full(len(keys), NEVER, np.int32), np.zeros(len(keys), np.int32)
        left = np.arange(len(keys))
        for probe in range(self.probes):
            at = self._slot(keys[left], probe)
            there = self.keys[at]
            hit = there == keys[left]
            cost[left[hit]], made[left[hit]] = self.values[at[hit]].T
            left = left[~hit & (there != (1 << 64) - 1)]
            if not len(left):
                break
        return cost, made


class Encoder:
    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.ids: dict[str, int] = {}
        scores: dict[str, float] = {}
        self.bytes_: list[int | None] = [None] * 256
        self.out: list[bytes] = [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes_[value], self.out[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece], scores[piece] = i, -sp.get_score(i)
                self.out[i] = piece.replace(BLANK, " ").encode()
        # the place of a piece's score among all scores: best first, equal scores equal
        place = {s: k for k, s in enumerate(sorted(set(scores.values())))}
        self.cost = {piece: place[s] for piece, s in scores.items()}
        self.packed = {piece: np.array([i], "<u4").tobytes() for piece, i in self.ids.items()}
        if None in self.bytes_:
            raise ValueError("the model has no pieces for single bytes")
        self.limit = int(dropout * 2**64)
        self.seed = seed
        self.memo: dict[str, tuple[bytes, bytes]] = {}  # segment -> ids and candidates without a skip
        # symbols as numbers: pieces by their ids, other characters from n on
        self.n = n
        self.symbol_of = np.arange(n, n + 0x110000, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        symbol = lambda s: self.ids.get(s, n + ord(s) if len(s) == 1 else None)
        pairs = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                a, b = symbol(piece[:k]), symbol(piece[k:])
                if a is not None and b is not None:
                    pairs[a, b] = self.cost[piece], i
        self.pairs = Pairs(pairs)
        self.segments = self._segments()
        self.blank_bytes = np.array([self.bytes_[b] for b in BLANK.encode()], "<u4").tobytes()

    def _segments(self):
        """A pattern whose matches cut a text only where no piece joins two
        characters: classes of characters that stand side by side in pieces."""
        root: dict[str, str] = {}

        def find(c):
            while root.setdefault(c, c) != c:
                c = root[c]
            return c

        for piece in self.ids:
            tail = piece.lstrip(BLANK)
            if BLANK in tail:  # pieces go on after a blank: leave texts whole
                return re.compile(".+", re.S).findall
            for a, b in zip(tail, tail[1:]):
                root[find(a)] = find(b)
        classes: dict[str, list[str]] = {}
        for c in root:
            classes.setdefault(find(c), []).append(c)
        runs = ["[" + re.escape("".join(sorted(c))) + "]+" for c in sorted(classes.values(), key=len, reverse=True) if len(c) > 1 or any(x[0] * 2 in self.ids for x in c)]
        return re.compile(f"{BLANK}*(?:{'|'.join([*runs, f'[^{BLANK}]'])})|{BLANK}+", re.S).findall

    def merge(self, segment: str, key: int) -> bytes:
        """Agenda processing of one segment under a key."""
        return self._joined(self._short(segment, key) if len(segment) <= LONG else self._long(segment, key))

    def _joined(self, symbols: list[str]) -> bytes:
        return b"".join([self.packed.get(s) or self._bytes(s) for s in symbols])

    def agenda(self, segments: list[str], keys: np.ndarray | None) -> tuple[list[bytes], list[bytes]]:
        """Ids of segments of up to ``LONG`` symbols, and the candidates that each
        took from its agenda, in order; without keys none is skipped."""
        ids, codes = [b""] * len(segments), [b""] * len(segments)
        sizes = np.array([len(s) for s in segments])
        by = np.argsort(sizes, kind="stable")
        for k in range(0, len(by), ROWS):
            some = by[k : k + ROWS]
            own = [segments[i] for i in some.tolist()]
            for i, x, c in zip(some.tolist(), *self._side_by_side(own, sizes[some], None if keys is None else keys[some])):
                ids[i], codes[i] = x, c
        return ids, codes

    def _side_by_side(self, segments: list[str], sizes: np.ndarray, keys: np.ndarray | None):
        rows_, width = len(segments), int(sizes[-1])
        there = np.arange(width) < sizes[:, None]
        sym = np.full((rows_, width), -1, np.int32)
        sym[there] = self.symbol_of[np.frombuffer("".join(segments).encode("utf-32-le"), "<u4")]
        after = np.tile(np.arange(1, width + 1), (rows_, 1))
        before = np.tile(np.arange(-1, width - 1), (rows_, 1))
        cost, made = np.full((rows_, width), NEVER, np.int32), np.zeros((rows_, width), np.int32)
        r, i = np.nonzero(there[:, 1:])
        cost[r, i], made[r, i] = self.pairs(sym[r, i], sym[r, i + 1])
        row = np.arange(rows_)
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while len(row):
            i = cost[row].argmin(axis=1)
            c = cost[row, i]
            open_ = c != NEVER
            row, i, c = row[open_], i[open_], c[open_]
            code = i.astype(np.uint64) << np.uint64(32) | c.astype(np.uint64)
            if keys is None:
                taken.append((row, code))
                r = row
            else:
                skip = hashed(keys[row], code) <= np.uint64(self.limit - 1)
                cost[row[skip], i[skip]] = NEVER
                r, i = row[~skip], i[~skip]
            j = after[r, i]
            k = after[r, j]
            sym[r, i] = piece = made[r, i]
            sym[r, j] = -1
            cost[r, j] = NEVER
            after[r, i] = k
            more = k < sizes[r]
            cost[r, i] = NEVER
            x, y, z = r[more], i[more], k[more]
            before[x, z] = y
            cost[x, y], made[x, y] = self.pairs(piece[more], sym[x, z])
            g = before[r, i]
            more = g >= 0
            x, y = r[more], g[more]
            cost[x, y], made[x, y] = self.pairs(sym[x, y], piece[more])
        return self._ids_of(sym), self._in_rows(taken, rows_)

    def _ids_of(self, sym: np.ndarray) -> list[bytes]:
        alive = sym >= 0
        flat = sym[alive]
        ends = np.cumsum(alive.sum(axis=1)) * 4
        data = flat.astype("<u4").tobytes()
        out = [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for i in np.flatnonzero((sym >= self.n).any(axis=1)).tolist():  # characters that are no piece
            out[i] = b"".join([np.array([s], "<u4").tobytes() if s < self.n else self._bytes(chr(s - self.n)) for s in sym[i][alive[i]].tolist()])
        return out

    @staticmethod
    def _in_rows(taken, rows_: int) -> list[bytes]:
        if not taken:
            return [b""] * rows_
        row = np.concatenate([r for r, _ in taken])
        order = np.argsort(row, kind="stable")
        data = np.concatenate([c for _, c in taken])[order].astype("<u8").tobytes()
        ends = np.cumsum(np.bincount(row, minlength=rows_)) * 8
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _bytes(self, symbol: str) -> bytes:
        return np.array([self.bytes_[b] for b in symbol.encode()], "<u4").tobytes()

    def _skipped(self, place: int, cost: int, key: int) -> bool:
        """The keyed hash of a candidate, below the limit; the key has the seed,
        the document and the segment's place, and the cost stands for the piece."""
        h = (key ^ (place << 32 | cost)) * 0x9E3779B97F4A7C15 & WORD
        return ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 & WORD) < self.limit

    def _short(self, segment: str, key: int) -> list[str]:
        """The agenda as a list: the cost of each adjacent pair, or never. The
        hash is that of :meth:`_skipped`, written out in the loop."""
        sym, cost, limit = list(segment), self.cost.get, self.limit
        costs = [cost(a + b, NEVER) for a, b in zip(sym, sym[1:])]
        starts = list(range(len(sym)))
        while costs:
            least = min(costs)
            if least == NEVER:
                break
            i = costs.index(least)
            if limit:
                h = (key ^ (starts[i] << 32 | least)) * 0x9E3779B97F4A7C15 & WORD
                if ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 & WORD) < limit:
                    costs[i] = NEVER
                    continue
            piece = sym[i] + sym[i + 1]
            sym[i : i + 2] = (piece,)
            del costs[i], starts[i + 1]
            if i:
                costs[i - 1] = cost(sym[i - 1] + piece, NEVER)
            if i < len(costs):
                costs[i] = cost(piece + sym[i + 1], NEVER)
        return sym

    def _long(self, segment: str, key: int) -> list[str]:
        """The agenda as a heap."""
        sym = list(segment)
        n, cost, skip = len(sym), self.cost.get, self.limit > 0
        agenda = [(c, i, p) for i, p in enumerate(a + b for a, b in zip(sym, sym[1:])) if (c := cost(p)) is not None]
        heapq.heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            c0, i, p = heapq.heappop(agenda)
            j = after[i]
            if not sym[i] or j >= n or len(sym[i]) + len(sym[j]) != len(p):
                continue  # one of the two has merged meanwhile
            if skip and self._skipped(i, c0, key):
                continue
            sym[i], sym[j] = p, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (c := cost(q := p + sym[k])) is not None:
                    heapq.heappush(agenda, (c, i, q))
            h = before[i]
            if h >= 0 and (c := cost(q := sym[h] + p)) is not None:
                heapq.heappush(agenda, (c, h, q))
        return [s for s in sym if s]

    def encode(self, text: str, number: int = 0) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers; ``number``: the
        document's, of 64 bits, for the key."""
        return self.encode_all([text], [number])[0]

    def encode_all(self, texts: list[str], numbers: list[int]) -> list[bytes]:
        """Ids of some texts, whose segments are processed together."""
        segments: list[str] = []
        bases: list[int] = []
        cuts: list[tuple[int, bool]] = []  # of each part of a text: where its segments end, and whether the text does
        for text, number in zip(texts, numbers):
            begun = len(segments)
            parts = text.split(BLANK)
            for k, part in enumerate(parts):
                if text:
                    segments += self.segments((BLANK if k == 0 else "") + part.replace(" ", BLANK))
                cuts.append((len(segments), k == len(parts) - 1))
            bases += [xxhash.xxh64_intdigest(number.to_bytes(8, "little"), self.seed) - begun & WORD] * (len(segments) - begun)
        ids = self._encoded(segments, mixed(np.array(bases, np.uint64) + np.arange(len(segments), dtype=np.uint64)))
        out, own, at = [], [], 0
        for end, whole in cuts:
            own += ids[at:end]
            at = end
            if whole:
                out.append(b"".join(own))
                own = []
            else:
                own.append(self.blank_bytes)
        return out

    def _encoded(self, segments: list[str], keys: np.ndarray) -> list[bytes]:
        """Ids of occurrences of segments under their keys."""
        if not segments:
            return []
        memo = self.memo
        new = set(segments).difference(memo)
        long = {s for s in new if len(s) > LONG}
        new -= long
        if len(memo) + len(new) > CACHE:
            memo.clear()
            new = set(segments) - long
        if new:
            some = list(new)
            memo.update(zip(some, zip(*self.agenda(some, None))))
        if long:
            known = [memo[s] if s not in long else (self.merge(s, k), b"") for s, k in zip(segments, keys.tolist())]
        else:
            known = [memo[s] for s in segments]
        ids = [x[0] for x in known]
        for at in range(0, len(segments) if self.limit else 0, ROWS):
            codes = [x[1] for x in known[at : at + ROWS]]
            sizes = np.fromiter(map(len, codes), np.int64, len(codes)) >> 3
            hit = hashed(np.repeat(keys[at : at + ROWS], sizes), np.frombuffer(b"".join(codes), "<u8")) <= np.uint64(self.limit - 1)
            ends = np.cumsum(sizes)
            which = at + np.unique(np.searchsorted(ends, np.flatnonzero(hit), "right"))
            found, _ = self.agenda([segments[i] for i in which.tolist()], keys[which])
            for i, x in zip(which.tolist(), found):
                ids[i] = x
        return ids

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.out.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return text[1:].decode()  # without the blank put in front


@lru_cache(8)
def encoder(path: str, dropout: float, seed: int) -> Encoder:
    return Encoder(path, dropout, seed)


def number_of(key) -> int:
    """A document's number of 64 bits, from its id."""
    return xxhash.xxh64_intdigest(str(key).encode())


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``(key, ids binary)``: little-endian unsigned 32-bit ids of every text."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        e = encoder(path, dropout, seed)
        for batch, a, b in text_runs(batches):
            keys = batch.column("key").slice(a, b - a)
            out = e.encode_all([t.decode() for t in utf8(batch, a, b)], [number_of(k) for k in keys.to_pylist()])
            yield pa.RecordBatch.from_arrays([keys, pa.array(out, pa.binary())], ["key", "ids"])

    return (df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids binary")
            .withColumnRenamed("key", key))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with ``out``: the texts of the ids; null ids as null."""
    keep = [c for c in df.columns if c.lower() != out.lower()]
    some = df.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.schema)

    def run(batches):
        e = encoder(path, 0.0, 0)
        for b in batches:
            texts = [None if x is None else e.decode(x) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, out])

    return some.mapInArrow(run, f"{schema}, `{out}` string")


def query(spark, sf_dir: str) -> DataFrame:
    """Each document's number of ids, their CRC-32, and that of the decoded
    text beside the original's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = model_path()

    def run(batches):
        e = encoder(path, DROPOUT, SEED)
        for batch, a, b in text_runs(batches):
            keys = batch.column("doc_id").slice(a, b - a)
            out: list[list] = [[], [], [], []]
            texts = utf8(batch, a, b)
            for t, ids in zip(texts, e.encode_all([t.decode() for t in texts], [number_of(k) for k in keys.to_pylist()])):
                for o, x in zip(out, (len(ids) // 4, zlib.crc32(ids), zlib.crc32(t), zlib.crc32(e.decode(ids).encode()))):
                    o.append(x)
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(o, pa.int64()) for o in out)],
                                             ["doc_id", "n_ids", "ids_crc32", "text_crc32", "decoded_crc32"])

    return docs.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, text_crc32 long, decoded_crc32 long")
