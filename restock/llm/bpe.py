"""BPE encoding and decoding by a priority queue of merge ranks.

The tokenizer file (its path is a parameter) gives the vocabulary, the merges in
the order of their ranks, the words' end mark and the special tokens. A word
becomes a doubly linked list of symbols, one for each of its bytes, the last with
the end mark; a priority queue holds the adjacent pairs that have a rank, lowest
rank first, then leftmost. Each pair that is taken from it merges, unless the
entry is stale: one of its symbols has merged meanwhile, or has another
neighbour. A merge enters the pairs that it makes with the symbols before and
after. Words of any length take n log n steps; shorter ones are remembered (a
bounded cache).

Texts are cut at the special tokens' strings, which have ids of their own, then
normalised and split into words as the file says: here, for the characters below
U+0300 whose rules are written out, else by the normaliser and the splitter that
the ``tokenizers`` library reads from the file. The merges are always those of
this module. Truncation and padding are not used, and no special token is added.

Decoding concatenates the vocabulary strings of the ids, with a blank between two
as the library does for a file without a decoder; ids without a string are left
out.

A null or empty text has no ids; null ids decode to null, no ids to the empty
text. Texts are encoded whole. Each row is encoded for itself, so repeated rows
and ties need no rule; columns of other names are left as they are.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import table, text_runs, unused_name, utf8

CACHE = 400_000  # words remembered by a worker, about 200 bytes each
LONG = 64  # bytes of a word beyond which it isn't remembered


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves,
    the others from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in shown else spare))
        spare += b not in shown
    return out


class Bpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        file = json.loads(self.tokenizer.to_str())
        model = file["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("unk_token") \
                or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("a BPE file over bytes is wanted, without unknown token, prefixes or dropout")
        self.mark = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.strings: dict[int, str] = {i: s for s, i in vocab.items()}
        #: pair of ids -> rank and id of the piece that they make
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        symbols = byte_symbols()
        self.inner = {c: vocab.get(c) for c in symbols}
        self.last = {c: vocab.get(c + self.mark) for c in symbols}
        self.to_symbols = {b: symbols[b] for b in range(256)}
        self.special = {}
        for t in file["added_tokens"]:
            if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("special tokens with conditions are not supported")
            self.special[t["content"]] = t["id"]
            self.strings[t["id"]] = t["content"]
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.plain = self._plain(file)
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _plain(file: dict):
        """The split of lower-cased texts into words and the search for what it
        can't do, if the file's rules are those written out here."""
        rules = [x["type"] for x in (file["normalizer"] or {}).get("normalizers", [])]
        split = ((file["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        pattern = (split.get("pattern") or {}).get("Regex")
        if rules != ["NFC", "Replace", "Lowercase"] or pattern != r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+":
            return None
        by = {"L": "", "N": "", "S": r" \t-\r\x85\xa0"}
        for c in map(chr, range(0x300)):
            if (kind := unicodedata.category(c)[0]) in "LN":
                by[kind] += re.escape(c)
        return (re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{by['L']}]+|[{by['N']}]|[^{by['S']}{by['L']}{by['N']}]+").findall,
                re.compile("[\x1c-\x1fİ̀-\U0010ffff]").search)  # İ becomes two characters

    def merge(self, word: str) -> list[int]:
        """Ids of a word, which is given as the characters that stand for its bytes."""
        inner = self.inner
        sym = [inner[c] for c in word[:-1]]
        sym.append(self.last[word[-1]])
        if None in sym:  # bytes that the vocabulary lacks are left out
            sym = [s for s in sym if s is not None]
        n, merges = len(sym), self.merges
        # entries: rank, id made, places of the left and the right symbol
        queue = [(*m, i, i + 1) for i, pair in enumerate(zip(sym, sym[1:])) if (m := merges.get(pair))]
        if not queue:
            return sym
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            rank, made, i, j = heapq.heappop(queue)
            if sym[i] < 0 or after[i] != j or merges.get((sym[i], sym[j])) != (rank, made):
                continue  # stale
            sym[i], sym[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((made, sym[k])):
                    heapq.heappush(queue, (*m, i, k))
            h = before[i]
            if h >= 0 and (m := merges.get((sym[h], made))):
                heapq.heappush(queue, (*m, h, i))
        return [s for s in sym if s >= 0]

    def _packed(self, symbols: str) -> bytes:
        return np.array(self.merge(symbols), "<u4").tobytes()

    def _words(self, text: str) -> bytes:
        """Ids of a text between two special tokens."""
        cache, symbols = self.cache, self.to_symbols
        if self.plain and not self.plain[1](text):
            words = self.plain[0](text.lower())
            new = set(words).difference(cache)
            if new:
                if len(cache) + len(new) > CACHE:
                    cache.clear()
                    new = set(words)
                out = cache if all(len(w) <= LONG for w in new) else {w: cache[w] for w in set(words) - new}
                for w in new:
                    out[w] = self._packed(w.encode().decode("latin-1").translate(symbols))
                return b"".join([out[w] for w in words])
            return b"".join([cache[w] for w in words])
        norm = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        return b"".join([self._packed(w) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(norm) if w])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not self.specials:
            return self._words(text)
        parts = self.specials.split(text)
        for i, part in enumerate(parts):
            parts[i] = np.array([self.special[part]], "<u4").tobytes() if i % 2 else self._words(part)
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        numbers = np.frombuffer(ids, "<u4").tolist()
        try:
            return " ".join([strings[i] for i in numbers])
        except KeyError:
            return " ".join([strings[i] for i in numbers if i in strings])


@lru_cache(4)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` without ``text``, with ``out``: the ids as binary, little-endian
    unsigned 32-bit numbers. A column named as ``out`` is replaced."""
    return _mapped(df, path, text, out, "binary")


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` without ``ids``, with ``out``: the decoded texts."""
    return _mapped(df, path, ids, out, "string")


def _mapped(df: DataFrame, path: str, column: str, out: str, kind: str) -> DataFrame:
    kept = [f for f in df.schema if f.name.lower() not in (column.lower(), out.lower())]
    work = unused_name(df, "bpe_work")  # no clash with any column, whatever ``out`` is
    some = df.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{column}`").alias(work))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{work}` {kind}"])

    def run(batches):
        b = bpe(path)
        for batch, first, last in text_runs(batches, work):
            col = batch.column(work).slice(first, last - first)
            if kind == "binary":
                new = pa.array([b.encode(t.decode()) for t in utf8(batch, first, last, work)], pa.binary())
            else:
                new = pa.array([None if x is None else b.decode(x) for x in col.to_pylist()], pa.string())
            rest = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([*rest.columns[:-1], new], batch.schema.names)

    return some.mapInArrow(run, schema).withColumnRenamed(work, out)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document's number of ids, their SHA-256, and that of the decoded text."""
    path = tokenizer_path()
    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    both = decode(ids.withColumn("kept_ids", F.col("ids")), path)
    return both.select("doc_id", (F.octet_length("kept_ids") / 4).cast("long").alias("n_tokens"), F.sha2("kept_ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
