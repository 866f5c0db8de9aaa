"""Secret scans: fixed patterns, and character Markov models of random strings
and of ordinary identifiers compared by log-likelihood ratio.

Native: positions, training counts, scores and redaction are SQL functions
only. A text is scanned whole; a null text counts as empty and has no spans.
Offsets are code points, ends exclusive.

* base kinds (:data:`KINDS`): leftmost non-overlapping matches of a pattern;
  matches that fail the kind's length test are dropped after matching;
* ``markov``: maximal runs of identifier characters, less the base spans in them;
  the pieces of :data:`MIN_LENGTH` or more that hold a letter, and whose
  characters are more likely by at least ``min_llr`` nats under the model of random strings. Runs of
  digits and signs alone (order, card and phone numbers) are no candidates.

Both models are first-order chains over the identifier characters, with a start
state, backed off to single characters with one pseudo-count each, trained by counting character pairs of
labelled samples (:func:`train`); the model is one row of counts for each pair,
at most 2 x 66 x 66 rows whatever the samples' number. Empty samples give equal
models, whose ratio is 0, so no span is added. Repeated rows are scanned each
for itself; other columns are kept as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.llm.common import stage, table, unused_name

# fixed values: the kinds in their order, patterns, and least lengths
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA[A-Z0-9]+)",
    "hex": r"([0-9a-f]+)",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
# A run of fewer characters than the least length cannot be part of a longer
# match of the same kind, so these two may be matched with the length inside.
PATTERNS["access"] = r"(AKIA[A-Z0-9]{16,})"
PATTERNS["hex"] = r"([0-9a-f]{24,})"

# What must come right after a keyword of ``assign``, and the keywords' last
# letters: a cheap test that spares most texts the search for the keywords.
NEAR_ASSIGN = r"""[DTNYdtny]["']?\x20*[:=]"""

ALPHABET = "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
CLASS = "[A-Za-z0-9+/_=-]"
MIN_LENGTH = 16
TOKEN = rf"(?<!{CLASS}){CLASS}{{{MIN_LENGTH},}}"
ORDINARY = rf"(?<!{CLASS}){CLASS}{{8,}}"
MIN_LLR = 12.0
BACKOFF = 8.0  # weight of the single-character model in each transition
MASK = "[SECRET]"
FIRST, WIDTH = 32, 96  # table rows and columns are ASCII 32..127; 32 is the start state


def _hit(text: Column, pattern: str) -> Column:
    hit = text.rlike(pattern)
    return text.rlike(NEAR_ASSIGN) & hit if pattern == PATTERNS["assign"] else hit


def _found(text: Column, pattern: str, group: int) -> tuple[Column, Column]:
    """The pieces between matches, and for each match its text and group."""
    p = F.lit(pattern)
    return (F.split(text, pattern, -1),
            F.arrays_zip(F.regexp_extract_all(text, p, F.lit(0)).alias("m"),
                         F.regexp_extract_all(text, p, F.lit(group)).alias("v")))


def _spans(pieces: Column, found: Column, kind: int, least: int) -> Column:
    """Structs (start, kind, end, value) of the matches, in order."""
    item = "struct<start:int,kind:int,end:int,value:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{item}>").alias("out"))
    step = F.zip_with(F.slice(pieces, 1, F.size(found)), found,
                      lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m["m"]).alias("n"), m["v"].alias("v")))

    def add(acc, x):
        at = acc["at"] + x["gap"]
        new = F.struct(at.alias("start"), F.lit(kind).alias("kind"), (at + x["n"]).alias("end"), x["v"].alias("value"))
        return F.struct((at + x["n"]).alias("at"),
                        F.when(F.length(x["v"]) >= least, F.array_append(acc["out"], new)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(step, start, add, lambda acc: acc["out"])


def _with_spans(df: DataFrame, text: str, out: str, pattern: str, kind: int, least: int, group: int) -> DataFrame:
    """Adds the array column ``out``; texts without a match skip the work."""
    cols = df.columns
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    hit, pieces, found = (unused_name(df, f"{out}_{x}") for x in ("hit", "pieces", "found"))
    p, m = _found(F.col(text), pattern, group)
    return (df.withColumn(hit, _hit(F.col(text), pattern))
            .withColumn(pieces, F.when(F.col(hit), p)).withColumn(found, F.when(F.col(hit), m))
            .select(*cols, F.when(F.col(hit), _spans(F.col(pieces), F.col(found), kind, least)).otherwise(none).alias(out)))


def base_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: spans of the fixed kinds by start, then kind."""
    cols = df.columns
    names = [unused_name(df, f"{out}_{k}") for k in KINDS]
    for i, (k, name) in enumerate(zip(KINDS, names)):
        df = _with_spans(df, text, name, PATTERNS[k], i, LEAST[k], 1)
    return df.select(*cols, F.array_sort(F.concat(*names)).alias(out))


def samples(df: DataFrame, text: str, max_docs: int = 2000) -> DataFrame:
    """Labelled samples ``(token, random)`` from ``df``: the values of base
    spans are random strings, other identifiers of the same texts ordinary.
    The bound: of the different texts, the ``max_docs`` that have the smallest
    hash, and the ``max_docs`` of smallest hash among those with a base match."""
    t = df.select(F.coalesce(F.col(text), F.lit("")).alias("t")).where("t != ''").withColumn("h", F.xxhash64("t"))
    has = F.lit(False)
    for k in KINDS:
        has = has | _hit(F.col("t"), PATTERNS[k])

    def bound(some: DataFrame) -> int:
        """The ``max_docs``-th smallest hash: one number."""
        return some.select("h").distinct().orderBy("h").limit(max_docs).agg(F.max("h")).first()[0] or -(1 << 63)

    any_max, has_max = bound(t), bound(t.where(has))
    picked = t.where((F.col("h") <= any_max) | ((F.col("h") <= has_max) & has)).select("t").distinct()
    picked = stage(base_spans(picked, "t", "base"), "secret-samples")
    value = picked.select(F.explode(F.transform("base", lambda s: s["value"])).alias("token"), F.lit(True).alias("random"))
    word = picked.select(F.explode(F.array_except(
        F.regexp_extract_all("t", F.lit(f"({ORDINARY})"), F.lit(1)), F.transform("base", lambda s: s["value"]))).alias("token"),
        F.lit(False).alias("random"))
    word = word.where(~F.col("token").rlike(PATTERNS["hex"]) & ~F.col("token").rlike(PATTERNS["access"])
                      & ~F.col("token").rlike("(?i:password|passwd|secret|token|api_?key)") & F.col("token").rlike("[A-Za-z]"))
    return value.unionByName(word)


def train(labelled: DataFrame) -> list[float]:
    """The log-likelihood ratio (random against ordinary) of each transition,
    as a flat table, from ``labelled (token string, random boolean)``."""
    chars = labelled.where("token is not null and random is not null").select(
        "random", F.split(F.concat(F.lit(" "), F.regexp_replace("token", f"[^{ALPHABET[0]}{ALPHABET[1:].replace('-', '')}-]", "")), "").alias("c"))
    pairs = chars.select("random", F.explode(F.zip_with(
        F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c")),
        lambda a, b: F.struct(F.ascii(a).alias("a"), F.ascii(b).alias("b")))).alias("p"))
    counts = {(r.random, r.a, r.b): r.n for r in
              pairs.groupBy("random", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n")).collect()}
    codes = [ord(c) for c in ALPHABET]
    logp: dict[bool, dict] = {}
    for y in (True, False):
        single = {b: 1 + sum(counts.get((y, a, b), 0) for a in [FIRST, *codes]) for b in codes}
        total = sum(single.values())
        row = {a: sum(counts.get((y, a, b), 0) for b in codes) for a in [FIRST, *codes]}
        logp[y] = {(a, b): math.log((counts.get((y, a, b), 0) + BACKOFF * single[b] / total) / (row[a] + BACKOFF))
                   for a in row for b in codes}
    table_ = [0.0] * (WIDTH * WIDTH)
    for (a, b), x in logp[True].items():
        table_[(a - FIRST) * WIDTH + b - FIRST] = x - logp[False][a, b]
    return table_


def llr(token: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of a string of identifier characters."""
    flat = F.split(F.lit(",".join(f"{x:.6g}" for x in model)), ",").cast("array<double>")
    c = F.split(F.concat(F.lit(" "), token), "")
    steps = F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c)), lambda a, b: F.element_at(
        flat, (F.ascii(a) - FIRST) * WIDTH + F.ascii(b) - FIRST + 1))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)


def _outside(span: Column, base: Column) -> Column:
    """The pieces of ``span`` outside the base spans, of the least length or more."""
    item = "struct<start:int,kind:int,end:int,value:string>"

    def with_piece(acc, end):
        at, n = acc["at"], end - acc["at"]
        piece = F.struct(at.alias("start"), span["kind"].alias("kind"), end.alias("end"),
                         span["value"].substr(at - span["start"] + 1, n).alias("value"))
        return F.when(n >= MIN_LENGTH, F.array_append(acc["out"], piece)).otherwise(acc["out"])

    start = F.struct(span["start"].alias("at"), F.array().cast(f"array<{item}>").alias("out"))
    touching = F.filter(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    return F.aggregate(touching, start, lambda acc, b: F.struct(F.greatest(acc["at"], b["end"]).alias("at"), with_piece(acc, b["start"]).alias("out")),
                       lambda acc: with_piece(acc, span["end"]))


def scan(df: DataFrame, model: list[float], text: str = "text", out: str = "spans", min_llr: float = MIN_LLR) -> DataFrame:
    """Adds ``out``: an array of (start, kind, end) by start, then kind; kinds
    are numbered as in :data:`KINDS`, ``markov`` comes last."""
    cols = df.columns
    t, base, cand = (unused_name(df, f"{out}_{x}") for x in ("text", "base", "cand"))
    df = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    df = base_spans(df, t, base)
    df = _with_spans(df, t, cand, f"({TOKEN})", len(KINDS), MIN_LENGTH, 1)
    df = df.withColumn(cand, F.flatten(F.transform(cand, lambda s: _outside(s, F.col(base)))))
    df = df.withColumn(cand, F.filter(cand, lambda s: s["value"].rlike("[A-Za-z]")))
    df = df.withColumn(cand, F.filter(cand, lambda s: llr(s["value"], model) >= min_llr))
    bare = F.transform(F.array_sort(F.concat(base, cand)), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return df.select(*cols, bare.alias(out))


def redact(df: DataFrame, spans: str, text: str = "text") -> DataFrame:
    """Replaces each maximal stretch covered by spans with :data:`MASK`; a text
    without spans, null included, stays as it is."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc, s):
        gap = F.col(text).substr(acc["at"] + 1, s["start"] - acc["at"])
        fresh = (s["start"] > acc["at"]) | (F.size(acc["out"]) == 0)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], F.array(gap, F.lit(MASK)))).otherwise(acc["out"]).alias("out"))

    new = F.aggregate(spans, start, add, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.col(text).substr(acc["at"] + 1, F.length(text))))
    return df.withColumn(text, F.when(F.size(spans) > 0, new).otherwise(F.col(text)))


def spelled(spans: Column, kinds: tuple[str, ...]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def fitted(df: DataFrame, max_docs: int = 2000) -> list[float]:
    return train(samples(df, "text", max_docs))


def query(spark, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, fitted(docs), out="found")
    base = F.filter("found", lambda s: s["kind"] < len(KINDS))
    n = lambda i: F.size(F.filter("found", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(spelled(base, KINDS), 256).alias("base_sha256"),
                        spelled(F.col("found"), (*KINDS, "markov")).alias("spans"))


def stage_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are masked; the columns stay."""
    marks = unused_name(docs, "found")
    out = redact(scan(docs, fitted(docs), out=marks), marks)
    changed = F.size(marks) > 0
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop(marks)
