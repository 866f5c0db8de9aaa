import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from restock.llm import spelling as S
from tests.llm.helpers import DOCUMENTS, SF, docs, put

LETTERS = set("abcdefghijklmnopqrstuvwxyz") | {chr(c) for c in range(0xC0, 0x100)}


def words_of(rows):
    """The contract's words, letter by letter."""
    out = Counter()
    for i, text in rows:
        run = ""
        for c in [*(text or ""), " "]:
            c = c.lower() if "A" <= c <= "Z" else c
            if c in LETTERS:
                run += c
            elif run:
                h = zlib.crc32(f"{i}:{run}".encode())
                out[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
                run = ""
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        others = [(-m, v) for v, m in counts.items() if near(v, w)]
        best = min(others, default=(0, None))
        form = best[1] if others and -best[0] >= ratio * n else None
        out[w] = [form, None, n, len(others), -best[0] if form is not None else None]
    for w in out:
        at = w
        while out[at][0] is not None:
            at = out[at][0]
        out[w][1] = at
    return {w: tuple(v) for w, v in out.items()}


def table_of(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    counts = words_of(rows)
    assert len(counts) > 300
    want = brute(counts)
    assert table_of(S.query(spark, SF)) == want
    con = duckdb.connect()
    con.execute(f"create view documents as from '{SF}/documents.parquet'")
    got = {r[0]: r[1:] for r in con.execute(S.ORACLE).fetchall()}
    assert got == want


@pytest.mark.parametrize("tile", [2, 9, 2048])
def test_random_words_equal_brute_force(spark, tile):
    """Few letters, so that groups are large; they are halved down to single places."""
    rng = random.Random(tile)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(500)}
    words |= {"prefix" + "".join(rng.choice("abÿ☃𝄞") for _ in range(rng.randint(0, 4))) for _ in range(200)}
    words |= {"", "x" * 3000, "x" * 2999, "x" * 1500 + "y" + "x" * 1499, "y" + "x" * 2999, "x" * 2999 + "y", "x" * 2998 + "y"}
    counts = {w: rng.choice([1, 2, 30, 400]) for w in words}
    got = table_of(S.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), tile=tile))
    assert got == brute(counts)


def test_groups_are_halved_to_the_tile(spark):
    counts = [(f"common{a}{b}{c}tail", 2) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    tiles = S.groups(spark.createDataFrame(counts, "word string, n long"), tile=40)
    sizes = tiles.groupBy("grp").count()
    assert sizes.agg(F.max("count")).first()[0] <= 40 < 512
    table = table_of(S.variants(spark.createDataFrame(counts, "word string, n long"), tile=40))
    assert {v[3] for v in table.values()} == {21} and {v[0] for v in table.values()} == {None}


def test_forms_lead_to_the_root(spark):
    chain = [("abcdefg", 2), ("abcdefgh", 20), ("abcdefghi", 200), ("abcdefghij", 2000), ("abcdefghijk", 20000), ("abcdefghijkl", 200000)]
    got = table_of(S.variants(spark.createDataFrame(chain, "word string, n long")))
    assert {v[1] for v in got.values()} == {"abcdefghijkl"} and got["abcdefg"] == ("abcdefgh", "abcdefghijkl", 2, 1, 20)
    ties = [("abcdefg", 2), ("abcdefx", 50), ("abcdefb", 50), ("abcdefÿ", 50)]
    assert table_of(S.variants(spark.createDataFrame(ties, "word string, n long")))["abcdefg"] == ("abcdefb", "abcdefb", 2, 3, 50)


def test_words_of_odd_texts(spark, tmp_path):
    texts = ["", None, "Überraschung Überraschung überraschung", "a" * 50_000 + " " + "A" * 50_000, "ÀÉÎÕÜ×÷ÿ ÀÉÎÕÜ×÷ÿ", "sevenly, sevenly sixesix sixesix"] * 2
    rows = list(enumerate(texts))
    df = docs(spark, texts).withColumn("word", F.lit("w")).withColumn("key", F.lit(1)).withColumn("n", F.lit(1))
    assert {r.word: r.n for r in S.words(df).collect()} == words_of(rows)
    twice = words_of(rows + rows)
    assert {r.word: r.n for r in S.words(df.unionByName(df)).collect()} == twice
    none = S.words(df.withColumn("doc_id", F.lit(None).cast("long")), one_in=0).collect()
    assert {r.word for r in none} >= {"überraschung", "sevenly"}
    assert table_of(S.query(spark, put(docs(spark, texts), tmp_path))) == brute(words_of(rows))


def test_empty_table(spark, tmp_path):
    assert S.query(spark, put(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0
