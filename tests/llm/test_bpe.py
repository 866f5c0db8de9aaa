import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from restock.llm import bpe as B
from tests.llm.helpers import DOCUMENTS, SF, docs, put

LIB = Tokenizer.from_file(B.tokenizer_path())
OWN = B.Bpe(B.tokenizer_path())
ODD = ["", None, "It's  ÅNGSTRÖM's 12½ ²", "a\x1cb", "ﬁne ☃ é", "x<|endoftext|>é<|startoftext|><|endoftext|>", "<|EndOfText|> <|endof", "İstanbul ǅ ß ΑΣ",
       "x" * 9000, "word " * 9000, " \u0085 we'll've 'S", "中文 字 x", "a_b-c!!?? 'tis", "\0\x7f\xa0", "é <|endoftext|>́"]


def ids_of(text):
    return LIB.encode(text, add_special_tokens=False).ids


def same(text):
    ids = ids_of(text)
    got = OWN.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert OWN.decode(got) == LIB.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40) | st.text("abzAZ'stéÉß 12²½ \x1c\n!?_-<|>", max_size=60)
       | st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "aß", " ", "́", "the", "É"])).map("".join))
def test_equals_the_library(text):
    same(text)


@pytest.mark.parametrize("text", [t for t in ODD if t])
def test_odd_texts_equal_the_library(text):
    same(text)


def test_long_words_take_the_queue_too():
    for text in ("a" * 30_000, "ab" * 20_000, "internationalisation" * 3_000, "ß" * 10_000, "=" * 20_001):
        same(text)


def test_lowest_rank_first_then_leftmost():
    """The queue against the plain search for the lowest rank in every step."""
    for word in ("aaaaaaa", "banananana", "mississippi", "lalalalal", "thethethe"):
        sym = [OWN.inner[c] for c in word[:-1]] + [OWN.last[word[-1]]]
        while pairs := [(OWN.merges[p], i) for i, p in enumerate(zip(sym, sym[1:])) if p in OWN.merges]:
            (_, made), i = min(pairs)
            sym[i : i + 2] = [made]
        assert OWN.merge(word) == sym


def test_unknown_ids_are_left_out():
    assert OWN.decode(np.array([320, 60_000, 321], "<u4").tobytes()) == LIB.decode([320, 60_000, 321], skip_special_tokens=False)


def check(spark, folder, texts):
    rows = B.query(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_query_on_table(spark):
    check(spark, SF, {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()})


def test_query_on_odd_texts(spark, tmp_path):
    check(spark, put(docs(spark, ODD), tmp_path), dict(enumerate(ODD)))


def test_clashing_columns_nulls_and_repeats(spark):
    df = docs(spark, ["Ab c", "Ab c", None]).withColumn("ids", F.lit(1)).withColumn("bpe_work", F.lit(2)).withColumn("Decoded", F.lit(3))
    df = df.unionByName(df).withColumn("doc_id", F.when(F.col("text").isNotNull(), F.col("doc_id")))
    ids = B.encode(df, B.tokenizer_path())
    assert ids.columns == ["doc_id", "lang", "source", "n_chars", "bpe_work", "Decoded", "ids"]
    rows = B.decode(ids, B.tokenizer_path()).collect()
    assert sorted((r.decoded, r.bpe_work) for r in rows) == [("", 2)] * 2 + [("ab</w> c</w>", 2)] * 4
    nothing = B.decode(spark.createDataFrame([(None,)], "ids binary"), B.tokenizer_path())
    assert nothing.first().decoded is None


def test_empty_table(spark, tmp_path):
    assert B.query(spark, put(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0
