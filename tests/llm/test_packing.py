import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from restock.llm import packing as P
from tests.llm.helpers import DOCUMENTS, SF, docs, put

ODD = ["", None, "It's  ÅNGSTRÖM's 12½ ²", "a\x1cb", "ﬁne ☃ é", "<|endoftext|> x", "İstanbul ǅ ß", "x" * 9000, "word " * 9000,
       " \u0085 we'll've 'S", "中文 字", "a_b-c!!?? 'tis"]


def reference(texts):
    t = Tokenizer.from_file(P.tokenizer_path())
    return {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in texts.items()}


def check(spark, folder, texts):
    rows = P.query(spark, folder).collect()
    want = reference(texts)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            part = want[i][at : at + r.length]
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want[i])
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r.length
        assert at == len(want[i])
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sum(map(len, want.values())), len(sequences)


def test_query_on_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokens, sequences = check(spark, SF, texts)
    assert tokens / (2048 * sequences) > 0.97


def test_odd_texts(spark, tmp_path):
    check(spark, put(docs(spark, ODD), tmp_path), dict(enumerate(ODD)))


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40) | st.text("abzAZ'stéÉß 12²½ \x1c\n!?_-", max_size=60))
def test_word_cache_equals_library(text):
    w = P.words(P.tokenizer_path())
    assert w(text) == w.whole(text)


def test_differencing_is_balanced():
    rng = random.Random(2)
    sizes = [rng.randint(1, 512) for _ in range(3000)]
    sums, members = P.difference(sizes, 300)
    assert sorted(i for own in members for i in own) == list(range(3000))
    assert sums == [sum(sizes[i] for i in own) for own in members]
    assert max(sums) - min(sums) < 40
    # the textbook case: {8,7,6,5,4} in two parts differ by 2 under differencing
    assert sorted(P.difference([8, 7, 6, 5, 4], 2)[0]) == [14, 16]


def test_window_count_rises_when_capacity_is_exceeded():
    assert len(P.windows([1500] * 4, 2048)) == 4
    assert len(P.windows([], 2048) if False else P.windows([1], 2048)) == 1


def test_repeated_rows_clashing_columns_and_nulls(spark, tmp_path):
    df = docs(spark, ["a b c", "a b c"]).withColumn("key", F.lit(1)).withColumn("ids", F.lit(2))
    df = df.unionByName(df).unionByName(df.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    out = P.stage_packing(spark, df, "").collect()
    assert len(out) == 5 and {r.length for r in out} == {4} and sum(r.doc_id is None for r in out) == 1


def test_empty_table(spark, tmp_path):
    assert P.query(spark, put(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0
