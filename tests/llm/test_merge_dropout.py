import zlib

import numpy as np
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from restock.llm import merge_dropout as M
from tests.llm.helpers import DOCUMENTS, SF, docs, put

SP = sentencepiece.SentencePieceProcessor(model_file=M.model_path())
PLAIN = M.Encoder(M.model_path(), dropout=0.0)
DROP = M.Encoder(M.model_path(), dropout=0.3)
MOST, ALL = (M.Encoder(M.model_path(), dropout=d) for d in (0.9, 1.0))
TEXT = st.text(st.characters(codec="utf-8"), max_size=30) | st.text("abcdeTh  \n.,'12éß☃▁", max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_without_dropout_equals_library(text):
    text = text.replace("▁", "").replace("\0", "")
    assert np.frombuffer(PLAIN.encode(text), "<u4").tolist() == SP.encode(text)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(0, 9))
def test_decoding_gives_back_the_text(text, number):
    assert DROP.decode(DROP.encode(text, number)) == text


def whole_agenda(e, text, key):
    """The agenda over the whole text at once, under one key."""
    return e.merge("▁" + text.replace(" ", "▁"), key)


def test_segments_do_not_change_merges(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect():
        t = r.text[:2000]
        assert PLAIN.encode(t) == whole_agenda(PLAIN, t, 0)


def test_dropout_varies_and_is_seeded():
    t = "international responsibilities and administrations " * 20
    again = M.Encoder(M.model_path(), dropout=0.3)
    assert DROP.encode(t, 5) == again.encode(t, 5) != DROP.encode(t, 6)
    assert M.Encoder(M.model_path(), dropout=0.3, seed=1).encode(t, 5) != DROP.encode(t, 5)
    assert len(DROP.encode(t)) > len(PLAIN.encode(t))
    words = {DROP.merge("▁responsibilities", v) for v in range(8)}
    assert len(words) > 3
    # all candidates skipped: characters alone
    assert len(M.Encoder(M.model_path(), dropout=1.0).encode("abc")) == 4 * 4


@settings(max_examples=200, deadline=None)
@given(st.text("abcdeThin er", min_size=1, max_size=70), st.integers(0, 7))
def test_both_agendas_agree(text, key):
    marked = text.replace(" ", "▁")
    for e in (PLAIN, DROP):
        assert e._short(marked, key) == e._long(marked, key)


def plain_agenda(e, segment, key):
    """Adjacent pairs searched anew in every step, each skipped for itself."""
    sym, skipped = [(i, c) for i, c in enumerate(segment)], set()
    while True:
        found = [(e.cost[a[1] + b[1]], a[0]) for a, b in zip(sym, sym[1:]) if a[1] + b[1] in e.cost and (a[0], a[1] + b[1]) not in skipped]
        if not found:
            return e._joined([s for _, s in sym])
        cost, place = min(found)
        k = next(i for i, s in enumerate(sym) if s[0] == place)
        piece = sym[k][1] + sym[k + 1][1]
        if e._skipped(place, cost, key):
            skipped.add((place, piece))
        else:
            sym[k : k + 2] = [(place, piece)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["▁the", "▁international", "▁responsibilities", "▁Verwaltung", ",", "▁" * 5, "▁aaaaaaaa", "▁é☃☃é", "▁" + "ab" * 40]),
                min_size=1, max_size=12), st.integers(0, 2**64 - 1))
def test_every_occurrence_is_skipped_for_itself(segments, number):
    """What is remembered gives what each occurrence's own agenda gives."""
    keys = M.mixed(np.arange(3, 3 + len(segments), dtype=np.uint64) + np.uint64(number))
    for e in (DROP, MOST, ALL, PLAIN):
        assert e._encoded(segments, keys) == [plain_agenda(e, s, k) for s, k in zip(segments, keys.tolist())]


def test_segmentations_grow_with_the_occurrences():
    word = "▁responsibilities"
    forms = [len(set(DROP._encoded([word] * most, M.mixed(np.arange(most, dtype=np.uint64))))) for most in (10, 100, 2000)]
    assert 4 < forms[0] < forms[1] < forms[2]


def test_texts_together_as_each_alone(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()][:60] + ["", " ", "a▁b▁", "☃é" * 40, "x" * 200]
    numbers = [M.number_of(i) for i in range(len(texts))]
    fresh = M.Encoder(M.model_path(), dropout=0.3)
    assert DROP.encode_all(texts, numbers) == [fresh.encode(t, n) for t, n in zip(texts, numbers)]


def test_long_runs(spark):
    for t in (" " * 20000 + "x", "a" * 20000, "\n" * 5000, "=" * 7000):
        assert DROP.decode(DROP.encode(t)) == t


def test_query_and_table_round_trip(spark, tmp_path):
    rows = M.query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.text_crc32 == r.decoded_crc32 for r in rows)
    texts = ["", None, "a b", "a b", " ▁ x", "é\x00 "]
    df = docs(spark, texts).withColumn("ids", F.lit(1)).withColumn("key", F.lit(2))
    back = M.decode(M.encode(df, M.model_path()), M.model_path()).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in enumerate(texts)}
    got = {r.doc_id: r for r in M.query(spark, put(docs(spark, texts), tmp_path)).collect()}
    assert got[0].n_ids == got[1].n_ids == 0 and got[4].decoded_crc32 == zlib.crc32(" ▁ x".encode())


def test_empty_table(spark, tmp_path):
    assert M.query(spark, put(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0
