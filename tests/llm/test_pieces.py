"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from wordtide.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PARTS = [
    "a", "b", "the", "ing", "ion", " ", "  ", " " * 37, "\n", "\t", "é", "ü", "日", "本", "ж", "\U0001f600", "\x00",
    "�", "▁", "⁇", "====", "----", "​", "́", "<s>", "</s>", "<0x0A>", ".", "\U0010ffff", "퀀",
]


@pytest.fixture(scope="module")
def model():
    return pieces.Model(PATH)


def expected(text, end=True):
    ids = LIBRARY.encode(text or "", add_eos=end)
    return (
        len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(),
    )


def test_mixed_texts(model):
    pick = random.Random(3)
    texts = ["".join(pick.choices(PARTS, k=pick.randint(0, 40))) for _ in range(1500)]
    assert list(pieces.Coder(model).digests(texts)) == [expected(t) for t in texts]


def test_runs_of_spaces_and_of_letters(model):
    texts = [x for n in [*range(70), 1000, 5001] for x in (" " * n, " " * n + "the", "x" + " " * n, "a" * n, "=" * n, "\n" * n)]
    assert list(pieces.Coder(model).digests(texts)) == [expected(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    model = _model()
    assert model.encode(text) == LIBRARY.encode(text)
    assert model.decode(np.array(model.encode(text), np.int64)) == LIBRARY.decode(LIBRARY.encode(text))


def _model(kept=[]):
    if not kept:
        kept.append(pieces.Model(PATH))
    return kept[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 262)), max_size=8))
def test_decoding_any_ids(ids):
    assert _model().decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


def test_cut_between_words(model):
    """Whatever the size of the slices, the ids are those of the whole text."""
    text = "the words  and   more日本語 of a text\n" * 50 + "x" * 300 + " " * 99 + "end"
    whole = LIBRARY.encode(text)
    for size in (1, 2, 7, 64, 1000):
        assert np.concatenate(list(model.slices(text, size))).tolist() == whole


def test_long_texts_in_slices(model, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 50)
    texts = ["", "one two three " * 40, "a" * 400, " " * 300, "z", "日本語 " * 60, ""]
    assert list(pieces.Coder(model).digests(texts)) == [expected(t) for t in texts]
    assert list(pieces.Coder(model).digests(texts, end=False)) == [expected(t, False) for t in texts]


def test_column_forms(spark):
    """Nulls, empty and repeated rows, extra columns with clashing names, an empty table."""
    rows = [(1, None, 5), (1, None, 5), (None, " a b", 6), (2, "", 7), (3, "Grüße\t\U0001f600  end ", 8)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n_tokens INT")
    got = sorted(map(tuple, pieces.round_trips(docs, PATH).collect()), key=str)
    assert got == sorted(((i, *expected(t)) for i, t, _ in rows), key=str)
    coded = pieces.ids_of(docs, PATH)
    assert {tuple(r.ids) for r in coded.collect()} == {tuple(LIBRARY.encode(t or "", add_eos=True)) for _, t, _ in rows}
    back = {(r.doc_id, r.text) for r in pieces.texts_of(coded, PATH).collect()}
    assert back == {(i, t or "") for i, t, _ in rows}
    assert pieces.round_trips(docs.limit(0), PATH).count() == 0
    assert pieces.texts_of(spark.createDataFrame([(1, None)], "doc_id BIGINT, ids ARRAY<INT>"), PATH).first().text == ""


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62C3' AS STRING) AS text")
    assert tuple(pieces.round_trips(docs, PATH).first())[1:] == expected("a�b�")


def test_query_over_the_table(spark, sf_dir):
    from wordtide.llm.queries import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op13_sentencepiece"](spark, sf_dir).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}
