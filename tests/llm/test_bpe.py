import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import cases
from wordtide.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a", "it's I'LL we'll", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext",
    "é x　y\n\n  z", "𝒳𝒴 ٣٤ ½ ²", "\x00\x01", "a\r\n\tb  ", "x" * 50_000, "ab" * 3_000, "​́é", "\x85 \x1c",
    "🤦🏽‍♂️ ok", "12345678 9 ", "क्षि नमस्ते", "ᾳ ǅ ʰ ⅷ ㊿ ꠀ 𞤀", " " * 500, "aaaa" * 9, "\n\n\n",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(library):
    pick, count = random.Random(1), bpe.counter(PATH)
    alphabet = "aaeeint  \n\t'’.,!0189éßñ漢字🤦‍<|>endofx"
    for text in ODD + ["".join(pick.choices(alphabet, k=pick.randrange(1, 80))) for _ in range(2_000)]:
        assert count(text) == library(text), text[:80]


def test_a_small_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    count = bpe.counter(PATH)
    text = " ".join(cases.words(1, 500))
    assert count(text) == library(text)


def test_slices_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 5)
    pick, count = random.Random(2), bpe.counter(PATH)
    for _ in range(1_500):
        text = "".join(pick.choices("ab1 .\n\n\t'é", k=pick.randrange(1, 60)))
        assert count(text) == library(text), text


def test_documents(spark, library):
    rows = cases.passages() + [(100 + i, t) for i, t in enumerate(ODD) if "\x00" not in t]
    found = bpe.token_counts(cases.frame(spark, rows).withColumnRenamed("row", "n_tokens"), PATH).collect()
    assert len(found) == len(rows) and all(r.found == "own" for r in found)
    expected = [(i, len((t or "").encode()), library(t or "")) for i, t in rows]
    expected = sorted([(*e, e[2] > 1024) for e in expected], key=repr)
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found], key=repr) == expected
    assert bpe.token_counts(cases.frame(spark, []), PATH).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Merges(public_tokenizers.path("word_bpe_49k.json"))
