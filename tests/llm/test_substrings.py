import random

import pytest

from tests.llm import brute, cases
from wordtide.llm import spans, substrings

COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def rows_of(frame, columns=COLUMNS):
    return sorted([tuple(r) for r in frame.select(*columns).collect()], key=repr)


def test_passages_against_brute_force(spark):
    rows = cases.passages()
    found = substrings.substring_dedup(cases.frame(spark, rows))
    assert found.where("found = 'own' AND row = 7").count() == len(rows)
    assert rows_of(found) == sorted(brute.removed_words(rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_over_small_vocabularies(spark, seed):
    pick = random.Random(seed)
    rows = [(i, " ".join(pick.choice("ab") for _ in range(pick.randrange(60)))) for i in range(40)]
    found = substrings.substring_dedup(cases.frame(spark, rows), min_words=8, first=4)
    assert rows_of(found) == sorted(brute.removed_words(rows, 8), key=repr)
    deeper = substrings.substring_dedup(cases.frame(spark, rows), min_words=12, first=3)
    assert rows_of(deeper) == sorted(brute.removed_words(rows, 12), key=repr)


def test_empty_table(spark):
    assert substrings.substring_dedup(cases.frame(spark, [])).count() == 0


def test_bad_lengths(spark):
    with pytest.raises(ValueError):
        substrings.repeated(cases.frame(spark, []), 50, 20)


def test_documents_keep_their_columns(spark):
    docs = cases.frame(spark, cases.passages()).withColumnRenamed("row", "n_words")
    cut = spans.as_documents(docs, substrings.repeated(docs), 50)
    assert cut.schema.names == docs.schema.names
    for row in cut.collect():
        assert row.n_chars == len(row.text or "") and row.n_words == 7


def _twins(n):
    """A word of `n` letters whose number of letters b is even up to each place, and its opposite."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("remover", ["substrings", "suffixes"])
def test_words_that_polynomials_confuse(spark, remover):
    """Sequences with one value modulo 2^64 in every odd base are different words, and stay."""
    from wordtide.llm import suffixes

    one, two = _twins(1024)
    before = cases.words(1, 49)
    rows = [(1, " ".join([*before, one])), (2, " ".join([*before, two])), (3, " ".join([*before, one]))]
    # The same with words for letters.
    rows += [(4 + i, " ".join("red blue".split()[c == "a"] for c in t)) for i, t in enumerate(_twins(2048))]
    docs = cases.frame(spark, rows)
    found = substrings.substring_dedup(docs) if remover == "substrings" else suffixes.suffix_dedup(docs)
    assert rows_of(found) == sorted(brute.removed_words(rows), key=repr)
