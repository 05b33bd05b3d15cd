"""Registered queries of the operators: their SQL twins, and the columns that are promised."""

import hashlib
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.compare import connect, differences, types
from tests.llm import brute
from tests.llm.test_licenses import expected as licenses_of
from tests.llm.test_native import shared_targets
from tests.llm.test_neardup import brute_classes
from wordtide.llm import queries

ORACLES = queries.oracle_sql()


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]


def rows_of(spark, sf_dir, name, *columns):
    found = entry.queries()[name](spark, sf_dir)
    return sorted(tuple(r[c] for c in columns) for r in found.collect())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    frame = entry.queries()[name](spark, sf_dir)
    duck = connect(sf_dir)
    _, _, text = differences(frame, duck, ORACLES[name])
    assert not text
    assert not types(frame, duck, ORACLES[name])


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_near_duplicates(spark, sf_dir, documents):
    found = rows_of(spark, sf_dir, "op1_minhash_near_dedup", "doc_id", "class_id", "kept")
    classes = brute_classes([(i, t) for i, t, _ in documents])
    assert found == sorted((i, c, i == c) for i, c in classes.items())


def test_token_counts(spark, sf_dir, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = [len(e.ids) for e in tokenizer.encode_batch([t for _, t, _ in documents], add_special_tokens=False)]
    expected = [(i, len(t.encode()), n, n > 1024) for (i, t, _), n in zip(documents, counts, strict=True)]
    assert rows_of(spark, sf_dir, "op2_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected)


def test_quality_classifier(spark, sf_dir, documents):
    found = rows_of(spark, sf_dir, "op5_quality_classifier", "doc_id", "held_out", "score", "predicted")
    assert [r[0] for r in found] == sorted(i for i, _, _ in documents)
    for doc, held, score, predicted in found:
        assert held == (zlib.crc32(str(doc).encode()) % 3 == 1) and 0 <= score <= 1 and predicted == int(score >= 0.5)


def test_mixing(spark, sf_dir, documents):
    sizes, longest = {}, max(len(brute.spaced(t)) for _, t, _ in documents)
    for _, text, source in documents:
        sizes[source] = sizes.get(source, 0) + len(brute.spaced(text))
    targets, taken = shared_targets(sizes), dict.fromkeys(sizes, 0)
    sources = {i: s for i, _, s in documents}
    for doc, size, of_source, target, words in rows_of(
        spark, sf_dir, "op7_source_mixing", "doc_id", "size", "source_size", "target", "taken"
    ):
        assert of_source == sizes[sources[doc]] and target == pytest.approx(targets[sources[doc]]) and words <= 3 * size
        taken[sources[doc]] += words
    assert all(abs(taken[s] - targets[s]) <= longest for s in sizes)


def test_licenses(spark, sf_dir, documents):
    found = rows_of(spark, sf_dir, "op9_license_scan", "doc_id", "n_licenses", "licenses")
    expected = [(i, ",".join(sorted(licenses_of(t)))) for i, t, _ in documents]
    assert found == sorted((i, len(names.split(",")) if names else 0, names) for i, names in expected)


def test_passages(spark, sf_dir, documents):
    expected = sorted(brute.removed_words([(i, t) for i, t, _ in documents]))
    for name in ("op8_suffix_array_dedup", "op10_substring_dedup"):
        assert rows_of(spark, sf_dir, name, "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    assert hashlib.sha256(b"").hexdigest() not in {r[3] for r in expected if r[1] > r[2]}
