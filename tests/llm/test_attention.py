import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import cases
from wordtide.llm import attention


def bags(n, seed=1):
    """Good documents, and bad ones of which one paragraph is junk."""
    pick, texts, labels = random.Random(seed), [], []
    for i in range(n):
        parts = [" ".join(cases.words((seed, i, p), 40)) for p in range(pick.randrange(1, 6))]
        good = i % 4 > 0
        if not good:
            parts[pick.randrange(len(parts))] = " ".join(f"{w}%%%" for w in cases.words((seed, i), 40))
        texts.append("\n".join(parts))
        labels.append(int(good))
    return texts, np.array(labels)


def test_gradients():
    texts, labels = bags(12)
    model = attention.fit(pa.array(texts), labels, 0.75, steps=3)
    bag, x = attention.passages(pa.array(texts))
    x = (x - model.mean) / model.spread

    def loss():
        p = attention._sigmoid(model.forward(bag, len(texts), x)["logit"])
        fit = -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()
        return fit + attention.DECAY / 2 * sum((v**2).sum() for v in model.weights.values())

    for name, grad in attention._gradients(model, bag, x, labels).items():
        value = model.weights[name]
        for i in list(np.ndindex(value.shape))[:: max(1, value.size // 5)]:
            keep = value[i]
            value[i] = keep + 1e-5
            up = loss()
            value[i] = keep - 1e-5
            down = loss()
            value[i] = keep
            assert grad[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_passages_cover_whole_texts():
    texts = [None, "", " ".join(["a"] * 65), "é! | x"]
    bag, x = attention.passages(pa.array(texts))
    assert bag.tolist() == [0, 1, 2, 2, 2, 3] and not x[:2].any()
    assert x[2:5, -4].tolist() == [1, 1, 1 / 32] and x[2:5, -2].tolist() == [1, 31 / 32, 0] and x[2:5, 0].tolist() == [1, 1, 1]
    pieces = [attention.passages(pa.array([t], pa.string()))[1] for t in texts]
    assert np.allclose(np.concatenate(pieces), x)


def test_held_out_accuracy(spark):
    texts, labels = bags(600)
    rows = list(enumerate(texts)) + [(None, None), (9_000, ""), (9_001, "word " * 30_000)]
    marks = [(i, int(y), 1 - int(y)) for i, y in enumerate(labels)] + [(0, 0, 0), (9_000, None, None)]
    docs = cases.frame(spark, rows).withColumnRenamed("row", "score")
    found = attention.quality_scores(docs, spark.createDataFrame(marks, "doc_id BIGINT, quality INT, toxic INT")).collect()
    assert len(found) == len(rows) and all(r.found == "own" for r in found)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    right = [r.predicted == labels[r.doc_id] for r in found if r.held_out and r.doc_id < 600]
    assert len(right) > 150 and np.mean(right) > 0.97


def test_long_documents_are_learnt_from(spark):
    """All bad documents are long ones; without them there would be one class and one score."""
    texts, labels = bags(40)
    texts = [t if y else t + "\n" + "junk%%% " * 25_000 for t, y in zip(texts, labels, strict=True)]
    marks = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)], "doc_id BIGINT, quality INT")
    model = attention.learn(cases.frame(spark, list(enumerate(texts))), marks)
    scores = model.scores(pa.array(texts))
    assert scores[labels == 1].min() > scores[labels == 0].max()


def test_held_out_labels_are_not_read(spark):
    texts, labels = bags(60)
    docs = cases.frame(spark, list(enumerate(texts)))
    rows = [(i, int(y)) for i, y in enumerate(labels)]
    turned = [(i, y if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - y) for i, y in rows]
    scores = []
    for r in (rows, turned):
        model = attention.learn(docs, spark.createDataFrame(r, "doc_id BIGINT, quality INT"))
        scores.append(model.scores(pa.array(texts)))
    assert np.array_equal(*scores)


@pytest.mark.parametrize("marks", [[], [(1, 1), (2, 1)]])
def test_too_few_labels(spark, marks):
    docs = cases.frame(spark, [(1, "a"), (2, "b")])
    labels = spark.createDataFrame(marks, "doc_id BIGINT, quality INT")
    assert all(r.score >= 0.5 for r in attention.quality_scores(docs, labels).collect())
    assert attention.quality_scores(cases.frame(spark, []), labels).count() == 0


def test_repeated_ids_of_one_class_leave_the_other_its_place(spark):
    """A sample of one per class: many texts of one id are one document."""
    rows = [(0, f"{text} good words") for text in "abcdefgh"] * 3 + [(900, "junk%%% junk%%% " * 9)]
    marks = [(0, 1), (900, 0), (5_000, 0), (5_003, 1)]  # two without a document
    assert not any(zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in marks[:2])
    labels = spark.createDataFrame(marks, "doc_id BIGINT, quality INT")
    model = attention.learn(cases.frame(spark, rows), labels, sample=1)
    good, bad = model.scores(pa.array(["a good words", "junk%%% junk%%% " * 9]))
    assert good > 0.5 > bad


def test_bags_are_bounded_by_passages(spark):
    """A text of one-letter words has many passages in few bytes; no bag has more than asked for."""
    docs = cases.frame(spark, [(1, "a " * 80_000), (2, "b"), (3, None)])
    found = attention._bags(docs.selectExpr("doc_id", "1 AS y", "text"), 250).collect()
    assert {r.doc_id: len(r.bag) // attention.FEATURES // 8 for r in found} == {1: 250, 2: 1, 3: 1}
