import pytest
from pyspark.errors import AnalysisException

from wordtide.sinks import text as sinks

MEANS = "word STRING, d_morning DOUBLE, d_afternoon DOUBLE, d_evening DOUBLE, d_night DOUBLE"


@pytest.fixture
def means(spark):
    rows = [("hier", 33.285714285714285, -44.57142857142857, 0.0, -3.0), ("a,b", 22.0, None, 1.0, 2.0)]
    return spark.createDataFrame(rows, MEANS)


def test_seasonal_text(spark, means, tmp_path):
    scores, words = str(tmp_path / "scores"), str(tmp_path / "list")
    sinks.write_seasonal(means, scores, words)
    assert sorted(r.value for r in spark.read.text(scores).collect()) == [
        "[a,b,22.0,null,1.0,2.0]",
        "[hier,33.285714285714285,-44.57142857142857,0.0,-3.0]",
    ]
    assert sorted(r.value for r in spark.read.text(words).collect()) == ["a,b", "hier"]
    with pytest.raises(AnalysisException):
        sinks.write_seasonal(means, scores, words)


def test_event_words_by_batch(spark, tmp_path):
    events = spark.createDataFrame([(7, "boom", 9), (7, "bam", 9), (8, "boom", 9)], "batch_idx BIGINT, word STRING, n_now BIGINT")
    sinks.write_event_words(events, str(tmp_path / "events"))
    rows = spark.read.text(str(tmp_path / "events")).collect()
    assert sorted((r.batch_idx, r.value) for r in rows) == [(7, "bam"), (7, "boom"), (8, "boom")]


def test_batches_of_different_days_stay_apart(spark, tmp_path):
    events = spark.createDataFrame([("2024-01-01", 0, "a"), ("2024-01-02", 0, "b")], "day STRING, batch_idx INT, word STRING")
    sinks.write_event_words(events, str(tmp_path / "events"))
    rows = spark.read.text(str(tmp_path / "events")).collect()
    assert sorted((str(r.day), r.batch_idx, r.value) for r in rows) == [("2024-01-01", 0, "a"), ("2024-01-02", 0, "b")]


def test_topics_as_lines(spark, tmp_path):
    topics = spark.createDataFrame([(0, "a,b"), (1, "c,d")], "topic INT, terms STRING")
    sinks.write_topics(topics, str(tmp_path / "topics"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "topics")).collect()) == ["a,b", "c,d"]
