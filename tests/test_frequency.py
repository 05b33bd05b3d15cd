import pytest
from pyspark.sql import functions as F

from wordtide.operators import frequency
from wordtide.sources.stopwords import without_stopwords

LOW, HIGH = "2024-01-01 10:00:00", "2024-01-01 11:00:00"


@pytest.fixture
def posts(make_posts):
    rows = [("2024-01-01 10:30:00", "ten eleven le")] * 10 + [("2024-01-01 10:30:01", "Eleven, le")]
    rows += [("2024-01-01 10:30:02", None), ("2024-01-01 11:00:00", "ten"), ("2024-01-01 10:00:00", "ten")]
    return make_posts(rows)


def test_count_words(posts):
    counts, freqs = frequency.count_words(posts, LOW, HIGH, ["le"])
    assert {r.word: r["count"] for r in counts.collect()} == {"eleven": 11, "le": 11}
    # 12 posts lie in the hour, one of them without text.
    assert {r.word: r.freq for r in freqs.collect()} == {"eleven": round(11 / 12, 4)}


def test_top_words_orders_and_limits(posts):
    counts, freqs = frequency.count_words(posts, LOW, HIGH, None, top_x=2, min_count=0)
    assert [(r.word, r["count"]) for r in counts.collect()] == [("eleven", 11), ("le", 11)]
    assert [r.word for r in freqs.collect()] == ["eleven", "le"]


def test_stop_list_and_frame_agree(spark, posts):
    stop = spark.createDataFrame([("le",), ("the",)], "word STRING")
    listed = frequency.period_word_frequency(posts, ["le", "the"], 0).collect()
    joined = frequency.period_word_frequency(posts, stop, 0).collect()
    assert sorted(listed) == sorted(joined) and len(listed) == 2


def test_stop_words_are_case_sensitive(spark):
    words = spark.createDataFrame([("Le",), ("le",)], "word STRING")
    assert [r.word for r in without_stopwords(words, ["le"]).collect()] == ["Le"]


def test_period_counts_and_totals(make_posts):
    posts = make_posts([(1, "a a"), (2, "a"), (21_600, "a"), (21_601, "a"), ("2024-01-02 00:00:01", "a")])
    counts = frequency.period_word_counts(posts, 0).collect()
    assert sorted((str(r.day), r.quarter, r["count"]) for r in counts) == [
        ("2024-01-01", 0, 3), ("2024-01-01", 1, 1), ("2024-01-02", 0, 1),
    ]
    totals = frequency.period_totals(posts).collect()
    assert sorted((str(r.day), r.quarter, r.n_posts) for r in totals) == [
        ("2024-01-01", 0, 2), ("2024-01-01", 1, 1), ("2024-01-02", 0, 1),
    ]


def test_totals_read_no_text(spark, sf_dir):
    from wordtide.sources.posts import posts_from_documents

    plan = frequency.period_totals(posts_from_documents(spark, sf_dir))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in text
