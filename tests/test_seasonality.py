import pytest
from pyspark.sql import functions as F

from tests import literal
from wordtide.operators import seasonality as S
from wordtide.sources.posts import WEEK_DAYS, posts_from_documents
from wordtide.sources.stopwords import COMMON, stopwords_frame

HISTORY = (
    "day STRING, word STRING, f_morning DOUBLE, f_afternoon DOUBLE, f_evening DOUBLE, "
    "f_night DOUBLE, mean DOUBLE"
)
MEANS = "word STRING, d_morning DOUBLE, d_afternoon DOUBLE, d_evening DOUBLE, d_night DOUBLE"


def test_one_pass_equals_the_literal_form(spark, sf_dir):
    posts = posts_from_documents(spark, sf_dir)
    days = WEEK_DAYS[:3]
    fused = S.seasonal_words(posts, COMMON, days, min_count=1)
    slow = literal.seasonal(posts, stopwords_frame(spark), days, min_count=1)
    assert sorted(fused.collect()) == sorted(slow.collect())
    assert fused.count() > 3


def test_invariants(spark, sf_dir):
    posts = posts_from_documents(spark, sf_dir)
    rows = S.seasonal_words(posts, COMMON, WEEK_DAYS, min_count=1, threshold=0).collect()
    assert rows
    for row in rows:
        values = [row[f"d_{p}"] for p in S.PERIODS]
        assert all(abs(v * 7 - round(v * 7)) < 1e-9 for v in values)
        assert max(values) > 0
        assert abs(sum(values)) <= 2


def test_word_must_be_in_each_quarter(make_posts):
    def quarters(*seconds):
        return [(f"2024-01-01 {s:02d}:00:01", "full") for s in seconds]

    rows = quarters(1, 7, 13, 19) + [("2024-01-01 01:00:02", "part"), ("2024-01-01 07:00:02", "part")]
    history = S.word_history(make_posts(rows), None, ["2024-01-01"], min_count=0).collect()
    assert [(r.word, r.f_night, r.f_morning, r.f_evening, r.mean) for r in history] == [
        ("full", 0.5, 0.5, 1.0, 0.75)
    ]


def test_min_count_is_exclusive(make_posts):
    rows = [(s * 3600 + 5, "ten " * 10 + "eleven " * 11) for s in (1, 7, 13, 19)]
    history = S.word_history(make_posts(rows), None, ["2024-01-01"], min_count=10)
    assert [r.word for r in history.collect()] == ["eleven"]


def test_other_days_are_left_out(make_posts):
    rows = [(f"2024-01-0{d} {h:02d}:30:00", "w") for d in (1, 2, 3) for h in (1, 7, 13, 19)]
    history = S.word_history(make_posts(rows), None, ["2024-01-01", "2024-01-03"], min_count=0)
    assert sorted(str(r.day) for r in history.collect()) == ["2024-01-01", "2024-01-03"]


def test_deviation_rounds_to_whole_percent(spark):
    history = spark.createDataFrame([("d", "w", 0.5, 0.25, 0.125, 0.125, 0.25)], HISTORY)
    row = S.word_deviation(history).first()
    assert (row.d_morning, row.d_afternoon, row.d_evening, row.d_night) == (100.0, 0.0, -50.0, -50.0)


def test_zero_mean_gives_null_and_is_not_seasonal(spark):
    zero = (0.0,) * 5
    history = spark.createDataFrame(
        [("1", "w", *zero), ("2", "w", 0.9, 0.1, 0.1, 0.1, 0.3), ("1", "v", *zero)], HISTORY
    )
    means = S.mean_deviation(S.word_deviation(history), 2)
    rows = means.collect()
    assert [(r.word, r.d_morning) for r in rows] == [("w", None)]
    assert S.above_threshold(means).count() == 0


def test_threshold_is_exclusive(spark):
    means = spark.createDataFrame(
        [("at", 20.0, 0.0, 0.0, 0.0), ("above", 0.0, 0.0, 0.0, 20.0001)], MEANS
    )
    assert [r.word for r in S.above_threshold(means).collect()] == ["above"]


def test_plan_has_no_word_join_and_two_word_shuffles(spark, sf_dir):
    frame = S.seasonal_words(posts_from_documents(spark, sf_dir), COMMON, WEEK_DAYS)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert plan.count("split(") == 1
    assert plan.count("BroadcastHashJoin") == 1
    # (day, quarter, word), word, and the totals by (day, quarter).
    assert plan.count("Exchange hashpartitioning") == 3
