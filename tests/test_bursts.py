import math

import pytest
from pyspark.sql import functions as F

from wordtide.functions.poisson import interval_width
from wordtide.operators import bursts
from wordtide.plans import events as plans

COUNTS = "batch_idx BIGINT, word STRING, n_now BIGINT"


def test_window_minus_current(spark):
    counts = spark.createDataFrame([(0, "w", 4), (2, "w", 6), (2, "v", 1)], COUNTS)
    rows = bursts.current_vs_past(counts, 3, 0).where("word = 'w'").orderBy("batch_idx").collect()
    assert [(r.batch_idx, r.n_past, r.avg_past, r.is_warmup) for r in rows] == [
        (0, 0, 0.0, True), (2, 4, 2.0, False),
    ]
    window = bursts.windowed_counts(counts, 3).where("word = 'w'").orderBy("batch_idx").collect()
    assert [r.n_window for r in window] == [4, 10]


def test_window_forgets(spark):
    counts = spark.createDataFrame([(0, "w", 4), (3, "w", 6)], COUNTS)
    rows = bursts.current_vs_past(counts, 3, 0).orderBy("batch_idx").collect()
    assert [r.n_past for r in rows] == [0, 0]


def test_streams_do_not_mix(spark):
    counts = spark.createDataFrame(
        [("a", 0, "w", 4), ("b", 1, "w", 6)], "day STRING, " + COUNTS
    )
    rows = bursts.current_vs_past(counts, 2, 0, ["day"]).collect()
    assert {r.n_past for r in rows} == {0}


@pytest.mark.parametrize("n", [0, 1])
def test_windows_need_a_past(spark, n):
    counts = spark.createDataFrame([(0, "w", 4)], COUNTS)
    with pytest.raises(ValueError):
        bursts.current_vs_past(counts, n, 0)


def test_root_rule_is_exclusive(spark):
    joined = spark.createDataFrame([("at", 34, 6.0), ("above", 35, 6.0)], "word STRING, n_now BIGINT, avg_past DOUBLE")
    rows = bursts.with_margin(joined, -2, 4).collect()
    assert [(r.word, r.margin) for r in rows] == [("above", 28.0)]


@pytest.mark.parametrize("samples", [1, 4])
def test_poisson_rule_against_the_plain_filter(spark, samples):
    rows = [(n, t / samples) for t in (0, 1, 3, 20, 400) for n in range(0, 700, 3)]
    joined = spark.createDataFrame(rows, "n_now BIGINT, avg_past DOUBLE")
    got = {(r.n_now, r.avg_past): r.margin for r in bursts.with_margin(joined, 2, samples).collect()}
    expected = {}
    for n, avg in rows:
        margin = 2 * float(interval_width([avg * samples], samples)[0])
        if n > margin + avg:
            expected[(n, avg)] = margin
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], rel_tol=1e-12) for k in got)


def test_width_is_computed_once(spark):
    counts = spark.createDataFrame([(0, "w", 4)], COUNTS)
    plan = bursts.events_vs_past(counts, 2, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_history(make_posts):
    rows = [("2024-01-01 10:00:00", "w w w x"), ("2024-01-02 10:00:00", "w w w w w w")]
    rows += [("2024-01-03 10:00:00", "other"), ("2024-01-04 10:00:00", "w " * 50 + "new " * 90)]
    posts = make_posts(rows)
    placed = plans.aligned_batches(posts, "ordinal")
    tokens = placed.select("day", "batch_idx", F.explode(F.split("text", " ")).alias("word")).where("word <> ''")
    current = F.col("day") == F.lit("2024-01-04").cast("date")
    joined = bursts.current_vs_history(tokens, current, 3).collect()
    assert [(r.word, r.n_now, r.n_past, r.avg_past) for r in joined] == [("w", 50, 9, 3.0)]
    base = bursts.history_baseline(tokens.where(~current), 3).where("word = 'w'").first()
    assert (base.batch_idx, base.n_past, base.avg_past) == (0, 9, 3.0)
    events = bursts.events_vs_history(tokens, current, 3, -2).collect()
    assert [r.word for r in events] == ["w"]

    two_sided = plans.history_events(
        posts.where("to_date(ts) = '2024-01-04'"), posts.where("to_date(ts) < '2024-01-04'"), [], -2
    )
    assert two_sided.collect() == events


def test_alignment(make_posts):
    posts = make_posts([(3 * 3600, "a"), (9 * 3600, "b")])
    assert [r.batch_idx for r in plans.aligned_batches(posts, "ordinal").collect()] == [0, 1]
    assert [r.batch_idx for r in plans.aligned_batches(posts, "hour").collect()] == [3, 9]
    with pytest.raises(ValueError):
        plans.aligned_batches(posts, "minute")


def test_file_and_live_events(make_posts):
    calm = [(60, "calm Boom!")]
    burst = [(3700, "calm " + "Boom! " * 60)]
    posts = make_posts(calm + burst)
    found = plans.file_events(posts, ["calm"]).collect()
    assert [(str(r.day), r.batch_idx, r.word, r.n_now, r.avg_past) for r in found] == [
        ("2024-01-01", 1, "boom", 60, 1.0)
    ]
    live = plans.live_events(posts, n=31, eta=2).collect()
    assert ("Boom!", 60) in [(r.word, r.n_now) for r in live]
