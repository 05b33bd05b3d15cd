import random

import pytest
from pyspark.sql import functions as F

from wordtide.operators import batches


def brute_force(seconds, gap=3600):
    """Batch number of each second, in time order."""
    out, anchor, index = {}, None, -1
    for s in sorted(seconds):
        if anchor is None or s > anchor + gap:
            anchor, index = s, index + 1
        out[s] = (index, anchor)
    return out


def test_anchors(make_posts):
    posts = make_posts([(s, str(s)) for s in (0, 3600, 3601, 7201, 7202, 20000)])
    rows = batches.with_replay_batch(posts).orderBy("ts").collect()
    assert [r.batch_idx for r in rows] == [0, 0, 1, 1, 2, 3]


def test_counts_per_batch(make_posts):
    posts = make_posts([(5, "a"), (5, "b"), (3606, "c")])
    rows = batches.replay_batches(posts).orderBy("batch_idx").collect()
    start = 1_704_067_200
    assert [(r.batch_idx, r.anchor_sec, r.n_posts) for r in rows] == [(0, start + 5, 2), (1, start + 3606, 1)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("gap", [3600, 700])
def test_against_brute_force(make_posts, seed, gap):
    rng = random.Random(seed)
    days = {}
    rows = []
    for day in (1, 2):
        seconds = [rng.randrange(86_400) for _ in range(rng.choice([1, 20, 300]))]
        seconds += [rng.randrange(24) * 3600 for _ in range(6)]
        days[day] = brute_force(seconds, gap)
        rows += [(f"2024-01-0{day} {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", f"{day} {s}") for s in seconds]
    for row in batches.with_replay_batch(make_posts(rows), gap).collect():
        day, second = map(int, row.text.split())
        index, anchor = days[day][second]
        assert row.batch_idx == index
        assert row.anchor_sec == 1_704_067_200 + (day - 1) * 86_400 + anchor


def test_day_of_the_source_may_run_past_midnight(make_posts):
    posts = make_posts([("2024-01-01 23:30:00", "a"), ("2024-01-02 00:30:00", "b"), ("2024-01-02 00:30:01", "c")])
    posts = posts.withColumn("day", F.lit("2024-01-01").cast("date"))
    rows = batches.with_replay_batch(posts).orderBy("ts").collect()
    assert [r.batch_idx for r in rows] == [0, 0, 1]
    assert {str(r.day) for r in rows} == {"2024-01-01"}


def test_fractions_of_a_second_do_not_count(make_posts):
    posts = make_posts([("2024-01-01 00:00:00.9", "a"), ("2024-01-01 01:00:00.95", "b")])
    assert [r.batch_idx for r in batches.with_replay_batch(posts).collect()] == [0, 0]


def test_fixed_batches_are_clock_aligned(make_posts):
    posts = make_posts([(0, "a"), (119, "b"), (120, "c")])
    rows = batches.with_fixed_batch(posts, 120).orderBy("ts").collect()
    first = 1_704_067_200 // 120
    assert [r.batch_idx for r in rows] == [first, first, first + 1]


def test_posts_are_not_shuffled(make_posts):
    plan = batches.with_replay_batch(make_posts([(0, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 1


def test_large_lookups_are_shuffled(make_posts, monkeypatch):
    from wordtide.operators import small

    rows = [(s, str(s)) for s in (0, 3600, 3601, 7201, 7202, 20000)]
    monkeypatch.setattr(small, "BROADCAST_ROWS", 2)
    placed = batches.with_replay_batch(make_posts(rows))
    assert [r.batch_idx for r in placed.orderBy("ts").collect()] == [0, 0, 1, 1, 2, 3]


def test_stray_times_make_no_slots_between(make_posts):
    posts = make_posts([("0001-01-01 00:00:00", "a"), ("2024-01-01 00:00:00", "b")])
    posts = posts.withColumn("day", F.lit("2024-01-01").cast("date"))
    rows = batches.with_replay_batch(posts).orderBy("ts").collect()
    assert [r.batch_idx for r in rows] == [0, 1]
    assert batches._slots(posts, 3600).count() == 2


def test_posts_without_a_time_have_no_batch(make_posts):
    posts = make_posts([(5, "kept")])
    posts = posts.unionByName(posts.withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    assert batches.with_fixed_batch(posts).count() == 1
    assert batches.with_replay_batch(posts).count() == 1
