import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_batches import brute_force
from wordtide.operators import batches, chains

START = 1_704_067_200


def placed(spark, files, gap):
    rows = [(day, s) for day, seconds in files.items() for s in seconds]
    posts = spark.createDataFrame(rows, "day STRING, s BIGINT").select(
        F.col("s").alias("post_id"), F.expr("timestamp_seconds(s)").cast("timestamp_ntz").alias("ts"), "day"
    )
    found = batches.with_replay_batch(posts, gap)
    return {(r.day, r.post_id): (r.batch_idx, r.anchor_sec) for r in found.collect()}


@pytest.mark.parametrize("gap", [3600, 7_001, 100_000])
def test_files_of_many_days_against_brute_force(spark, gap):
    """Dense days, empty ones, posts around midnight, one post a day, and short files beside."""
    rng = random.Random(gap)
    dense = [START + rng.randrange(9 * 86_400) for _ in range(3_000)]
    holes = [START + d * 86_400 + rng.randrange(86_400) for d in (0, 1, 2, 5, 6, 9, 40) for _ in range(60)]
    midnight = [START + d * 86_400 + rng.randrange(-4_000, 4_000) for d in range(6) for _ in range(20)]
    single = [START + d * 86_400 + rng.choice([0, 5, 86_399]) for d in range(12)]
    before_1970 = [rng.randrange(-200_000, 200_000) for _ in range(300)]
    files = {"dense": dense, "holes": holes, "midnight": midnight, "single": single, "old": before_1970, "one": [START]}
    files = {day: sorted(set(seconds)) for day, seconds in files.items()}
    expected = {
        (day, s): found for day, seconds in files.items() for s, found in brute_force(seconds, gap).items()
    }
    assert placed(spark, files, gap) == expected


def test_every_second_of_three_days(spark):
    """No gap anywhere: a batch takes 3,601 seconds, so each block has an entry of its own."""
    posts = spark.range(START, START + 3 * 86_400).select(
        F.col("id").alias("post_id"), F.expr("timestamp_seconds(id)").cast("timestamp_ntz").alias("ts"),
        F.lit("x").alias("day"),
    )
    wrong = batches.with_replay_batch(posts).where(
        f"batch_idx != (post_id - {START}) DIV 3601 OR anchor_sec != {START} + batch_idx * 3601"
    )
    assert wrong.count() == 0


def test_jump_table_against_a_walk():
    rng = random.Random(3)
    gap, length = 20, chains.block_length(20)
    for n in (1, 5, 400, 5_000):
        start = rng.choice([-3, 0, 7]) * length
        seconds = np.array(sorted(rng.sample(range(start, start + length), n)))
        for entry, found in enumerate(chains.jump_table(seconds, start, length, gap)):
            open_until = start - 1 + entry
            for s in seconds:
                if s > open_until:
                    open_until = s + gap
            assert found == max(0, open_until - (start + length) + 1)


def test_no_gathering_by_file(make_posts):
    """Arrays hold the seconds of one block, however many days a file spans."""
    rows = [(f"2024-01-0{d} {h:02d}:30:00", "w") for d in range(1, 10) for h in (0, 23)]
    posts = make_posts(rows).withColumn("day", F.lit("all"))
    assert [r.n for r in batches._blocks(posts, 3600).select(F.size("seconds").alias("n")).collect()] == [2] * 9


def test_no_posts_at_all(make_posts):
    posts = make_posts([(0, "a")]).where("post_id < 0")
    assert batches.replay_batches(posts).count() == 0
