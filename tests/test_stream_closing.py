import os

import pytest
from pyspark.sql import functions as F

from wordtide.operators import batches
from wordtide.plans import events as plans
from wordtide.streaming import bursts as streams, history, replay

HOUR = 3600
BURSTS = [(h * HOUR + 7 * i, "calm " + f"burst{i} " * 60) for h in (2, 1, 5) for i in range(40)]


def triggers(checkpoint):
    return len([name for name in os.listdir(f"{checkpoint}/commits") if name.isdigit()])


def part_files(folder):
    found = {}
    for at, _, names in os.walk(folder):
        if "batch_idx=" in at:
            found[at] = sum(name.startswith("part-") for name in names)
    return found


@pytest.fixture
def run(spark, make_posts, tmp_path):
    """Runs `write` on a stream of files in no order of time; returns its output and checkpoint."""

    def of(rows, rows_of, write, name, **options):
        folder = str(tmp_path / "posts")
        if not os.path.exists(folder):
            for part in range(3):
                make_posts(rows[part::3]).coalesce(1).write.mode("append").parquet(folder)
        at = str(tmp_path / name)
        arriving = spark.readStream.schema(streams.ARRIVING).parquet(folder)
        timed = streams.with_event_time(streams.with_closing(arriving, f"{at}/closing"), "8 days")
        made = rows_of(timed.withColumn("day", F.to_date("ts").cast("string")).select("day", "event_time", "text"))
        streams.run_to_the_end(spark, lambda: write(made, f"{at}/out", f"{at}/checkpoint"), f"{at}/closing", **options)
        return f"{at}/out", f"{at}/checkpoint", spark.read.parquet(folder)

    return of


def words_of(timed):
    return streams.stream_events(plans.live_tokens(timed.select("event_time", "text")), 3, -1)


@pytest.mark.parametrize("write", [streams.write_event_words, streams.write_events])
def test_a_batch_is_few_files_whatever_the_number_of_tasks(spark, run, write):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out, _, _ = run(BURSTS, words_of, write, "many", at_once=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = part_files(out)
    assert len(files) == 3 and max(files.values()) <= streams.BATCH_FILES


def test_closing_at_once_gives_the_same_in_two_triggers(spark, run):
    found = {}
    for name, options in (("twice", {}), ("once", {"at_once": True})):
        out, checkpoint, _ = run(BURSTS, words_of, streams.write_events, name, **options)
        rows = spark.read.parquet(out).select("word", "n_now", "avg_past", "margin", "batch_idx").collect()
        found[name] = sorted(map(tuple, rows)), triggers(checkpoint)
    assert found["once"][0] and found["once"][0] == found["twice"][0]
    assert found["once"][1] == 2 < found["twice"][1]


def test_anchored_counts_closed_at_once_equal_the_stored_ones(spark, run, make_posts, tmp_path):
    past = batches.with_day(make_posts([(s + 60, text) for s, text in BURSTS]))
    n_days = plans.write_history_baseline(past, ["calm"], str(tmp_path / "baseline"))
    baseline = history.read_baseline(spark, str(tmp_path / "baseline"))
    out, checkpoint, posts = run(
        BURSTS,
        lambda timed: plans.stream_history_counts(timed, baseline, n_days, ["calm"]).drop("event_hour"),
        replay.write_batches,
        "anchored",
        at_once=True,
    )
    columns = ["batch_idx", "word", "n_now", "n_past", "avg_past"]
    both = [plans.aligned_batches(p).select("batch_idx", "text", F.lit(now).alias("now")) for p, now in ((posts, True), (past, False))]
    tokens = plans.normalized_tokens(both[0].union(both[1]), ["calm"])
    stored = plans.bursts.current_vs_history(tokens, F.col("now"), n_days).select(*columns)
    got = spark.read.parquet(out).select(*columns)
    assert got.count() and sorted(map(tuple, got.collect())) == sorted(map(tuple, stored.collect()))
    assert triggers(checkpoint) == 2
