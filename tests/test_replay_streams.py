"""Anchored batches and bursts against other days on a stream, against the batch form."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from wordtide.operators import batches
from wordtide.plans import events as plans
from wordtide.sources.posts import history_json, history_json_stream, posts_stream_from_events
from wordtide.streaming import bursts as streams, history, replay

START = 1_704_067_200
STOP = ["le", "la"]


def stamp(second):
    moment = datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)
    return moment.strftime("%a %b %d %H:%M:%S +0000 %Y")


def write_days(root, days, seed=1, files=3):
    """`root/<day>/<day>/part-i` with the posts of each day dealt over files at random."""
    pick = random.Random(seed)
    for day, rows in days.items():
        folder = root / day / day
        folder.mkdir(parents=True, exist_ok=True)
        lines = [json.dumps({"id": i, "created_at": stamp(s), "text": text}) for i, (s, text) in enumerate(rows)]
        pick.shuffle(lines)
        for k in range(files):
            own = lines[k::files]
            if own:
                (folder / f"part-{k}-{pick.randrange(10**6)}.json").write_text("\n".join(own) + "\n")


def made(seed, n=120, span=200_000):
    pick = random.Random(seed)
    words = ["boom", "calme", "le", "rue", "pluie", "x" * 40]
    seconds = [pick.choice([pick.randrange(span), pick.randrange(0, span, 3600), 7200, 7200 + 3600]) for _ in range(n)]
    return [(s, " ".join(pick.choices(words, k=pick.randint(0, 30)))) for s in seconds]


def arriving(spark, root, tmp_path, delay="30 days"):
    """The stream's posts, with an end that `run_to_the_end` can close."""
    posts = history_json_stream(spark, str(root), maxFilesPerTrigger=1)
    closing = str(tmp_path / "closing")
    spark.createDataFrame([], streams.ARRIVING + ", day STRING").write.mode("append").parquet(closing)
    both = posts.unionByName(spark.readStream.schema(streams.ARRIVING + ", day STRING").parquet(closing))
    return streams.with_event_time(both, delay), closing


def to_the_end(spark, rows, tmp_path, closing):
    start = lambda: replay.write_batches(rows, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    streams.run_to_the_end(spark, start, closing)
    return read(spark, rows, tmp_path)


def read(spark, rows, tmp_path):
    return sorted(map(tuple, spark.read.schema(rows.schema).parquet(str(tmp_path / "out")).collect()))


@pytest.fixture
def days(tmp_path):
    found = {"2024-01-01": made(1), "2024-01-02": made(2), "day three": [(3600 * k, "x") for k in range(5)], "lone": [(5, "y")]}
    write_days(tmp_path / "posts", found)
    (tmp_path / "posts" / "lone" / "notes").write_text('{"id": 1}')
    (tmp_path / "posts" / "2024-01-01" / "other").mkdir()
    return found


def test_batches_of_several_day_folders(spark, days, tmp_path):
    """Files in any order, one per trigger: the chains of the stored form."""
    posts, closing = arriving(spark, tmp_path / "posts", tmp_path)
    rows = replay.stream_replay_batches(posts)
    got = to_the_end(spark, rows, tmp_path, closing)
    (tmp_path / "posts" / "lone" / "notes").unlink()
    stored = history_json(spark, str(tmp_path / "posts"))
    assert got == sorted(map(tuple, batches.replay_batches(stored).collect()))
    # A second start from the checkpoint adds nothing.
    replay.write_batches(rows, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert read(spark, rows, tmp_path) == got


def test_posts_find_their_batch(spark, days, tmp_path):
    posts, closing = arriving(spark, tmp_path / "posts", tmp_path)
    placed = replay.with_stream_replay_batch(posts.select("day", "event_time", "post_id")).select("day", "post_id", "batch_idx")
    got = to_the_end(spark, placed, tmp_path, closing)
    (tmp_path / "posts" / "lone" / "notes").unlink()
    stored = history_json(spark, str(tmp_path / "posts"))
    expected = batches.with_replay_batch(stored).select("day", "post_id", "batch_idx")
    assert got == sorted(map(tuple, expected.collect()))


def test_open_batches_wait_and_a_restart_goes_on(spark, tmp_path):
    """A batch is reported once, when no post can join it; its number goes on after a stop."""
    folder = str(tmp_path / "posts")

    def add(seconds):
        rows = spark.createDataFrame([(s,) for s in seconds], "s BIGINT")
        times = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), "s")
        rows.select(times.alias("ts"), F.lit("d").alias("day")).coalesce(1).write.mode("append").parquet(folder)

    def run():
        source = spark.readStream.schema("ts TIMESTAMP_NTZ, day STRING").option("maxFilesPerTrigger", 1).parquet(folder)
        rows = replay.stream_replay_batches(streams.with_event_time(source, "0 seconds"))
        replay.write_batches(rows, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return [r[1:] for r in read(spark, rows, tmp_path)]

    add([10, 10, 3610])  # 3610 is exactly an hour later: the same batch
    assert run() == []
    add([3612, 3700])  # opens batch 1; the first is over once the watermark is behind its end
    add([3900])
    first = [(0, START + 10, 3)]
    assert run() == first
    assert run() == first
    add([20_000])
    add([30_000])
    assert run() == [*first, (1, START + 3612, 3)] or run() == [*first, (1, START + 3612, 3), (2, START + 20_000, 1)]
    add([90_000])
    assert run()[:3] == [*first, (1, START + 3612, 3), (2, START + 20_000, 1)]


def test_late_posts_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "posts")
    for seconds in ([100], [50_000], [200], [99_000]):
        frame = spark.createDataFrame([(s,) for s in seconds], "s BIGINT")
        times = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), "s")
        frame.select(times.alias("ts"), F.lit("d").alias("day")).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema("ts TIMESTAMP_NTZ, day STRING").parquet(folder)
        rows = replay.stream_replay_batches(streams.with_event_time(source, "1 hour"))
        replay.write_batches(rows, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert read(spark, rows, tmp_path)[:2] == [("d", 0, START + 100, 1), ("d", 1, START + 50_000, 1)]


@pytest.mark.parametrize("align", ["ordinal", "hour"])
def test_bursts_against_a_stored_baseline(spark, tmp_path, align):
    past = {f"2024-01-0{d}": made(d, 60, 80_000) for d in (1, 2, 3)}
    write_days(tmp_path / "past", past)
    write_days(tmp_path / "posts", {"today": [*made(9, 60, 80_000), (100, "boom " * 200)]})
    history_posts = history_json(spark, str(tmp_path / "past"))
    n_days = plans.write_history_baseline(history_posts, STOP, str(tmp_path / "baseline"), align)
    assert n_days == 3
    baseline = history.read_baseline(spark, str(tmp_path / "baseline"))
    current = history_json(spark, str(tmp_path / "posts"))
    for eta in (-1, 1):
        posts, closing = arriving(spark, tmp_path / "posts", tmp_path / f"run{eta}", "3 days")
        rows = plans.stream_history_events(posts, baseline, n_days, STOP, eta, align)
        got = to_the_end(spark, rows, tmp_path / f"run{eta}", closing)
        expected = plans.history_events(current, history_posts, STOP, eta, align=align)
        wanted = sorted(map(tuple, expected.collect()))
        assert [g[:3] for g in got] == [w[:3] for w in wanted]
        assert all(abs(a - b) < 1e-9 for g, w in zip(got, wanted, strict=True) for a, b in zip(g[3:], w[3:], strict=True))
        assert got


def test_other_alignments_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        plans.stream_history_counts(None, None, 3, STOP, "minute")


def test_state_store_setting_is_put_back(spark):
    before = spark.conf.get(replay.PROVIDER, None)
    with replay.keyed_state(spark):
        assert spark.conf.get(replay.PROVIDER) == replay.ROCKSDB
    assert spark.conf.get(replay.PROVIDER, None) == before


def test_events_stream_has_the_stored_rows(spark, sf_dir):
    assert posts_stream_from_events(spark, sf_dir).isStreaming
