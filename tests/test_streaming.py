import pytest
from pyspark.sql import functions as F

from wordtide.operators import bursts
from wordtide.operators.batches import with_fixed_batch
from wordtide.streaming import bursts as streams

HOUR = 3600
SCHEMA = "ts TIMESTAMP_NTZ, word STRING"


@pytest.fixture
def arrivals(spark, tmp_path):
    """A folder of files; each call of `add` lands one file of `(second, word, times)` rows."""
    folder = str(tmp_path / "arrivals")

    def add(rows):
        data = [(s, w) for s, w, times in rows for _ in range(times)]
        frame = spark.createDataFrame(data, "s BIGINT, word STRING")
        frame.select(
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), "s")).alias("ts"),
            "word",
        ).coalesce(1).write.mode("append").parquet(folder)

    add.folder = folder
    return add


ROWS = [
    (10, "w", 4), (20, "x", 1), (HOUR + 5, "w", 1), (2 * HOUR + 1, "w", 90), (3 * HOUR, "x", 70),
    (5 * HOUR, "w", 3), (5 * HOUR + 9, "x", 60), (9 * HOUR, "y", 80), (9 * HOUR + 30, "z", 1),
]


def events(spark, folder, eta, n=3, delay="0 seconds", **options):
    posts = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return streams.stream_events(streams.with_event_time(posts, delay), n, eta, **options)


def run(query):
    query.awaitTermination()


def read(spark, path):
    schema = "word STRING, n_now BIGINT, avg_past DOUBLE, margin DOUBLE, batch_idx BIGINT"
    return sorted(tuple(r) for r in spark.read.schema(schema + ", day DATE").parquet(path).drop("day").collect())


@pytest.mark.parametrize("eta", [-1, 2])
def test_stream_equals_batch_on_closed_batches(spark, arrivals, tmp_path, eta):
    arrivals(ROWS[:5])
    arrivals(ROWS[5:])
    out = str(tmp_path / "out")
    run(streams.write_events(events(spark, arrivals.folder, eta), out, str(tmp_path / "checkpoint")))

    stored = spark.read.schema(SCHEMA).parquet(arrivals.folder)
    counts = bursts.batch_word_counts(with_fixed_batch(stored))
    batch = bursts.events_vs_past(counts, 3, eta)
    last = stored.agg(F.max(F.unix_timestamp("ts"))).first()[0]
    closed = batch.where((F.col("batch_idx") + 1) * HOUR <= last)
    expected = sorted(tuple(r) for r in closed.select("word", "n_now", "avg_past", "margin", "batch_idx").collect())
    assert expected and read(spark, out) == expected
    assert batch.count() > len(expected)


def test_restart_adds_only_new_batches(spark, arrivals, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    arrivals(ROWS[:5])
    run(streams.write_events(events(spark, arrivals.folder, -1), out, checkpoint))
    first = read(spark, out)
    run(streams.write_events(events(spark, arrivals.folder, -1), out, checkpoint))
    assert read(spark, out) == first
    arrivals(ROWS[5:])
    run(streams.write_events(events(spark, arrivals.folder, -1), out, checkpoint))
    later = read(spark, out)
    assert set(first) < set(later) and len(later) == len(set(later))

    whole = str(tmp_path / "whole")
    run(streams.write_events(events(spark, arrivals.folder, -1), whole, str(tmp_path / "checkpoint2")))
    assert read(spark, whole) == later


def test_late_posts(spark, arrivals, tmp_path):
    """Later than the watermark: dropped. Within the delay: counted."""
    arrivals([(10, "w", 30), (5 * HOUR, "x", 1)])
    for delay, expected in (("0 seconds", 30), ("9 hours", 60)):
        folder = str(tmp_path / delay.replace(" ", ""))
        run(streams.write_events(events(spark, arrivals.folder, -1, delay=delay), f"{folder}/out", f"{folder}/checkpoint"))
    arrivals([(20, "w", 30)])
    arrivals([(30 * HOUR, "x", 1)])
    for delay, expected in (("0 seconds", 30), ("9 hours", 60)):
        folder = str(tmp_path / delay.replace(" ", ""))
        run(streams.write_events(events(spark, arrivals.folder, -1, delay=delay), f"{folder}/out", f"{folder}/checkpoint"))
        got = [(r[0], r[1]) for r in read(spark, f"{folder}/out")]
        assert got == [("w", expected)]


def test_event_words_as_text(spark, arrivals, tmp_path):
    arrivals(ROWS)
    out = str(tmp_path / "words")
    run(streams.write_event_words(events(spark, arrivals.folder, -1), out, str(tmp_path / "checkpoint")))
    rows = spark.read.text(out).collect()
    start = 1_704_067_200 // HOUR
    assert ("w", start + 2) in [(r.value, r.batch_idx) for r in rows]


def test_windows_need_a_past(spark, arrivals):
    arrivals(ROWS[:1])
    with pytest.raises(ValueError):
        events(spark, arrivals.folder, 2, n=1)


def test_live_stream_equals_live_events(spark, make_posts, tmp_path):
    from wordtide.plans.events import live_events, live_stream_events

    rows = [(10, "calm"), (130, "Boom! " * 40 + "calm"), (250, "Boom!"), (2000, "late " * 50), (2500, "end")]
    folder = str(tmp_path / "posts")
    make_posts(rows).write.parquet(folder)
    stored = spark.read.parquet(folder)
    arriving = spark.readStream.schema(stored.schema).parquet(folder)
    out = str(tmp_path / "out")
    first = 1_704_067_200 // 120
    closed = streams.with_closing(arriving, str(tmp_path / "closing"))
    found = live_stream_events(closed, "1 hour", first_batch=first)
    streams.run_to_the_end(
        spark, lambda: streams.write_events(found, out, str(tmp_path / "checkpoint"), seconds=120), str(tmp_path / "closing")
    )
    columns = ["word", "n_now", "avg_past", "margin", "is_warmup", "batch_idx"]
    expected = sorted(tuple(r) for r in live_events(stored).select(*columns).collect())
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*columns).collect())
    assert got == expected
    assert [(r[0], r[4]) for r in got] == [("Boom!", True), ("late", False)]


@pytest.mark.parametrize("eta", [-1, 2])
def test_files_in_no_order_lose_nothing(spark, make_posts, tmp_path, eta):
    """One file per micro-batch, shuffled in time: with a delay that covers it, all batches are whole."""
    import random

    pick = random.Random(eta)
    rows = [(pick.randrange(20 * HOUR), pick.choice(["w", "x", "y"] + ["burst"] * (i % 7 == 0))) for i in range(900)]
    rows += [(11 * HOUR + i, "burst " * 3) for i in range(60)]
    pick.shuffle(rows)
    folder = str(tmp_path / "posts")
    for i in range(0, len(rows), 240):
        make_posts(rows[i : i + 240]).coalesce(1).write.mode("append").parquet(folder)
    stored = spark.read.parquet(folder)
    arriving = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    closing = str(tmp_path / "closing")
    timed = streams.with_event_time(streams.with_closing(arriving, closing), "1 day")
    from wordtide.operators.words import normalized_tokens

    tokens = normalized_tokens(timed.select("event_time", "text"))
    found = streams.stream_events(tokens, 3, eta)
    streams.run_to_the_end(
        spark, lambda: streams.write_events(found, str(tmp_path / "out"), str(tmp_path / "checkpoint")), closing
    )
    placed = with_fixed_batch(stored).select("batch_idx", "text")
    batch = bursts.events_vs_past(bursts.batch_word_counts(normalized_tokens(placed)), 3, eta)
    expected = sorted(tuple(r) for r in batch.select("word", "n_now", "avg_past", "margin", "batch_idx").collect())
    assert expected and read(spark, str(tmp_path / "out")) == expected


def test_windows_slide_over_counts(spark, arrivals, tmp_path):
    """Words are counted by batch before a window expands anything."""
    arrivals(ROWS)
    query = streams.write_events(events(spark, arrivals.folder, -1), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    run(query)
    plan = query._jsq.explainInternal(False)
    assert plan.index("Expand") < plan.rindex("StateStoreSave")


def test_print_events(spark, arrivals, tmp_path):
    arrivals(ROWS)
    query = streams.print_events(events(spark, arrivals.folder, -1), str(tmp_path / "checkpoint"))
    run(query)
    assert query.exception() is None


def test_scratch_folder_is_below_the_shared_one(spark):
    from types import SimpleNamespace

    from wordtide.scratch import scratch_folder

    # The setting is fixed when a cluster's session starts, so a stand-in has it here.
    shared = {"spark.checkpoint.dir": "hdfs://cluster/shared/"}
    session = SimpleNamespace(conf=SimpleNamespace(get=shared.get))
    assert scratch_folder(session, "label").startswith("hdfs://cluster/shared/label-")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        cluster = SimpleNamespace(conf=SimpleNamespace(get={"spark.master": master}.get))
        with pytest.raises(ValueError):
            scratch_folder(cluster, "label")
    assert "label" in scratch_folder(spark, "label")
