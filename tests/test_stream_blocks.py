import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wordtide.operators import bursts
from wordtide.operators.batches import with_fixed_batch
from wordtide.operators.words import normalized_tokens
from wordtide.sources import posts as sources
from wordtide.streaming import bursts as streams, replay

HOUR = 3600
COLUMNS = ["word", "n_now", "avg_past", "margin", "batch_idx"]


def rows_of(frame):
    return sorted(map(tuple, frame.select(*COLUMNS).collect()))


@pytest.fixture(scope="module")
def posts_folder(spark, tmp_path_factory):
    """Two days of posts in three files in no order of time; bursts at ends and beginnings of blocks."""
    pick = random.Random(4)
    rows = [(pick.randrange(48 * HOUR), pick.choice(["w", "x", "y z"])) for _ in range(900)]
    rows += [(h * HOUR + i, "burst " * 3 + "other") for h in (0, 7, 8, 23, 24, 25, 47) for i in range(10 + h)]
    pick.shuffle(rows)
    folder = str(tmp_path_factory.mktemp("posts") / "posts")
    for part in range(3):
        frame = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows[part::3])], "post_id BIGINT, s BIGINT, text STRING")
        start = F.lit("2024-01-01").cast("timestamp_ntz")
        at = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), "s")
        posts = frame.select("post_id", at.alias("ts"), F.lit(None).cast("string").alias("lang"), "text")
        posts.coalesce(1).write.mode("append").parquet(folder)
    return folder


@pytest.mark.parametrize(("block", "n", "eta"), [(2, 5, -1), (8, 3, 2), (24, 5, 2), (24, 2, -1)])
def test_blocks_equal_the_batch_form(spark, posts_folder, tmp_path, block, n, eta):
    at = str(tmp_path)
    arriving = spark.readStream.schema(streams.ARRIVING).option("maxFilesPerTrigger", 1).parquet(posts_folder)
    timed = streams.with_event_time(streams.with_closing(arriving, f"{at}/closing"), "3 days")
    tokens = normalized_tokens(timed.select("event_time", "text"))
    found = streams.stream_events(tokens, n, eta, block=block)
    streams.run_to_the_end(spark, lambda: streams.write_events(found, f"{at}/out", f"{at}/checkpoint"), f"{at}/closing")
    placed = with_fixed_batch(spark.read.parquet(posts_folder)).select("batch_idx", "text")
    expected = rows_of(bursts.events_vs_past(bursts.batch_word_counts(normalized_tokens(placed)), n, eta))
    assert expected and rows_of(spark.read.parquet(f"{at}/out")) == expected


def test_a_block_is_reported_when_its_last_batch_has_closed(spark, posts_folder, tmp_path):
    at = str(tmp_path)
    arriving = spark.readStream.schema(streams.ARRIVING).parquet(posts_folder)
    tokens = normalized_tokens(streams.with_event_time(arriving, "0 seconds").select("event_time", "text"))
    found = streams.stream_events(tokens, 5, -1, block=24)
    streams.write_events(found, f"{at}/out", f"{at}/checkpoint").awaitTermination()
    placed = with_fixed_batch(spark.read.parquet(posts_folder)).select("batch_idx", "text")
    whole = bursts.events_vs_past(bursts.batch_word_counts(normalized_tokens(placed)), 5, -1)
    second_day = 1_704_067_200 // HOUR + 24
    expected = rows_of(whole.where(F.col("batch_idx") < second_day))
    assert expected and rows_of(spark.read.parquet(f"{at}/out")) == expected
    assert whole.count() > len(expected)


def test_counts_of_blocks_are_whole(spark, posts_folder):
    """On a stored frame: all counts, also those that are no events; a block is one batch at least."""
    posts = spark.read.parquet(posts_folder)
    tokens = normalized_tokens(streams.with_event_time(posts, "1 day").select("event_time", "text"))
    counts = bursts.batch_word_counts(normalized_tokens(with_fixed_batch(posts).select("batch_idx", "text")))
    columns = ["batch_idx", "word", "n_now", "n_past", "avg_past"]
    expected = sorted(map(tuple, bursts.current_vs_past(counts, 4, 0).select(*columns).collect()))
    for block in (1, 7):
        found = streams.stream_counts_vs_past(tokens, 4, block=block).select(*columns)
        assert sorted(map(tuple, found.collect())) == expected
    with pytest.raises(ValueError):
        streams.stream_counts_vs_past(tokens, 4, block=0)


@pytest.mark.parametrize("eta", [-5, -0.5, 0, 0.5, 2])
@pytest.mark.parametrize("samples", [1, 4])
def test_no_event_has_a_count_up_to_the_least_margin(spark, eta, samples):
    grid = spark.range(70).selectExpr("id AS n_now").crossJoin(spark.range(40).selectExpr(f"id / {samples} AS avg_past"))
    least = bursts.least_margin(eta, samples)
    marked = bursts.with_margin(grid, eta, samples).withColumn("above", F.col("n_now") > least)
    assert marked.count() and marked.where("NOT above").count() == 0


@pytest.mark.parametrize("query", ["stream_event_words", "stream_events_poisson"])
def test_queries_keep_a_row_per_word_and_day(spark, tmp_path, monkeypatch, query):
    """Before: a row per word and hour, and one more for each of the five windows that hold the hour."""
    second = lambda doc: doc * sources.SPREAD % sources.WEEK_SECONDS
    burst = [doc for doc in range(60_000) if 50 * HOUR <= second(doc) < 51 * HOUR][:60]
    rows = [(doc, "alpha beta", "en") for doc in range(400)] + [(doc, "boom", "en") for doc in burst if doc >= 400]
    spark.createDataFrame(rows, sources.DOCUMENTS).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    started = []
    append = streams._append

    def noted(*given):
        started.append(append(*given))
        return started[-1]

    monkeypatch.setattr(streams, "_append", noted)
    found = entry.queries()[query](spark, str(tmp_path)).select("word", "batch_idx").collect()
    assert sorted(map(tuple, found)) == [("boom", sources.WEEK_START_EPOCH // HOUR + 50)]
    operators = [op for query in started for progress in query.recentProgress for op in progress["stateOperators"]]
    placed = with_fixed_batch(sources.posts_from_documents(spark, str(tmp_path))).select("batch_idx", "text")
    counts = bursts.batch_word_counts(normalized_tokens(placed)).count()
    assert 0 < sum(op["numRowsUpdated"] for op in operators) <= 3 * 9 < counts
    assert replay.PROVIDER not in spark.conf.getAll and replay.ROW_COUNTS not in spark.conf.getAll
