"""

Every query reads whole tables of `sf_dir`. Posts are the rows of `documents`, each with
its own second of one week (see `wordtide.sources.posts`).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from wordtide.functions import patterns as P, times  # noqa: E402
from wordtide.functions.poisson import poisson_ci  # noqa: E402
from wordtide.functions.text import basic_words  # noqa: E402
from wordtide.operators import batches, bursts, frequency, seasonality, topics, words  # noqa: E402
from wordtide.plans import events as event_plans, topics as topic_plans  # noqa: E402
from wordtide.scratch import scratch_folder  # noqa: E402
from wordtide.sinks import text as text_sinks  # noqa: E402
from wordtide.sources import posts as sources  # noqa: E402
from wordtide.sources.stopwords import COMMON, stopwords_frame  # noqa: E402
from wordtide.streaming import bursts as streams, history as stream_history, replay as stream_replay  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from wordtide.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "wordtide.llm"):
        raise
    llm_queries = None

DAYS = sources.WEEK_DAYS
LAST_DAY = DAYS[-1]
WEEK = (f"{DAYS[0]} 00:00:00", "2024-01-08 00:00:00")


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.posts_from_documents(spark, sf_dir)


# --- sources -------------------------------------------------------------------------


def posts(spark, sf_dir):
    return _posts(spark, sf_dir)


def event_time_parse(spark, sf_dir):
    rendered = _posts(spark, sf_dir).select(
        "post_id", times.format_created_at(F.col("ts")).alias("created_at")
    )
    return rendered.withColumn("ts", times.parse_created_at(F.col("created_at")))


def posts_from_json(spark, sf_dir):
    return sources.posts_from_rendered_json(spark, sf_dir)


def stopwords(spark, sf_dir):
    """Stop words with the number of posts that hold them; a post names each at most once."""
    listed = F.array(*map(F.lit, sorted(set(COMMON))))
    found = F.array_intersect(basic_words(F.col("text")), listed)
    held = _posts(spark, sf_dir).select(F.explode_outer(found).alias("word"))
    counts = held.groupBy("word").agg(F.count("*").alias("n_posts"))
    return stopwords_frame(spark).join(counts, "word", "left").select(
        "word", F.coalesce("n_posts", F.lit(0)).alias("n_posts")
    )


def history_days(spark, sf_dir):
    past = batches.with_day(_posts(spark, sf_dir)).where(F.col("day") != F.lit(LAST_DAY).cast("date"))
    return bursts.history_days(past)


def time_range_filter(spark, sf_dir):
    rows = sources.posts_from_events(spark, sf_dir)
    inside = times.strictly_between(F.col("ts"), "2024-01-03 10:00:00", "2024-01-17 18:00:00")
    return rows.where(inside).select("post_id", "ts", "text")


# --- words ---------------------------------------------------------------------------


def tokens_basic(spark, sf_dir):
    return words.basic_tokens(_posts(spark, sf_dir).select("post_id", "text"))


def tokens_live(spark, sf_dir):
    return words.live_tokens(_posts(spark, sf_dir).select("post_id", "text"))


def normalized_tokens(spark, sf_dir):
    return words.normalized_tokens(_posts(spark, sf_dir).select("post_id", "text"), COMMON)


# --- frequencies and seasonal words --------------------------------------------------


def word_counts(spark, sf_dir):
    return frequency.period_word_counts(_posts(spark, sf_dir))


def period_totals(spark, sf_dir):
    return frequency.period_totals(_posts(spark, sf_dir))


def word_frequency(spark, sf_dir):
    return frequency.period_word_frequency(_posts(spark, sf_dir), stopwords_frame(spark), days=DAYS)


def top_words(spark, sf_dir):
    return frequency.count_words(_posts(spark, sf_dir), *WEEK, COMMON, top_x=100)[0]


def week_word_frequency(spark, sf_dir):
    return frequency.count_words(_posts(spark, sf_dir), *WEEK, stopwords_frame(spark))[1]


def word_history(spark, sf_dir):
    return seasonality.word_history(_posts(spark, sf_dir), COMMON, DAYS)


def word_history_by_mean(spark, sf_dir):
    """The whole history, the largest mean of a word on a day first."""
    history = word_history(spark, sf_dir)
    return frequency.top_words(history, by="mean", then="day").select("day", "word", "mean")


def word_deviation(spark, sf_dir):
    return seasonality.word_deviation(word_history(spark, sf_dir))


def mean_deviation(spark, sf_dir):
    return seasonality.mean_deviation(word_deviation(spark, sf_dir), len(DAYS))


def seasonal_words(spark, sf_dir):
    return seasonality.seasonal_words(_posts(spark, sf_dir), COMMON, DAYS)


def seasonal_words_min1(spark, sf_dir):
    return seasonality.seasonal_words(_posts(spark, sf_dir), COMMON, DAYS, min_count=1)


def seasonal_word_list(spark, sf_dir):
    return text_sinks.seasonal_word_list(seasonal_words_min1(spark, sf_dir))


def seasonal_rows_text(spark, sf_dir):
    return text_sinks.seasonal_rows(seasonal_words_min1(spark, sf_dir))


# --- batches and bursts --------------------------------------------------------------


def _fixed_tokens(spark, sf_dir):
    placed = batches.with_fixed_batch(_posts(spark, sf_dir)).select("batch_idx", "text")
    return words.normalized_tokens(placed, COMMON)


def _replay_tokens(spark, sf_dir):
    placed = batches.with_replay_batch(_posts(spark, sf_dir)).select(*event_plans.KEPT)
    return words.normalized_tokens(placed, COMMON)


def fixed_batch_counts(spark, sf_dir):
    return bursts.batch_word_counts(_fixed_tokens(spark, sf_dir))


def replay_batches(spark, sf_dir):
    return batches.replay_batches(_posts(spark, sf_dir))


def replay_batches_events(spark, sf_dir):
    return batches.replay_batches(sources.posts_from_events(spark, sf_dir))


def replay_batches_by_month(spark, sf_dir):
    """One chain of batches per month, as in a file that holds a month of posts."""
    posts = sources.posts_from_events(spark, sf_dir)
    return batches.replay_batches(posts.withColumn("day", F.trunc("ts", "month")))


def windowed_counts(spark, sf_dir):
    return bursts.windowed_counts(fixed_batch_counts(spark, sf_dir), 5)


def current_vs_past(spark, sf_dir):
    placed = batches.with_fixed_batch(_posts(spark, sf_dir))
    first = placed.agg(F.min("batch_idx")).scalar()
    return bursts.current_vs_past(fixed_batch_counts(spark, sf_dir), 5, first)


def _rounded(events):
    """Two engines agree on interval widths to about 1e-9; the SQL check compares values."""
    return events.withColumn("margin", F.round("margin", 4))


def events_root_rule(spark, sf_dir):
    return bursts.events_vs_past(fixed_batch_counts(spark, sf_dir), 5, -2)


def events_poisson_rule(spark, sf_dir):
    return _rounded(bursts.events_vs_past(fixed_batch_counts(spark, sf_dir), 5, 2))


def replay_events_root(spark, sf_dir):
    return event_plans.file_events(_posts(spark, sf_dir), COMMON, eta=-3)


def replay_events_poisson(spark, sf_dir):
    return _rounded(event_plans.file_events(_posts(spark, sf_dir), COMMON))


def live_events_poisson(spark, sf_dir):
    return _rounded(event_plans.live_events(_posts(spark, sf_dir)))


def poisson_interval(spark, sf_dir):
    past = bursts.current_vs_past(fixed_batch_counts(spark, sf_dir), 5, 0)
    totals = past.select(F.col("n_past").alias("total")).distinct()
    width = F.round(poisson_ci(F.col("total"), 4), 4)
    return totals.select("total", F.lit(4).alias("n"), width.alias("ci"))


def _is_last_day():
    return F.col("day") == F.lit(LAST_DAY).cast("date")


def history_baseline(spark, sf_dir):
    past = _replay_tokens(spark, sf_dir).where(~_is_last_day())
    return bursts.history_baseline(past, len(DAYS) - 1)


def current_vs_history(spark, sf_dir):
    return bursts.current_vs_history(_replay_tokens(spark, sf_dir), _is_last_day(), len(DAYS) - 1)


def current_vs_history_by_hour(spark, sf_dir):
    placed = event_plans.aligned_batches(_posts(spark, sf_dir), "hour")
    tokens = words.normalized_tokens(placed, COMMON)
    return bursts.current_vs_history(tokens, _is_last_day(), len(DAYS) - 1)


def _events_vs_history(eta):
    def query(spark, sf_dir):
        tokens = _replay_tokens(spark, sf_dir)
        events = bursts.events_vs_history(tokens, _is_last_day(), len(DAYS) - 1, eta)
        return events if eta < 0 else _rounded(events)

    return query


def history_events_union(spark, sf_dir):
    """Bursts of the last day against the others, from two tables of posts."""
    posts = batches.with_day(_posts(spark, sf_dir))
    current, history = posts.where(_is_last_day()), posts.where(~_is_last_day())
    return _rounded(event_plans.history_events(current, history, COMMON, eta=2))


# --- topics --------------------------------------------------------------------------


def _word_arrays(spark, sf_dir):
    return topic_plans.words_between(_posts(spark, sf_dir), *WEEK, COMMON)


def stopword_arrays(spark, sf_dir):
    return _word_arrays(spark, sf_dir).select(
        "post_id", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words")
    )


def vocabulary(spark, sf_dir):
    return topics.vocabulary(_word_arrays(spark, sf_dir))


def bag_of_words(spark, sf_dir):
    arrays = _word_arrays(spark, sf_dir)
    return topics.bag_of_words(arrays, topics.vectorizer(arrays))


_fitted: dict[tuple, topics.TopicModel] = {}


def _lda(spark, sf_dir):
    """One fit serves all topic queries of a session and table."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _fitted:
        while _fitted:
            other, model = _fitted.popitem()
            if other[0] == key[0]:
                model.close()
        _fitted[key] = topics.fit_topics(_word_arrays(spark, sf_dir))
    return _fitted[key]


def lda_topics(spark, sf_dir):
    return _lda(spark, sf_dir).topics()


def lda_topic_terms(spark, sf_dir):
    """What holds of any fit: terms of the vocabulary, the heaviest first."""
    model = _lda(spark, sf_dir)
    terms = F.split("terms", ",")
    return model.topics().select(
        "topic",
        F.size(terms).alias("n_terms"),
        (F.size(F.array_except(terms, F.array(*map(F.lit, model.terms)))) == 0).alias("all_known"),
        (F.reverse(F.array_sort("weights")) == F.col("weights")).alias("descending"),
    )


def lda_post_topics(spark, sf_dir):
    return _lda(spark, sf_dir).post_topics()


def _mixture_sums(mixtures):
    total = F.aggregate("mixture", F.lit(0.0), lambda a, b: a + b)
    return mixtures.select(
        "post_id", F.size("mixture").alias("n_topics"), F.round(total, 6).alias("total")
    )


def lda_post_sums(spark, sf_dir):
    """What holds of any fit: a mixture sums to 1, or to 0 without a term of the vocabulary."""
    return _mixture_sums(_lda(spark, sf_dir).post_topics())


def lda_quality(spark, sf_dir):
    return _lda(spark, sf_dir).quality()


# --- streams -------------------------------------------------------------------------


#: Files of `documents` are in no order of time, and span a week.
DISORDER = "8 days"

#: Batches of a day: with such a disorder, batches need not be reported hour by hour.
BLOCK = 24


def _run_stream(spark, sf_dir, eta, write):
    """Run the stream to its end; `write` starts it on events, a folder and a checkpoint."""
    folder = scratch_folder(spark, "stream")
    closing = f"{folder}/closing"
    arriving = streams.with_closing(sources.posts_stream_from_documents(spark, sf_dir), closing)
    timed = streams.with_event_time(arriving, DISORDER).select("event_time", "text")
    events = streams.stream_events(words.normalized_tokens(timed, COMMON), 5, eta, block=BLOCK)

    def start():
        # The counts of a week: on the executors' disks, not in their heaps.
        with stream_replay.keyed_state(spark, row_counts=False):
            return write(events, f"{folder}/out", f"{folder}/checkpoint")

    streams.run_to_the_end(spark, start, closing, at_once=True)
    return f"{folder}/out"


def stream_event_words(spark, sf_dir):
    out = _run_stream(spark, sf_dir, -2, streams.write_event_words)
    # The text source knows strings only, also for folders.
    lines = spark.read.schema("value STRING, day STRING, batch_idx STRING").text(out)
    return lines.select(
        F.col("value").alias("word"), F.col("day").cast("date"), F.col("batch_idx").cast("bigint")
    )


def stream_events_poisson(spark, sf_dir):
    out = _run_stream(spark, sf_dir, 2, lambda e, path, at: streams.write_events(_rounded(e), path, at))
    schema = "word STRING, n_now BIGINT, avg_past DOUBLE, margin DOUBLE, day DATE, batch_idx BIGINT"
    return spark.read.schema(schema).parquet(out).drop("day")


def stream_post_sums(spark, sf_dir):
    """Posts of a stream scored by a model that was saved and read again."""
    folder = scratch_folder(spark, "topics")
    _lda(spark, sf_dir).save(f"{folder}/saved")
    model = topics.load_topics(f"{folder}/saved")
    arriving = sources.posts_stream_from_documents(spark, sf_dir)
    scored = model.score(topic_plans.words_between(arriving, *WEEK, COMMON))
    running = (
        scored.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start(f"{folder}/out")
    )
    running.awaitTermination()
    return _mixture_sums(spark.read.schema(scored.schema).parquet(f"{folder}/out"))


def _run_replay(spark, arriving, delay, day, rows_of):
    """Run a stream of posts with a `day` to its end; `rows_of` makes its rows."""
    folder = scratch_folder(spark, "replay")
    closing = f"{folder}/closing"
    timed = streams.with_event_time(streams.with_closing(arriving, closing), delay)
    rows = rows_of(timed.withColumn("day", day.cast("string")).select("day", "event_time", "text"), folder)
    write = lambda: stream_replay.write_batches(rows, f"{folder}/out", f"{folder}/checkpoint")
    streams.run_to_the_end(spark, write, closing, at_once=True)
    found = spark.read.schema(rows.schema).parquet(f"{folder}/out")
    return found.withColumn("batch_idx", F.col("batch_idx").cast("int"))


def stream_replay_batches(spark, sf_dir):
    """Chains of anchored batches on a stream, one per month."""
    arriving = sources.posts_stream_from_events(spark, sf_dir)
    found = _run_replay(
        spark, arriving, "40 days", F.trunc("ts", "month"), lambda timed, _: stream_replay.stream_replay_batches(timed)
    )
    return found.withColumn("day", F.col("day").cast("date"))


def _stream_history(align, eta=None):
    """The last day as a stream against the stored counts of the days before."""

    def query(spark, sf_dir):
        past = batches.with_day(_posts(spark, sf_dir)).where(~_is_last_day())
        arriving = sources.posts_stream_from_documents(spark, sf_dir)
        arriving = arriving.where(F.to_date("ts") == F.lit(LAST_DAY).cast("date"))

        def rows_of(timed, folder):
            n_days = event_plans.write_history_baseline(past, COMMON, f"{folder}/baseline", align)
            baseline = stream_history.read_baseline(spark, f"{folder}/baseline")
            if eta is None:
                return event_plans.stream_history_counts(timed, baseline, n_days, COMMON, align).drop("event_hour")
            events = event_plans.stream_history_events(timed, baseline, n_days, COMMON, eta, align)
            return events if eta < 0 else _rounded(events)

        return _run_replay(spark, arriving, "2 days", F.to_date("ts"), rows_of)

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Seasonal words. At this scale no word passes the default minimum count."""
    return seasonal_words_min1(spark, "/root/testdata/sf0.001")


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return {}
    return llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def _llm_sql() -> dict[str, str]:
    if llm_queries is None:
        return {}
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm_queries.oracle_sql() | own


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "posts": posts,
        "event_time_parse": event_time_parse,
        "posts_from_json": posts_from_json,
        "stopwords": stopwords,
        "history_days": history_days,
        "time_range_filter": time_range_filter,
        "tokens_basic": tokens_basic,
        "tokens_live": tokens_live,
        "normalized_tokens": normalized_tokens,
        "word_counts": word_counts,
        "period_totals": period_totals,
        "word_frequency": word_frequency,
        "week_word_frequency": week_word_frequency,
        "top_words": top_words,
        "word_history": word_history,
        "word_history_by_mean": word_history_by_mean,
        "word_deviation": word_deviation,
        "mean_deviation": mean_deviation,
        "seasonal_words": seasonal_words,
        "seasonal_words_min1": seasonal_words_min1,
        "seasonal_word_list": seasonal_word_list,
        "seasonal_rows_text": seasonal_rows_text,
        "fixed_batch_counts": fixed_batch_counts,
        "replay_batches": replay_batches,
        "replay_batches_events": replay_batches_events,
        "replay_batches_by_month": replay_batches_by_month,
        "windowed_counts": windowed_counts,
        "current_vs_past": current_vs_past,
        "events_root_rule": events_root_rule,
        "events_poisson_rule": events_poisson_rule,
        "replay_events_root": replay_events_root,
        "replay_events_poisson": replay_events_poisson,
        "live_events_poisson": live_events_poisson,
        "poisson_ci": poisson_interval,
        "history_baseline": history_baseline,
        "current_vs_history": current_vs_history,
        "current_vs_history_by_hour": current_vs_history_by_hour,
        "events_vs_history_root": _events_vs_history(-5),
        "events_vs_history_root_eta2": _events_vs_history(-2),
        "events_vs_history_poisson": _events_vs_history(5),
        "events_vs_history_poisson_eta2": _events_vs_history(2),
        "history_events_union": history_events_union,
        "stopword_arrays": stopword_arrays,
        "vocabulary": vocabulary,
        "bag_of_words": bag_of_words,
        "lda_topics": lda_topics,
        "lda_topic_terms": lda_topic_terms,
        "lda_post_topics": lda_post_topics,
        "lda_post_sums": lda_post_sums,
        "lda_quality": lda_quality,
        "stream_post_sums": stream_post_sums,
        "stream_event_words": stream_event_words,
        "stream_events_poisson": stream_events_poisson,
        "stream_replay_batches": stream_replay_batches,
        "stream_current_vs_history": _stream_history("ordinal"),
        "stream_events_vs_history_root": _stream_history("hour", -2),
        "stream_events_vs_history_poisson": _stream_history("hour", 2),
        **_llm_queries(),
    }


def oracle_sql() -> dict[str, str]:
    return oracle_queries.oracle_sql() | _llm_sql()
