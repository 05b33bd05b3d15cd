"""Event detection over files of posts: against recent batches, or against other days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordtide.operators import bursts
from wordtide.operators.batches import with_day, with_fixed_batch, with_replay_batch
from wordtide.operators.words import live_tokens, normalized_tokens
from wordtide.sinks.text import write_event_words
from wordtide.sources.posts import day_name, history_json, history_listing, posts_json
from wordtide.sources.stopwords import StopWords, without_stopwords
from wordtide.streaming import history as stream_history
from wordtide.streaming.bursts import stream_events, with_event_time

KEPT = ["day", "batch_idx", "text"]


def file_events(posts: DataFrame, stop: StopWords, n: int = 2, eta: float = 3) -> DataFrame:
    """Bursts against the n-1 replay batches before, day by day, with `is_warmup`."""
    tokens = normalized_tokens(with_replay_batch(posts).select(*KEPT))
    counts = without_stopwords(bursts.batch_word_counts(tokens, ["day"]), stop)
    return bursts.events_vs_past(counts, n, eta, ["day"], first_batch=0)


def live_events(posts: DataFrame, n: int = 5, eta: float = 2, seconds: int = 120) -> DataFrame:
    """Bursts of raw words against the n-1 fixed batches before, on stored posts, with `is_warmup`."""
    placed = with_fixed_batch(posts, seconds)
    first = placed.agg(F.min("batch_idx")).scalar()
    counts = bursts.batch_word_counts(live_tokens(placed.select("batch_idx", "text")))
    return bursts.events_vs_past(counts, n, eta, first_batch=first)


def live_stream_events(
    posts: DataFrame, delay: str, n: int = 5, eta: float = 2, seconds: int = 120, first_batch: int | None = None
) -> DataFrame:
    """`live_events` on a stream of posts, of which none is later than `delay` after a newer one."""
    timed = with_event_time(posts, delay).select("event_time", "text")
    return stream_events(live_tokens(timed), n, eta, seconds, first_batch=first_batch)


def aligned_batches(posts: DataFrame, align: str = "ordinal") -> DataFrame:
    """Posts with `day` and a `batch_idx` that compares days.

    `ordinal` numbers each day's replay batches, so days with gaps drift apart; `hour`
    takes the hour of the day.
    """
    if align == "ordinal":
        return with_replay_batch(posts).select(*KEPT)
    if align != "hour":
        raise ValueError(f"align is 'ordinal' or 'hour', not {align!r}")
    return with_day(posts).select("day", F.hour("ts").alias("batch_idx"), "text")


def history_events(
    current: DataFrame,
    history: DataFrame,
    stop: StopWords,
    eta: float = 5,
    n_days: int | None = None,
    align: str = "ordinal",
) -> DataFrame:
    """Bursts of `current` against the same batch of the days in `history`.

    `n_days` is the number of days in the history; if not given, a count of its distinct
    days reads the times only.
    """
    if n_days is None:
        n_days = with_day(history).select("day").distinct().count()
    # Which day a post is from only tells the streams apart here.
    sides = [
        aligned_batches(posts, align).select("batch_idx", "text", F.lit(flag).alias("is_current"))
        for posts, flag in ((current, True), (history, False))
    ]
    tokens = normalized_tokens(sides[0].unionByName(sides[1]))
    joined = bursts.current_vs_history(tokens, F.col("is_current"), n_days)
    return bursts.history_margins(without_stopwords(joined, stop), n_days, eta)


def file_events_json(
    spark: SparkSession, path: str, stop: StopWords, n: int = 2, eta: float = 3, zone: str = "UTC"
) -> DataFrame:
    """`file_events` of a file, or a folder of part files, of one day: one chain of batches."""
    return file_events(posts_json(spark, path, zone, day_name(path)), stop, n, eta)


def history_events_json(
    spark: SparkSession,
    path: str,
    history_root: str,
    stop: StopWords,
    eta: float = 5,
    align: str = "ordinal",
    zone: str = "UTC",
    n_days: int | None = None,
) -> DataFrame:
    """`history_events` of one day's file or folder against the days below `history_root`.

    The divisor is the number of day folders, empty ones included, unless `n_days` is given.
    """
    days = len(history_listing(spark, history_root)) if n_days is None else n_days
    if not days:
        raise ValueError(f"{history_root}: no day folder")
    current = posts_json(spark, path, zone, day_name(path))
    return history_events(current, history_json(spark, history_root, zone), stop, eta, days, align)


def write_file_events(spark: SparkSession, path: str, stop: StopWords, out: str, **options) -> None:
    """Words of `file_events_json` as text, a folder per day and batch."""
    write_event_words(file_events_json(spark, path, stop, **options), out)


def write_history_events(
    spark: SparkSession, path: str, history_root: str, stop: StopWords, out: str, **options
) -> None:
    """Words of `history_events_json` as text, a folder per batch."""
    write_event_words(history_events_json(spark, path, history_root, stop, **options), out)


def write_history_baseline(history: DataFrame, stop: StopWords, path: str, align: str = "ordinal") -> int:
    """Store the past counts that `stream_history_events` compares with; the number of days is returned."""
    tokens = normalized_tokens(aligned_batches(history, align).select("batch_idx", "text"))
    stream_history.write_baseline(tokens, path, stop)
    return with_day(history).select("day").distinct().count()


def stream_history_counts(
    posts: DataFrame, baseline: DataFrame, n_days: int, stop: StopWords, align: str = "ordinal"
) -> DataFrame:
    """Counts of a stream's closed batches beside the stored average of other days.

    `posts`: `day`, `event_time` with a watermark, `text`. `align` as in `aligned_batches`.
    """
    if align not in ("ordinal", "hour"):
        raise ValueError(f"align is 'ordinal' or 'hour', not {align!r}")
    placed = stream_history.anchored(posts) if align == "ordinal" else stream_history.hourly(posts)
    tokens = normalized_tokens(placed.select("event_time", "batch_idx", "text"), stop)
    return stream_history.stream_counts_vs_history(tokens, baseline, n_days)


def stream_history_events(
    posts: DataFrame, baseline: DataFrame, n_days: int, stop: StopWords, eta: float = 5, align: str = "ordinal"
) -> DataFrame:
    """`history_events` of a stream against a stored baseline, with the same rules."""
    counts = stream_history_counts(posts, baseline, n_days, stop, align)
    return bursts.history_margins(counts, n_days, eta)
