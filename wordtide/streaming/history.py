"""Bursts on a stream against other days: closed counts meet a stored baseline.

The baseline is a table of past counts by batch and word, written once from stored posts.
A stream of posts counts its words by batch; when the watermark closes a batch, its counts
are joined with the baseline by batch and word, as a stream with a static table. Words
without history in a batch drop out, as in the batch form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordtide.functions import patterns as P
from wordtide.sources.stopwords import StopWords, without_stopwords
from wordtide.streaming.replay import with_stream_replay_batch

BASELINE = "batch_idx BIGINT, word STRING, n_past BIGINT"
HOUR = 3_600


def write_baseline(tokens: DataFrame, path: str, stop: StopWords | None = None, mode: str = "errorifexists") -> None:
    """Past counts of `batch_idx, word` of stored posts, sorted by batch and word within files.

    The sort lets a reader skip what a trigger's batches do not need.
    """
    counts = tokens.groupBy("batch_idx", "word").agg(F.count("*").alias("n_past"))
    kept = without_stopwords(counts, stop).select(F.col("batch_idx").cast("bigint"), "word", "n_past")
    kept.repartition("batch_idx", "word").sortWithinPartitions("batch_idx", "word").write.mode(mode).parquet(path)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BASELINE).parquet(path)


def hourly(posts: DataFrame) -> DataFrame:
    """Posts of a stream by hour of the day: `batch_time` (the hour, which closes it) and `batch_idx`."""
    hour = F.floor(F.unix_seconds("event_time") / HOUR).cast("bigint")
    return posts.withColumn("batch_idx", F.pmod(hour, F.lit(24)))


def anchored(posts: DataFrame, seconds: int = P.BATCH_SECONDS) -> DataFrame:
    """Posts of a stream by the number of their day's replay batch."""
    return with_stream_replay_batch(posts, seconds).drop("event_time").withColumnRenamed("anchor_time", "event_time")


def stream_counts_vs_history(tokens: DataFrame, baseline: DataFrame, n_days: int) -> DataFrame:
    """`event_hour, batch_idx, word, n_now, n_past, avg_past` of closed batches.

    `tokens`: `event_time` (of the post, or of its batch) with a watermark, `batch_idx`, `word`.
    An hour is closed when the watermark has passed it; batches of several days stay apart.
    """
    counts = (
        tokens.groupBy(F.window("event_time", f"{HOUR} seconds").alias("hour"), "batch_idx", "word")
        .agg(F.count("*").alias("n_now"))
        .select(F.col("hour.start").alias("event_hour"), "batch_idx", "word", "n_now")
    )
    return counts.join(baseline, ["batch_idx", "word"]).withColumn("avg_past", F.col("n_past") / n_days)

