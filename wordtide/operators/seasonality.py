"""Seasonal words: over-represented in one quarter of the day, averaged over days."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from wordtide.functions import patterns as P
from wordtide.operators.frequency import period_word_frequency
from wordtide.sources.stopwords import StopWords

# In output order.
PERIODS = {
    "morning": P.MORNING,
    "afternoon": P.AFTERNOON,
    "evening": P.EVENING,
    "night": P.NIGHT,
}


def word_history(
    posts: DataFrame,
    stop: StopWords | None,
    days: Sequence[str] | None = None,
    min_count: int = P.MIN_COUNT,
) -> DataFrame:
    """Frequencies of a word in the quarters of a day, and their mean; one row per day.

    A word must exceed `min_count` in all four quarters. The quarters come from one scan
    and are turned into columns, so no word join is needed. What is left after the
    minimum count is partitioned by word once: that serves the grouping by day and word
    here and the one by word over the days.
    """
    frequency = period_word_frequency(posts, stop, min_count, days).repartition("word")

    def of(period: str):
        quarter = F.col("quarter") == PERIODS[period]
        return F.max(F.when(quarter, F.col("freq"))).alias(f"f_{period}")

    frequencies = (
        frequency.groupBy("day", "word")
        .agg(F.count("*").alias("n_quarters"), *map(of, PERIODS))
        .where(F.col("n_quarters") == len(PERIODS))
        .drop("n_quarters")
    )
    # The order of the sum decides ties of later roundings.
    mean = (F.col("f_night") + F.col("f_morning") + F.col("f_afternoon") + F.col("f_evening")) / 4
    return frequencies.withColumn("mean", mean)


def word_deviation(history: DataFrame) -> DataFrame:
    """Deviation of each quarter from the mean of the day, in whole percent.

    Null where the mean is zero.
    """
    share = {p: F.try_divide(F.col(f"f_{p}") - F.col("mean"), F.col("mean")) for p in PERIODS}
    return history.select(
        "day", "word", *[F.round(share[p] * 100).alias(f"d_{p}") for p in PERIODS]
    )


def mean_deviation(deviation: DataFrame, n_days: int) -> DataFrame:
    """Mean over `n_days` days of words present on all of them; null if a day's value is."""
    def mean(column: str):
        return F.when(F.count(column) == n_days, F.sum(column) / n_days).alias(column)

    return (
        deviation.groupBy("word")
        .agg(F.count("*").alias("n_days"), *[mean(f"d_{p}") for p in PERIODS])
        .where(F.col("n_days") == n_days)
        .drop("n_days")
    )


def above_threshold(deviation: DataFrame, threshold: float = P.SEASONAL_THRESHOLD) -> DataFrame:
    """Words for which some quarter is above the threshold."""
    return deviation.where(reduce(or_, [F.col(f"d_{p}") > threshold for p in PERIODS]))


def seasonal_words(
    posts: DataFrame,
    stop: StopWords | None,
    days: Sequence[str],
    min_count: int = P.MIN_COUNT,
    threshold: float = P.SEASONAL_THRESHOLD,
) -> DataFrame:
    history = word_history(posts, stop, days, min_count)
    return above_threshold(mean_deviation(word_deviation(history), len(set(days))), threshold)
