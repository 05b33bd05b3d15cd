"""Seasonal words of a folder of daily posts, written as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wordtide.functions import patterns as P
from wordtide.operators.seasonality import seasonal_words
from wordtide.sinks.text import write_seasonal
from wordtide.sources.posts import posts_json
from wordtide.sources.stopwords import stopwords
from wordtide.sources.store import read_posts


def seasonal_words_of_days(
    spark: SparkSession,
    root: str,
    stop_path: str,
    days: Sequence[str],
    zone: str = "UTC",
    min_count: int = P.MIN_COUNT,
    threshold: float = P.SEASONAL_THRESHOLD,
) -> DataFrame:
    """Seasonal words of the day folders `root/<day>`, read in one scan."""
    posts = posts_json(spark, [f"{root.rstrip('/')}/{day}" for day in days], zone)
    return seasonal_words(posts, stopwords(spark, stop_path), days, min_count, threshold)


def seasonal_words_of_store(
    spark: SparkSession,
    path: str,
    stop_path: str,
    days: Sequence[str],
    min_count: int = P.MIN_COUNT,
    threshold: float = P.SEASONAL_THRESHOLD,
) -> DataFrame:
    """The same of posts stored by day (`sources.store`): the totals read the time column alone."""
    posts = read_posts(spark, path, days)
    return seasonal_words(posts, stopwords(spark, stop_path), days, min_count, threshold)


def write_seasonal_words(
    spark: SparkSession,
    root: str,
    stop_path: str,
    days: Sequence[str],
    scores_path: str,
    list_path: str,
    **options,
) -> None:
    scores = seasonal_words_of_days(spark, root, stop_path, days, **options)
    write_seasonal(scores, scores_path, list_path)
