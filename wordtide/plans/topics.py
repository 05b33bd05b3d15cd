"""Topics of the posts between two times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordtide.functions import times
from wordtide.operators.topics import TopicModel, fit_topics, word_arrays
from wordtide.sinks.text import write_topics
from wordtide.sources.posts import posts_json
from wordtide.sources.stopwords import StopWords, stopwords


def words_between(
    posts: DataFrame, low: str, high: str, stop: StopWords, drop_empty: bool = False
) -> DataFrame:
    inside = posts.where(times.strictly_between(F.col("ts"), low, high))
    return word_arrays(inside, stop, drop_empty)


def topics_between(
    posts: DataFrame, low: str, high: str, stop: StopWords, drop_empty: bool = False, **options
) -> TopicModel:
    """A model of the posts strictly between two times; its `fit_seconds` say how long the fit took."""
    return fit_topics(words_between(posts, low, high, stop, drop_empty), **options)


def write_topics_json(
    spark: SparkSession,
    path: str,
    stop_path: str,
    low: str,
    high: str,
    out: str,
    zone: str = "UTC",
    drop_empty: bool = False,
    **options,
) -> float:
    """Write a line of terms per topic of the posts in `path`; returns the seconds of the fit."""
    posts = posts_json(spark, path, zone)
    with topics_between(posts, low, high, stopwords(spark, stop_path), drop_empty, **options) as model:
        write_topics(model.topics(), out)
        return model.fit_seconds
