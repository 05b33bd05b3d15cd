"""Word counts and relative frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wordtide.functions import patterns as P, times
from wordtide.operators.small import join_lookup
from wordtide.operators.words import basic_tokens
from wordtide.sources.stopwords import StopWords, without_stopwords


def of_days(posts: DataFrame, days: Sequence[str] | None) -> DataFrame:
    """Posts of the listed days, by a range on the raw time that a source can push down."""
    if days is None:
        return posts
    first, last = min(days), max(days)
    ts = F.col("ts")
    return posts.where(
        (ts >= F.expr(f"timestamp_ntz'{first}'"))
        & (ts < F.expr(f"timestamp_ntz'{last}' + INTERVAL 1 DAY"))
        & F.to_date(ts).isin([F.lit(d).cast("date") for d in days])
    )


def with_period(posts: DataFrame) -> DataFrame:
    """Add `day` and `quarter`, dropping posts at the seconds that no quarter contains."""
    ts = F.col("ts")
    return posts.where(times.inside_quarter(ts)).select(
        F.to_date(ts).alias("day"), times.quarter_of_day(ts).alias("quarter"), "text"
    )


def period_word_counts(posts: DataFrame, min_count: int = P.MIN_COUNT) -> DataFrame:
    """`day, quarter, word, count` of words above `min_count` in their quarter."""
    words = basic_tokens(with_period(posts))
    counts = words.groupBy("day", "quarter", "word").agg(F.count("*").alias("count"))
    return counts.where(F.col("count") > min_count)


def period_totals(posts: DataFrame) -> DataFrame:
    """`day, quarter, n_posts`: at most four rows per calendar day. Reads no text."""
    return with_period(posts).groupBy("day", "quarter").agg(F.count("*").alias("n_posts"))


def period_word_frequency(
    posts: DataFrame,
    stop: StopWords | None,
    min_count: int = P.MIN_COUNT,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """`day, quarter, word, freq`: counts per post of the quarter, to four digits.

    Only the listed days if given. The totals are four rows per day. A shuffle on (day,
    quarter) would send all words of a quarter to one task, so they are broadcast: for
    listed days as that bounds them, otherwise by `join_lookup`.
    """
    posts = of_days(posts, days)
    counts = without_stopwords(period_word_counts(posts, min_count), stop)
    totals, keys = period_totals(posts), ["day", "quarter"]
    if days is None:
        joined = join_lookup(counts, totals, keys, F.col("word"))
    else:
        joined = counts.join(F.broadcast(totals), keys)
    return joined.select(
        "day", "quarter", "word", F.round(F.col("count") / F.col("n_posts"), 4).alias("freq")
    )


def top_words(
    counts: DataFrame, top_x: int | None = None, by: str = "count", then: str | None = None
) -> DataFrame:
    """Highest first, ties by word and then by `then`; the first `top_x` if given."""
    ordered = counts.orderBy(F.desc(by), "word", *([then] if then else []))
    return ordered if top_x is None else ordered.limit(top_x)


def count_words(
    posts: DataFrame,
    low: str,
    high: str,
    stop: StopWords | None,
    top_x: int | None = None,
    min_count: int = P.MIN_COUNT,
) -> tuple[DataFrame, DataFrame]:
    """Counts and frequencies of the words strictly between two times.

    Counts (`word, count`) still hold stop words; frequencies (`word, freq`) do not.
    """
    inside = posts.where(times.strictly_between(F.col("ts"), low, high))
    counts = (
        basic_tokens(inside.select("text"))
        .groupBy("word")
        .agg(F.count("*").alias("count"))
        .where(F.col("count") > min_count)
    )
    total = inside.agg(F.count("*")).scalar()
    frequency = without_stopwords(counts, stop).select(
        "word", F.round(F.col("count") / total, 4).alias("freq")
    )
    if top_x is not None:
        counts = top_words(counts, top_x)
        frequency = top_words(frequency, top_x, by="freq")
    return counts, frequency
