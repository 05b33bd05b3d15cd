"""Bursts: words counted far more often in a batch than its baseline lets expect.

Everything after `batch_word_counts` works on counts, at most one row per word and batch,
so a word that makes up a third of all text is no more work than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordtide.functions import patterns as P
from wordtide.functions.poisson import poisson_ci, poisson_ci_floor


def batch_word_counts(tokens: DataFrame, stream: Sequence[str] = ()) -> DataFrame:
    """`*stream, batch_idx, word, n_now`; `stream` names the columns that tell streams apart."""
    return tokens.groupBy(*stream, "batch_idx", "word").agg(F.count("*").alias("n_now"))


def _check_window(n: int) -> None:
    if n < 2:
        raise ValueError("a window needs at least two batches: the current and a past one")


def _batches_back(stream: Sequence[str], first: int, last: int):
    by_word = Window.partitionBy(*stream, "word").orderBy("batch_idx")
    return by_word.rangeBetween(first, last)


def windowed_counts(counts: DataFrame, n: int, stream: Sequence[str] = ()) -> DataFrame:
    """Add `n_window`, the count over the current and the n-1 batches before.

    Rows exist for batches that hold the word; a window partition has one row per batch.
    """
    _check_window(n)
    return counts.withColumn("n_window", F.sum("n_now").over(_batches_back(stream, 1 - n, 0)))


def current_vs_past(
    counts: DataFrame, n: int, first_batch: Column | int, stream: Sequence[str] = ()
) -> DataFrame:
    """Add `n_past`, `avg_past` over the n-1 batches before, and `is_warmup`.

    The divisor is n-1 even for the first batches; `is_warmup` marks those.
    """
    _check_window(n)
    past = F.coalesce(F.sum("n_now").over(_batches_back(stream, 1 - n, -1)), F.lit(0))
    first = first_batch if isinstance(first_batch, Column) else F.lit(first_batch)
    return counts.withColumn("n_past", past).select(
        "*",
        (F.col("n_past") / (n - 1)).alias("avg_past"),
        (F.col("batch_idx") < first + (n - 1)).alias("is_warmup"),
    )


def history_days(posts: DataFrame) -> DataFrame:
    """`day, n_posts` of a history; posts whose time did not parse do not count."""
    return posts.groupBy("day").agg(F.count("ts").alias("n_posts"))


def history_baseline(tokens: DataFrame, n_days: Column | int) -> DataFrame:
    """`batch_idx, word, n_past, avg_past`: count over all days of a batch, per day.

    A day without the batch still counts in the divisor.
    """
    return (
        tokens.groupBy("batch_idx", "word")
        .agg(F.count("*").alias("n_past"))
        .withColumn("avg_past", F.col("n_past") / n_days)
    )


def current_vs_history(tokens: DataFrame, is_current: Column, n_days: Column | int) -> DataFrame:
    """Counts of the current day beside the average of the others, batch by batch.

    Words without history in a batch drop out. Current and past are conditional counts
    of one aggregation, so there is no join and texts are read once.
    """
    return (
        tokens.groupBy("batch_idx", "word")
        .agg(F.count_if(is_current).alias("n_now"), F.count_if(~is_current).alias("n_past"))
        .where("n_now > 0 AND n_past > 0")
        .withColumn("avg_past", F.col("n_past") / n_days)
    )


def least_margin(eta: float, samples: int, alpha: float = P.CONFIDENCE, textbook: bool = False) -> Column:
    """What the count of any event of `with_margin` is above: its margin, or a bound of it, without a past."""
    none = F.lit(0.0)
    if eta < 0:
        return F.abs(F.lit(eta)) * F.sqrt(none + 10) + 20
    return eta * poisson_ci_floor(none, samples, alpha, textbook)


def with_margin(
    counts: DataFrame,
    eta: float,
    samples: int,
    alpha: float = P.CONFIDENCE,
    textbook: bool = False,
) -> DataFrame:
    """Rows with `n_now > avg_past + margin`, and that `margin`.

    Negative `eta`: the root rule, `|eta| * sqrt(avg_past + 10) + 20`. Otherwise `eta`
    times the width of the Poisson interval of `avg_past` from `samples` samples. The
    width needs Python, so a JVM-side lower bound of it first removes the rows that
    cannot pass; what is left is about the size of the result.
    """
    excess = F.col("n_now") - F.col("avg_past")
    if eta < 0:
        margin = F.abs(F.lit(eta)) * F.sqrt(F.col("avg_past") + 10) + 20
    else:
        total = F.col("avg_past") * samples
        floor = eta * poisson_ci_floor(total, samples, alpha, textbook)
        counts = counts.where(excess > floor)
        margin = eta * poisson_ci(total, samples, alpha, textbook, pinned=True)
    marked = counts.withColumn("margin", margin)
    return marked.where(F.col("n_now") > F.col("margin") + F.col("avg_past"))


def events_vs_past(
    counts: DataFrame,
    n: int,
    eta: float,
    stream: Sequence[str] = (),
    alpha: float = P.CONFIDENCE,
    textbook: bool = False,
    first_batch: Column | int | None = None,
) -> DataFrame:
    """`*stream, batch_idx, word, n_now, avg_past, margin` of bursts against recent batches.

    With `first_batch`, the number of the first batch, also `is_warmup`, which marks the n-1
    first ones, whose past is not whole.
    """
    joined = current_vs_past(counts, n, 0 if first_batch is None else first_batch, stream)
    events = with_margin(joined, eta, n - 1, alpha, textbook)
    mark = [] if first_batch is None else ["is_warmup"]
    return events.select(*stream, "batch_idx", "word", "n_now", "avg_past", "margin", *mark)


def history_margins(
    joined: DataFrame,
    n_days: int,
    eta: float,
    alpha: float = P.CONFIDENCE,
    textbook: bool = False,
) -> DataFrame:
    """`batch_idx, word, n_now, avg_past, margin` of bursts in rows of `current_vs_history`."""
    events = with_margin(joined, eta, n_days, alpha, textbook)
    return events.select("batch_idx", "word", "n_now", "avg_past", "margin")


def events_vs_history(
    tokens: DataFrame,
    is_current: Column,
    n_days: int,
    eta: float,
    alpha: float = P.CONFIDENCE,
    textbook: bool = False,
) -> DataFrame:
    """Bursts of the current day against the average of the others."""
    joined = current_vs_history(tokens, is_current, n_days)
    return history_margins(joined, n_days, eta, alpha, textbook)
