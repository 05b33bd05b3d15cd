"""Text and table sinks. Each task writes its own file; nothing is gathered into one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordtide.operators.seasonality import PERIODS


def seasonal_rows(deviation: DataFrame) -> DataFrame:
    """`line`: `[word,morning,afternoon,evening,night]`."""
    fields = [F.col("word"), *[F.col(f"d_{p}").cast("string") for p in PERIODS]]
    shown = [F.coalesce(f, F.lit("null")) for f in fields]
    return deviation.select(F.concat(F.lit("["), F.concat_ws(",", *shown), F.lit("]")).alias("line"))


def seasonal_word_list(deviation: DataFrame) -> DataFrame:
    return deviation.select("word").distinct()


def write_seasonal(deviation: DataFrame, scores_path: str, list_path: str) -> None:
    """Write score lines and the word list; both fail if their folder exists.

    The scores are persisted between the two, so the analysis runs once.
    """
    scores = deviation.persist()
    try:
        seasonal_rows(scores).write.text(scores_path)
        seasonal_word_list(scores).write.text(list_path)
    finally:
        scores.unpersist()


def write_topics(topics: DataFrame, path: str) -> None:
    """One line of comma-joined terms per topic."""
    topics.select("terms").write.text(path)


def write_event_words(events: DataFrame, path: str) -> None:
    """The words of the events as text, one folder per batch, and per day where there is one."""
    keys = [c for c in ("day", "batch_idx") if c in events.columns]
    events.select(*keys, "word").write.partitionBy(*keys).text(path)
