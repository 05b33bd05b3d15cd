"""Stop words: a list, or a DataFrame `word STRING`."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Union

from pyspark.sql import DataFrame, SparkSession, functions as F

StopWords = Union[Sequence[str], DataFrame]

# The stop list of the registered queries.
COMMON = """
the of and to in is for on with that by as are at
le la de les des un une du et en que qui dans pour est
der die und das den von mit ein eine
el los las del por con una para
""".split()


def stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, kept as it stands."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def stopwords_frame(spark: SparkSession, words: Sequence[str] = COMMON) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, words))).alias("word")).distinct()


def without_stopwords(words: DataFrame, stop: StopWords | None) -> DataFrame:
    """Rows whose `word` is no stop word, by exact match.

    A list becomes a predicate, which Catalyst pushes below an aggregation on `word`. A
    DataFrame becomes an anti join without a hint: Spark broadcasts it if its size is
    below the threshold and shuffles otherwise, so apply it to counts, not to raw words.
    """
    if stop is None:
        return words
    if isinstance(stop, DataFrame):
        return words.join(stop.select("word"), "word", "left_anti").select(*words.columns)
    return words.where(~F.col("word").isin(list(stop)))
