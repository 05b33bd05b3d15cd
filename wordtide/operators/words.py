"""One row per word of a post."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordtide.functions import text as T
from wordtide.sources.stopwords import StopWords, without_stopwords

# `explode` takes the split itself, not a column of it: for a column Catalyst infers a
# size filter below the Generate and so splits each text twice.


def _others(posts: DataFrame) -> list[str]:
    return [c for c in posts.columns if c != "text"]


def basic_tokens(posts: DataFrame) -> DataFrame:
    """Words of the basic tokeniser without empty ones; `text` gives way to `word`."""
    words = F.explode(T.basic_words(F.col("text"))).alias("word")
    return posts.select(*_others(posts), words).where("word <> ''")


def normalized_tokens(
    posts: DataFrame, stop: StopWords | None = None, strip_fragments: bool = True
) -> DataFrame:
    """Words for event detection: no links, fragments, empty words, numbers or stop words.

    To count them without a stop list given as a DataFrame, drop those words from the
    counts instead: a join of raw words meets the commonest word in one place.
    """
    clean = T.with_clean_text(posts, strip_fragments)
    words = F.explode(T.event_words(F.col("text"))).alias("word")
    tokens = clean.select(*_others(posts), words).where("word <> ''")
    return without_stopwords(tokens, stop).where(~T.is_number(F.col("word")))


def live_tokens(posts: DataFrame) -> DataFrame:
    """Raw words of the live path: nothing is lowered or dropped."""
    return posts.select(*_others(posts), F.explode(T.live_words(F.col("text"))).alias("word"))
