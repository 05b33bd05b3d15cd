"""Tokenisers as column expressions and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordtide.functions import patterns as P


def basic_words(text: Column) -> Column:
    """Lower-cased words; empty ones, trailing ones included, are kept."""
    return F.split(F.lower(text), P.BASIC_SEPARATORS)


def event_words(clean: Column) -> Column:
    """Words of a text that went through `with_clean_text`."""
    return F.split(clean, P.EVENT_SEPARATORS)


def live_words(text: Column) -> Column:
    """Raw words split at single spaces: case, punctuation and inner empty words stay.

    Trailing empty words go, so a text of spaces has no word, but an empty text has one.
    """
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    blank = (F.rtrim(flat) == "") & (text != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(F.rtrim(flat), " "))


def with_clean_text(posts: DataFrame, strip_fragments: bool = True) -> DataFrame:
    """Replace `text` by its lower-cased form without links, escapes and link fragments.

    One projection per step: a step reads the one before more than once, and Catalyst
    keeps such projections apart instead of evaluating the earlier step again. The
    link pattern backtracks over every run of host characters, so only texts holding
    a dot and two letters, which each match needs, go through it.
    """
    out = posts.withColumn("text", F.lower("text"))
    out = out.withColumn(
        "text",
        F.when(
            F.col("text").rlike(r"\.[a-z]{2}"),
            F.regexp_replace("text", f"{P.URL}|{P.SHORT_LINK}", ""),
        ).otherwise(F.col("text")),
    )
    out = out.withColumn(
        "text",
        F.when(
            F.contains(F.col("text"), F.lit("\\u")),
            F.regexp_replace("text", P.UNICODE_ESCAPE, ""),
        ).otherwise(F.col("text")),
    )
    if strip_fragments:
        out = out.withColumn("text", F.regexp_replace("text", P.FRAGMENTS, ""))
    return out


def is_number(word: Column) -> Column:
    """The two comparisons, true of words that start like a number, spare the rest the regex."""
    starts = (word >= "-") & (word < ":")
    return starts & word.rlike(rf"^(?:{P.NUMBER})\z")
