"""Batches of posts as a `batch_idx` column: clock-aligned ones, and anchored replay ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordtide.functions import patterns as P, times
from wordtide.operators import chains
from wordtide.operators.small import join_lookup


def with_fixed_batch(posts: DataFrame, seconds: int = P.BATCH_SECONDS) -> DataFrame:
    """Add `batch_idx`, the number of the clock-aligned interval since 1970.

    Posts without a time belong to no batch and are dropped.
    """
    index = F.floor(times.epoch_second(F.col("ts")) / seconds).cast("bigint")
    return posts.where("ts IS NOT NULL").withColumn("batch_idx", index)


def with_day(posts: DataFrame) -> DataFrame:
    """Add the calendar `day` unless the source brought a `day` of its own.

    A source of files does: the file or folder that a post is in, whatever the times of the
    posts. Replay batches are one chain per `day`.
    """
    return posts if "day" in posts.columns else posts.withColumn("day", F.to_date("ts"))


def _blocks(posts: DataFrame, seconds: int) -> DataFrame:
    second = times.epoch_second(F.col("ts"))
    return chains.blocks(with_day(posts).select("day", second.alias("second")), seconds)


def _slots(posts: DataFrame, seconds: int) -> DataFrame:
    """`day, slot, late_idx, late_sec, early_sec` for each aligned slot that holds posts."""
    return chains.slots(_blocks(posts, seconds), seconds)[0]


def with_replay_batch(posts: DataFrame, seconds: int = P.BATCH_SECONDS) -> DataFrame:
    """Add `day`, `batch_idx` and `anchor_sec` of the replay batch that holds the post.

    The first post of a day opens batch 0; the first post more than `seconds` after the
    anchor opens the next one, so gaps make no empty batches (`operators.chains`).

    An equi join with one row per day and slot, so posts stay where they are while that
    lookup is small (`join_lookup`). It grows with the hours covered, not with the posts.
    """
    second = times.epoch_second(F.col("ts"))
    late = second >= F.col("late_sec")
    placed = with_day(posts).withColumn("slot", chains.slot_of(second, seconds))
    lookup, n_slots = chains.slots(_blocks(posts, seconds), seconds)
    # Seconds differ enough within a slot to spread its posts, should the lookup be large.
    return (
        join_lookup(placed, lookup, ["day", "slot"], second, count=n_slots)
        .withColumn("batch_idx", F.when(late, F.col("late_idx")).otherwise(F.col("late_idx") - 1))
        .withColumn("anchor_sec", F.when(late, F.col("late_sec")).otherwise(F.col("early_sec")))
        .select("day", *[c for c in posts.columns if c != "day"], "batch_idx", "anchor_sec")
    )


def replay_batches(posts: DataFrame, seconds: int = P.BATCH_SECONDS) -> DataFrame:
    """`day, batch_idx, anchor_sec, n_posts` of the replay batches."""
    return (
        with_replay_batch(posts, seconds)
        .groupBy("day", "batch_idx", "anchor_sec")
        .agg(F.count("*").alias("n_posts"))
    )
