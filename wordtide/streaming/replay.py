"""Replay batches on a stream: chains of batches anchored at posts, one for each file or day.

A chain needs its posts in order. So posts are counted by second first; a second comes out
when the watermark has passed it, and later seconds come out later. What reaches the chain
of a day is therefore in order, and at most one row per second, without texts; its keyed state
is the open batch: number, anchor and posts so far. A timer closes it when the watermark
has passed its last second. Posts find their batch by a join of two streams, by day and
aligned slot, so texts are spread over tasks whatever the length of a day.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from wordtide.functions import patterns as P, times

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROW_COUNTS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Aligned slots of a batch, by which posts find it.
SLOTS = 60

OPEN = "batch_idx BIGINT, anchor_sec BIGINT, n_posts BIGINT"
CLOSED = "day STRING, batch_idx BIGINT, anchor_sec BIGINT, n_posts BIGINT"
OPENED = "day STRING, batch_idx BIGINT, anchor_time TIMESTAMP"


@contextmanager
def keyed_state(spark: SparkSession, row_counts: bool | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which keyed state with timers needs.

    Without `row_counts` a query's progress does not tell how many rows its state has, and a
    write need not look for the row before it.
    """
    settings = {PROVIDER: ROCKSDB} | ({} if row_counts is None else {ROW_COUNTS: str(row_counts).lower()})
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class _Chain(StatefulProcessor):
    """The open batch of a day. Seconds arrive in order; one more than `seconds` after the anchor opens the next."""

    def __init__(self, seconds: int, report_opening: bool):
        self.seconds, self.report_opening = seconds, report_opening

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def _rows(self, day: str, batches: list[tuple[int, int, int]]) -> Iterator[pd.DataFrame]:
        if not batches:
            return
        number, anchor, n = zip(*batches, strict=True)
        if self.report_opening:
            moments = pd.to_datetime(pd.Series(anchor), unit="s")
            yield pd.DataFrame({"day": day, "batch_idx": number, "anchor_time": moments})
        else:
            yield pd.DataFrame({"day": day, "batch_idx": number, "anchor_sec": anchor, "n_posts": n})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).groupby("second")["n"].sum().sort_index()
        number, anchor, n = self.open.get() if self.open.exists() else (-1, None, 0)
        opened, closed, before = [], [], anchor
        for second, count in zip(arrived.index.tolist(), arrived.tolist(), strict=True):
            if anchor is None or second > anchor + self.seconds:
                if anchor is not None and n:
                    closed.append((number, anchor, n))
                number, anchor, n = number + 1, second, 0
                opened.append((number, anchor, 0))
            n += count
        self.open.update((number, anchor, n))
        if anchor != before:
            if before is not None:
                self.handle.deleteTimer(self._last_moment(before))
            self.handle.registerTimer(self._last_moment(anchor))
        yield from self._rows(key[0], opened if self.report_opening else closed)

    def _last_moment(self, anchor: int) -> int:
        return (anchor + self.seconds + 1) * 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.open.exists():
            return
        number, anchor, n = self.open.get()
        if expiredTimerInfo.getExpiryTimeInMs() != self._last_moment(anchor):
            return
        # The number and the anchor stay: a later post of the day opens the next batch.
        self.open.update((number, anchor, 0))
        if n and not self.report_opening:
            yield from self._rows(key[0], [(number, anchor, n)])

    def close(self) -> None:
        pass


def _chain(posts: DataFrame, seconds: int, report_opening: bool) -> DataFrame:
    """`posts`: `day` (text), `event_time` with its watermark."""
    counted = (
        posts.groupBy("day", F.window("event_time", "1 second").alias("moment"))
        .agg(F.count("*").alias("n"))
        .select("day", F.window_time("moment").alias("moment"), F.unix_seconds("moment.start").alias("second"), "n")
    )
    return counted.groupBy("day").transformWithStateInPandas(
        statefulProcessor=_Chain(seconds, report_opening),
        outputStructType=OPENED if report_opening else CLOSED,
        outputMode="append",
        timeMode="eventtime",
        eventTimeColumnName="anchor_time" if report_opening else "",
    )


def stream_replay_batches(posts: DataFrame, seconds: int = P.BATCH_SECONDS) -> DataFrame:
    """`day, batch_idx, anchor_sec, n_posts` of closed batches of `day, event_time` with a watermark.

    Equals `operators.batches.replay_batches` on what is not later than the watermark, in
    whatever order files and posts arrive. Posts without a day are a chain of their own.
    """
    return _chain(posts.select("day", "event_time"), seconds, report_opening=False)


def write_batches(batches: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append closed batches to a Parquet folder; without a `trigger` take what has arrived and end."""
    with keyed_state(batches.sparkSession):
        writer = batches.writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", path).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def with_stream_replay_batch(posts: DataFrame, seconds: int = P.BATCH_SECONDS) -> DataFrame:
    """`posts` (`day`, `event_time` with a watermark, others) with `batch_idx`, `anchor_time`.

    A batch holds the posts from its anchor to `seconds` later. Those lie in some `SLOTS` aligned
    slots: posts and opened batches meet by day and slot, so a busy hour is spread over that
    many keys, and they wait for each other no longer than the watermark takes.
    """
    span = F.expr(f"INTERVAL {seconds} SECONDS")
    opened = _chain(posts.select("day", "event_time"), seconds, report_opening=True)
    length = max(1, seconds // SLOTS)
    first, last = (F.floor((F.unix_seconds("anchor_time") + s) / length).cast("bigint") for s in (0, seconds))
    slots = opened.select(
        F.col("day").alias("of_day"), "batch_idx", "anchor_time", F.explode(F.sequence(first, last)).alias("of_slot")
    )
    slot = F.floor(F.unix_seconds("event_time") / length).cast("bigint")
    moment = F.timestamp_seconds(F.unix_seconds("event_time"))
    inside = (moment >= F.col("anchor_time")) & (moment <= F.col("anchor_time") + span)
    # What the watermark can tell apart; fractions of a second belong to their second.
    ends = F.col("anchor_time") + F.expr(f"INTERVAL {seconds + 1} SECONDS")
    timely = (F.col("event_time") >= F.col("anchor_time")) & (F.col("event_time") < ends)
    same = F.col("day").eqNullSafe(F.col("of_day")) & (F.col("slot") == F.col("of_slot"))
    placed = posts.withColumn("slot", slot).join(slots, same & inside & timely)
    return placed.drop("slot", "of_day", "of_slot")
