"""Chains of anchored batches over a file of any length, without walking it from end to end.

The first second of a day (a file or folder, whatever dates it spans) is an anchor; the first
one more than `gap` seconds after an anchor is the next. Seconds are cut into blocks of about
a calendar day, which are at most that many numbers each however long the file is. A block
needs one number from those before it: how many of its first seconds the batch that is open
at its begin still holds, its `entry`, 0 to `gap`. It is 0 wherever the block before ended
more than `gap` seconds earlier. Elsewhere a block is a table of `gap` + 1 numbers, from entry to the
entry of the next block, and the tables of neighbours are composed over twice the distance in
each round, until they reach a block whose entry is known. With all entries known the blocks
are walked side by side, and batch numbers are running sums of their anchors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wordtide.scratch import stored

DAY = 86_400


def block_length(gap: int) -> int:
    """Seconds of a block: a day, up to the next multiple of `gap`."""
    return -(-DAY // gap) * gap


def slot_of(second: Column, gap: int) -> Column:
    return F.floor(second / gap).cast("bigint")


def blocks(seconds: DataFrame, gap: int) -> DataFrame:
    """`day, block, seconds, slots` of rows `day, second`: distinct seconds in order, and slots."""
    distinct = seconds.where("second IS NOT NULL").distinct()
    block = F.floor(F.col("second") / block_length(gap)).cast("bigint").alias("block")
    grouped = distinct.groupBy("day", block).agg(F.sort_array(F.collect_list("second")).alias("seconds"))
    slots = F.array_distinct(F.transform("seconds", lambda s: slot_of(s, gap)))
    return stored(grouped.withColumn("slots", slots), "blocks")


def _marked(found: DataFrame, gap: int) -> DataFrame:
    """`day, block, n_slots, linked, run`: whether the block before can reach in, and the run of such blocks."""
    by_day = Window.partitionBy("day").orderBy("block")
    narrow = found.select(
        "day", "block", F.size("slots").alias("n_slots"),
        F.get("seconds", F.lit(0)).alias("first"), F.element_at("seconds", -1).alias("last"),
    )
    reached = (F.lag("block").over(by_day) == F.col("block") - 1) & (
        F.lag("last").over(by_day) + gap >= F.col("first")
    )
    linked = narrow.withColumn("linked", F.coalesce(reached, F.lit(False)))
    run = F.sum(F.when(F.col("linked"), 0).otherwise(1)).over(by_day)
    return linked.select("day", "block", "n_slots", "linked", run.alias("run"))


def jump_table(seconds: np.ndarray, start: int, length: int, gap: int) -> np.ndarray:
    """Entry of the next block for each entry of the one that begins at `start`."""
    n = len(seconds)
    following = np.append(np.searchsorted(seconds, seconds + gap, "right"), n)
    last = np.searchsorted(seconds, start - 1 + np.arange(gap + 1), "right")
    while True:
        further = following[last]
        if (further == n).all():
            break
        last = np.where(further < n, further, last)
    held = np.append(seconds, start - 1 - gap)[last] + gap - (start + length) + 1
    return np.maximum(held, 0).astype(np.int32)


def _jump_tables(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[pa.RecordBatch]:
    length = block_length(gap)
    for batch in batches:
        for i in range(batch.num_rows):
            seconds = batch.column("seconds")[i].values.to_numpy(zero_copy_only=False)
            table = jump_table(seconds, batch.column("block")[i].as_py() * length, length, gap)
            row = batch.slice(i, 1)
            yield pa.RecordBatch.from_arrays(
                [row.column("day"), row.column("block"), pa.array([table], pa.list_(pa.int32()))],
                ["day", "block", "jump"],
            )


def _entries(found: DataFrame, marked: DataFrame, longest: int, gap: int) -> DataFrame:
    """`day, block, entry` of the blocks that are linked to the one before.

    A table leads from the entry of block `origin` to the entry after `block`; it is `known` once
    `origin` is the first block of its run, whose entry is 0.
    """
    kind = found.schema["day"].dataType.simpleString()
    in_runs = marked.where("linked").select("day", "run").distinct()
    of_runs = marked.join(in_runs, ["day", "run"], "left_semi").select("day", "block", "linked")
    tables = found.join(of_runs.select("day", "block"), ["day", "block"], "left_semi").select("day", "block", "seconds")
    jumps = tables.mapInArrow(partial(_jump_tables, gap=gap), f"day {kind}, block BIGINT, jump ARRAY<INT>")
    reach = stored(
        jumps.join(of_runs, ["day", "block"]).select(
            "day", "block", "jump", F.col("block").alias("origin"), (~F.col("linked")).alias("known")
        ),
        "jumps",
    )
    distance = 1
    while distance < longest:
        before = reach.select(
            "day", (F.col("block") + 1).alias("origin"), F.col("jump").alias("_jump"),
            F.col("origin").alias("_origin"), F.col("known").alias("_known"),
        )
        composed = F.transform("_jump", lambda entry: F.get("jump", entry))
        reach = stored(
            reach.where("NOT known").join(before, ["day", "origin"]).select(
                "day", "block", composed.alias("jump"), F.col("_origin").alias("origin"), F.col("_known").alias("known")
            ).union(reach.where("known").select("day", "block", "jump", "origin", "known")),
            "jumps",
        )
        distance *= 2
    leaving = reach.select("day", (F.col("block") + 1).alias("block"), F.get("jump", F.lit(0)).alias("entry"))
    return leaving.join(marked.where("linked").select("day", "block"), ["day", "block"], "left_semi")


def slots(found: DataFrame, gap: int) -> tuple[DataFrame, int]:
    """`day, slot, late_idx, late_sec, early_sec` for each aligned slot that holds seconds, and
    the number of these rows.

    Anchors are more than `gap` apart, so at most two batches meet in a slot of that
    length: the one open before (`early_sec`), and the one opened inside (`late_sec`).
    """
    marked = _marked(found, gap)
    runs = marked.groupBy("day", "run").agg(F.count("*").alias("n"), F.sum("n_slots").alias("n_slots"))
    longest, n_slots = runs.agg(F.max("n"), F.sum("n_slots")).first()
    entry = F.lit(0)
    if (longest or 0) > 1:
        found = found.join(_entries(found, marked, longest, gap), ["day", "block"], "left")
        entry = F.coalesce("entry", F.lit(0))
    # As if the open batch had begun `gap` seconds before the last second that it holds.
    open_since = F.col("block") * block_length(gap) - 1 + entry - gap

    def extend(anchors, s):
        opens = s > F.element_at(anchors, -1) + gap
        return F.when(opens, F.concat(anchors, F.array(s))).otherwise(anchors)

    walked = F.aggregate("seconds", F.array(open_since), extend)
    anchored = found.select("day", "block", "slots", walked.alias("anchors")).withColumn(
        "anchors", F.slice("anchors", F.lit(2), F.size("anchors"))
    )
    before = Window.partitionBy("day").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Numbers first: a block is one row of the windows, not one for each slot.
    numbered = anchored.select(
        "day",
        "slots",
        "anchors",
        F.coalesce(F.sum(F.size("anchors")).over(before), F.lit(0)).cast("int").alias("base"),
        F.last(F.get("anchors", F.size("anchors") - 1), ignorenulls=True).over(before).alias("held"),
    )
    placed = numbered.select("day", F.explode("slots").alias("slot"), "anchors", "base", "held")
    opened = F.size(F.filter("anchors", lambda a: a < (F.col("slot") + 1) * gap))
    known = F.concat(F.array("held"), F.col("anchors"))
    rows = placed.withColumn("opened", opened).select(
        "day",
        "slot",
        (F.col("base") + F.col("opened") - 1).alias("late_idx"),
        F.get(known, F.col("opened")).alias("late_sec"),
        F.get(known, F.col("opened") - 1).alias("early_sec"),
    )
    return rows, n_slots or 0
