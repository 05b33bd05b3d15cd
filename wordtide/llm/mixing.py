"""Mixing sources to target weights along a curriculum, in DataFrame functions only.

Every source has a weight that changes over the training, from 0 to 1, linearly from
`weight * (1 + tilt)` to `weight * (1 - tilt)`. Its integral is the source's share of all
words, as far as `MOST_REPEATS` times the source's own words reach; what lies beyond is shared
again among the others by weight. Integrated up to time t, the schedule says how many words of
the source are consumed by t, so a document whose words begin at u in its source's order is
read at the time at which the demand reaches u: the inverse of a quadratic. The training
order is a range sort of all documents by that time.

A source's order is by hash of the document. Its running sums are taken in two steps, within
buckets of the hash and over bucket sums, so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordtide.llm.rules import SPACE
from wordtide.llm.tables import written

#: By rank of the source in code point order, null last.
WEIGHTS = (5.0, 2.0, 1.0)
#: By the same rank: sources of large weight fade out, those of small weight fade in.
TILTS = (0.5, 0.0, -0.5)
MOST_REPEATS = 3.0

def word_count(text: str = "text") -> Column:
    trimmed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("bigint")


def _pick(values: tuple[float, ...], rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    tilts: tuple[float, ...] = TILTS,
    most: float = MOST_REPEATS,
) -> DataFrame:
    """`source, source_size, weight, tilt, target` of sources with `source, source_size`.

    Sharing the excess again until no source is above its limit ends where every source has
    the lesser of its limit and `level * weight`, with one level for all. A source is at its
    limit if its limit by weight is low, so the level follows from running sums over sources
    in that order. Works on one row per source; a catalogue of sources is small.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sizes.withColumn("rank", rank)
    placed = ranked.select(
        "source", "source_size", "rank",
        _pick(weights, F.col("rank")).alias("weight"), _pick(tilts, F.col("rank")).alias("tilt"),
        (F.col("source_size") * most).alias("limit"),
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    # The level if all sources before this one are at their limits and the rest share what is left.
    level = left / F.sum("weight").over(after)
    free = placed.withColumn("level", level).withColumn("is_free", F.col("level") * F.col("weight") <= F.col("limit"))
    final = F.min(F.when(F.col("is_free"), F.struct(F.col("limit") / F.col("weight"), "rank", "level"))).over(everything)
    target = F.least("limit", F.coalesce(F.col("final.level") * F.col("weight"), F.col("limit")))
    return free.withColumn("final", final).select("source", "source_size", "weight", "tilt", target.alias("target"))


def time_at(share: Column, tilt: Column) -> Column:
    """The time at which a source with this tilt has consumed `share` of its target.

    The integral of `1 + tilt - 2 tilt t` up to t is `(1 + tilt) t - tilt t^2`; its inverse in
    the form that does not divide by the tilt.
    """
    rise = 1 + tilt
    return 2 * share / (rise + F.sqrt(F.greatest(rise * rise - 4 * tilt * share, F.lit(0.0))))


def _order_hash() -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def curriculum(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    tilts: tuple[float, ...] = TILTS,
    most: float = MOST_REPEATS,
) -> DataFrame:
    """`doc_id, source, size, source_size, target, copies, taken, positions` per row of `docs`.

    `positions` are the times, from 0 to 1, at which the document's copies are read, one for
    each. A source is read whole as often as its target allows, and once more up to the
    document in which the target ends, so it is off by less than a document. Null texts and
    empty ones have size 0; a source whose size is 0 has target 0. Null is a source. Rows that
    are equal in id and text follow each other in an order that does not matter.
    """
    sized = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size"), _order_hash().alias("h")
    )
    rows = written(sized, "sizes")
    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    targets = written(source_targets(sizes.drop("n"), weights, tilts, most), "targets")
    # About as many buckets as documents in each: both sums run over the root of a source's rows.
    largest = sizes.agg(F.max("n")).first()[0] or 1
    buckets = 1 << (largest.bit_length() + 1) // 2
    # The upper bits, so buckets follow the order of the hash.
    bucket = F.shiftright("h", 64 - buckets.bit_length() + 1)
    bucketed = rows.withColumn("bucket", bucket)
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("base"),
    )
    within = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size")
    before = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    summed = bucketed.withColumn("before", before)
    placed = summed.join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    ).withColumn("begin", F.col("base") + F.col("before"))
    of = targets.withColumnRenamed("source", "_of")
    known = placed.drop("_source", "_bucket").join(of, F.col("source").eqNullSafe(F.col("_of")))
    whole = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)) + 1e-9)
    rest = F.col("target") - whole * F.col("source_size")
    # Half a document either way: a document is read once more if its middle is within the rest.
    more = (F.col("begin") + F.col("size") / 2 < rest) & (whole < most)
    copies = F.when(F.col("size") > 0, whole + F.when(more, 1).otherwise(0)).otherwise(0).cast("bigint")
    counted = known.withColumn("copies", copies)
    nth = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))
    share = lambda i: F.least(
        F.lit(1.0), (i * F.col("source_size") + F.col("begin")) / F.col("target")
    )
    times = F.transform(nth, lambda i: time_at(share(i), F.col("tilt")))
    return counted.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.coalesce(times, F.array().cast("array<double>")).alias("positions"),
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy, range-sorted by `position`: `position, doc_id, source, size`."""
    copies = mixed.select(F.explode("positions").alias("position"), "doc_id", "source", "size")
    return copies.orderBy("position", "source", "doc_id")


def mixed_sources(docs: DataFrame) -> DataFrame:
    """Per document `doc_id, size, source_size, target, taken` and `first_position`, in training order."""
    mixed = curriculum(docs)
    first = F.when(F.size("positions") > 0, F.col("positions")[0])
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", first.alias("first_position")
    ).orderBy(F.col("first_position").asc_nulls_last(), "doc_id")
