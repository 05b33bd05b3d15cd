"""Joins with lookups that are small as a rule but have no bound of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# 200,000 rows of a few numbers are some 10 MB: every hour of 22 years.
BROADCAST_ROWS = 200_000
SALTS = 64


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: Column,
    most: int | None = None,
    count: int | None = None,
) -> DataFrame:
    """`rows` with the columns of `lookup`, by equal `keys`.

    The lookup's rows are counted (unless `count` is known), not fetched. Up to `most` are broadcast. More are
    repeated for each of `SALTS` salts, and rows get their salt from a hash of `spread`, so
    a key with very many rows is spread over that many tasks.
    """
    count = lookup.count() if count is None else count
    if count <= (BROADCAST_ROWS if most is None else most):
        return rows.join(F.broadcast(lookup), list(keys))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    copies = lookup.select("*", salts)
    return rows.withColumn("_salt", salt).join(copies, [*keys, "_salt"]).drop("_salt")
