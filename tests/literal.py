"""Seasonal words the long way: one scan per quarter of a day, joined word by word.

For checking the one-pass form, and as the baseline of the bench.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wordtide.functions import patterns as P

# The bounds of the quarters and their names, in time and in output order.
BOUNDS = ["00:00:00", "06:00:00", "12:00:00", "18:00:00", "23:59:59"]
NAMES = ["night", "morning", "afternoon", "evening"]
OUTPUT = ["morning", "afternoon", "evening", "night"]


def quarter_frequency(posts: DataFrame, low: str, high: str, stop: DataFrame, min_count: int):
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    inside = posts.where((shown > low) & (shown < high))
    words = inside.select(F.explode(F.split(F.lower("text"), P.BASIC_SEPARATORS)).alias("word"))
    counts = words.where("word <> ''").groupBy("word").count().where(F.col("count") > min_count)
    total = inside.count()
    return counts.join(stop, "word", "left_anti").select(
        "word", F.round(F.col("count") / total, 4).alias("f")
    )


def seasonal(posts: DataFrame, stop: DataFrame, days, min_count: int, threshold: float = 20):
    week = None
    for day in days:
        quarters = [
            quarter_frequency(posts, f"{day} {BOUNDS[i]}", f"{day} {BOUNDS[i + 1]}", stop, min_count)
            .withColumnRenamed("f", f"f_{name}")
            for i, name in enumerate(NAMES)
        ]
        history = reduce(lambda a, b: a.join(b, "word"), quarters)
        total = reduce(lambda a, b: a + b, [F.col(f"f_{name}") for name in NAMES])
        history = history.withColumn("mean", total / 4)
        deviation = history.select(
            "word",
            *[
                F.round(F.try_divide(F.col(f"f_{n}") - F.col("mean"), F.col("mean")) * 100).alias(f"x_{n}")
                for n in OUTPUT
            ],
        )
        if week is None:
            week = deviation.select("word", *[F.col(f"x_{n}").alias(f"d_{n}") for n in OUTPUT])
        else:
            week = week.join(deviation, "word").select(
                "word", *[(F.col(f"d_{n}") + F.col(f"x_{n}")).alias(f"d_{n}") for n in OUTPUT]
            )
    mean = week.select("word", *[(F.col(f"d_{n}") / len(days)).alias(f"d_{n}") for n in OUTPUT])
    return mean.where(reduce(lambda a, b: a | b, [F.col(f"d_{n}") > threshold for n in OUTPUT]))
