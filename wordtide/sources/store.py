"""Posts stored as Parquet, a folder per day: the time column alone can be read, days can be pruned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

STORED = "post_id BIGINT, ts TIMESTAMP_NTZ, lang STRING, text STRING, day DATE"


def write_posts(posts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write posts partitioned by the date of `ts`; posts without a time are dropped.

    A day is as many files as there are tasks that hold posts of it, so a busy day is not
    gathered in one task.
    """
    dated = posts.where("ts IS NOT NULL").withColumn("day", F.to_date("ts"))
    dated.select("post_id", "ts", "lang", "text", "day").write.mode(mode).partitionBy("day").parquet(path)


def read_posts(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """Stored posts, of the listed days only if given: other days' folders are not opened."""
    posts = spark.read.schema(STORED).parquet(path)
    if days is not None:
        posts = posts.where(F.col("day").isin([F.lit(d).cast("date") for d in days]))
    return posts.drop("day")
