"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordtide.scratch import scratch_folder


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


#: Rows of a few numbers that a file of an iteration's table holds, and files at least.
ROWS_PER_FILE, LEAST_FILES = 100_000, 8


def written(frame: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """`frame` written as Parquet below the shared folder and read again.

    Later steps start from these files, so a lost executor costs no more than the step at
    hand. Shuffle files of the finished step are let go. With `rows`, about the number of its
    narrow rows, the files are as many as these need, not as many as there are shuffle
    partitions.
    """
    spark = frame.sparkSession
    if rows is not None:
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        frame = frame.coalesce(min(most, max(LEAST_FILES, rows // ROWS_PER_FILE)))
    folder = f"{scratch_folder(spark, label)}/table"
    schema = frame.schema
    frame.write.parquet(folder)
    del frame
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(folder)


def drop(table: DataFrame) -> None:
    """Remove a table of `written` that no frame reads any more."""
    spark = table.sparkSession
    for file in table.inputFiles()[:1]:
        path, system = _path(spark, file.rsplit("/", 1)[0])
        system.delete(path, True)


def text_id(text: str | Column = "text") -> Column:
    """32 bits that tell texts with the same `doc_id` apart; null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(column, F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF))
