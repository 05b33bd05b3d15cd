"""Folders for streams and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the one that `spark.checkpoint.dir` names.

    Without that setting only a local master gets a folder, a temporary one: executors of a
    cluster would each write to a disk of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix=f"{label}-")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """`frame` written as Parquet to a folder of its own and read again: computed once."""
    path = f"{scratch_folder(frame.sparkSession, label)}/table"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
