"""Posts: `post_id BIGINT, ts TIMESTAMP_NTZ, lang STRING, text STRING`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordtide.functions import times

# Explicit, so no read infers a schema and a scan parses just these fields.
POST_JSON = "id BIGINT, created_at STRING, text STRING"
DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING"

# The documents table has no time: each document gets its own second of one week.
# 7919 and the number of seconds are coprime.
WEEK_START_EPOCH = 1_704_067_200
WEEK_SECONDS = 604_800
SPREAD = 7_919
WEEK_DAYS = [f"2024-01-0{d}" for d in range(1, 8)]


def _from_json(rows: DataFrame, zone: str) -> DataFrame:
    return rows.select(
        F.col("id").alias("post_id"),
        times.parse_created_at(F.col("created_at"), zone).alias("ts"),
        F.lit(None).cast("string").alias("lang"),
        "text",
    )


def posts_json(spark: SparkSession, path: str | list[str], zone: str = "UTC", day: str | None = None) -> DataFrame:
    """Posts from files or folders of JSON lines; `zone` is the zone of the wall clock `ts`.

    With `day`, a column of that text: all that is read is one stream of posts, whatever
    dates they have, as a file that runs past midnight is.
    """
    posts = _from_json(spark.read.schema(POST_JSON).json(path), zone)
    return posts if day is None else posts.withColumn("day", F.lit(day))


def posts_json_stream(spark: SparkSession, path: str, zone: str = "UTC") -> DataFrame:
    """The same posts as a stream over the files that arrive in a folder."""
    return _from_json(spark.readStream.schema(POST_JSON).json(path), zone)


def day_name(path: str) -> str:
    """The last part of a path: what a file or folder of one day is called."""
    return path.rstrip("/").rsplit("/", 1)[-1]


def _listed(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path), list(system.listStatus(path))


def history_listing(spark: SparkSession, root: str) -> dict[str, str | None]:
    """Path of the posts of each day below `root`: `root/<day>/<day>`, a file or a folder of files.

    Plain files in `root`, hidden folders and other files beside the posts are skipped. An
    empty folder is a day without posts (None). A folder that has something, but nothing
    of its own name, is an error.
    """
    days: dict[str, str | None] = {}
    for status in _listed(spark, root)[1]:
        name = status.getPath().getName()
        if not status.isDirectory() or name[0] in "._":
            continue
        inside = [s.getPath() for s in _listed(spark, status.getPath().toString())[1]]
        own = [p.toString() for p in inside if p.getName() == name]
        if inside and not own:
            raise ValueError(f"{status.getPath()}: no file or folder {name} in it")
        days[name] = own[0] if own else None
    return dict(sorted(days.items()))


def history_json(spark: SparkSession, root: str, zone: str = "UTC") -> DataFrame:
    """Posts of all days of `history_listing`, with a `day` column, the folder's name."""
    paths = [p for p in history_listing(spark, root).values() if p]
    top = _listed(spark, root)[0].toUri().getRawPath().rstrip("/")
    if not paths:
        empty = spark.createDataFrame([], f"{POST_JSON}, day STRING")
        return _from_json(empty, zone).withColumn("day", F.lit(None).cast("string"))
    rows = spark.read.schema(POST_JSON).json(paths)
    below = F.substring_index(F.col("_metadata.file_path"), f"{top}/", -1)
    day = F.url_decode(F.substring_index(below, "/", 1))
    columns = [F.col("id").alias("post_id"), times.parse_created_at(F.col("created_at"), zone).alias("ts")]
    return rows.select(*columns, F.lit(None).cast("string").alias("lang"), "text", day.alias("day"))


def history_json_stream(spark: SparkSession, root: str, zone: str = "UTC", **options) -> DataFrame:
    """Posts below `root/<day>/<day>` as a stream over the files that arrive there, with their `day`.

    What is not called like its day folder is skipped. `options` are those of the file source,
    such as `maxFilesPerTrigger`.
    """
    reader = spark.readStream.schema(POST_JSON).options(**options)
    rows = reader.json(f"{root.rstrip('/')}/*/*")
    top = _listed(spark, root)[0].toUri().getRawPath().rstrip("/")
    below = F.split(F.substring_index(F.col("_metadata.file_path"), f"{top}/", -1), "/")
    day = F.url_decode(below[0])
    columns = [F.col("id").alias("post_id"), times.parse_created_at(F.col("created_at"), zone).alias("ts")]
    own = rows.where(below[0] == below[1])
    return own.select(*columns, F.lit(None).cast("string").alias("lang"), "text", day.alias("day"))


def _week_second():
    return F.lit(WEEK_START_EPOCH) + (F.col("doc_id") * SPREAD) % WEEK_SECONDS


def posts_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")
    return documents.select(
        F.col("doc_id").alias("post_id"),
        times.ntz_from_epoch(_week_second()).alias("ts"),
        "lang",
        "text",
    )


def posts_stream_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same posts as a stream. Braces make the path a glob, so a file and a folder work."""
    documents = spark.readStream.schema(DOCUMENTS).parquet(f"{sf_dir}/{{documents}}.parquet")
    return documents.select(
        F.col("doc_id").alias("post_id"),
        times.ntz_from_epoch(_week_second()).alias("ts"),
        "lang",
        "text",
    )


def posts_stream_from_events(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """`posts_from_events` as a stream."""
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING"
    events = spark.readStream.schema(schema).options(**options).parquet(f"{sf_dir}/{{events}}.parquet")
    return events.select(
        F.col("event_id").alias("post_id"), "ts", F.lit(None).cast("string").alias("lang"), F.col("event_type").alias("text")
    )


def posts_from_rendered_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of `documents`, rendered as JSON lines and parsed by the JSON source's schema."""
    posts = posts_from_documents(spark, sf_dir)
    fields = F.struct(
        F.col("post_id").alias("id"), times.format_created_at(F.col("ts")).alias("created_at"), "text", "lang"
    )
    parsed = posts.select(F.from_json(F.to_json(fields), POST_JSON).alias("post"))
    return _from_json(parsed.select("post.*"), "UTC")


def posts_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of `events` as one-word posts with real times."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("post_id"),
        "ts",
        F.lit(None).cast("string").alias("lang"),
        F.col("event_type").alias("text"),
    )
