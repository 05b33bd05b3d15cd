"""WARC archives of pages: written as plain files, read back by byte ranges.

Writing: a page is a `response` record, or a `revisit` of the page with the largest id among
those of equal payload. A record is one line of Spark's text sink whose line end completes
the blank lines after the record, so files are committed as any other output of Spark.

Reading: files are cut into byte ranges of `RANGE` bytes, one task row each, so neither a
long file nor a long chain of records lies in one task. In each range every place that looks
like the begin of a record is a candidate, also inside payloads, and is emitted with the
offset of its successor, which its Content-Length tells. What is a record is decided by
boundary chains: records are what is reachable from the start of the file. Pointer jumping
finds it in as many rounds as the logarithm of the records of a file: each round, successors
of reached candidates are reached, and each candidate's successor becomes its successor's.
Only then are payloads of records read and their digests computed.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordtide.llm.tables import drop, written

RANGE = 8 << 20
DATE = "2024-01-01T00:00:00Z"
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
HEADER_END = b"\r\n\r\n"
#: Fixed: the profile of revisits of an equal payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed: digits of base 32 and what the same values are in hexadecimal-style base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

CANDIDATES = "path STRING, at BIGINT, next BIGINT, block BIGINT, length BIGINT"
RECORDS = (
    "page_id BIGINT, record_id STRING, record_type STRING, refers_to STRING, target STRING, "
    "stated_digest STRING, payload_bytes BIGINT, payload_digest STRING, payload BINARY"
)


def base32_sha1(value: Column) -> Column:
    """SHA-1 in upper-case base 32: 160 bits are 4 times 40."""
    digest = F.sha1(value)
    part = lambda i: F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0")
    return F.translate(F.upper(F.concat(*map(part, range(4)))), DIGITS32, BASE32)


def _record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(">"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE) -> None:
    """Write `page_id, url, html` as WARC files below `folder`, a record per row.

    Null html is empty. Among payloads of at least `least_bytes` bytes that are equal, the
    page of the largest id is the response and the others revisit it; rows of the same id
    and payload are the same. Pages without an id revisit one that has an id, and are all
    responses where none has.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    equal = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("owner"), F.count("*").alias("n")
    )
    # Written, so that its size is known: if small it is broadcast, and pages stay in place.
    owners = written(equal.where("n > 1 AND owner IS NOT NULL").select("digest", "owner"), "owners")
    placed = rows.join(owners, "digest", "left")
    again = F.col("owner").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("owner")))
    end = "\r\n"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
        F.octet_length("html").cast("string"), F.lit(end + end),
    )
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    target = F.when(url == "", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    body = F.when(again, F.lit("")).otherwise(F.col("html"))
    head = F.concat(
        F.lit(f"WARC/1.1{end}WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit(f"{end}WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("digest")),
        F.lit(f"{end}WARC-Date: {date}{end}WARC-Target-URI: "), F.coalesce(target, url),
        F.lit(f"{end}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(
            F.lit(f"{end}WARC-Profile: {REVISIT_PROFILE}{end}WARC-Refers-To: "), _record_id(F.col("owner"), F.col("digest"))
        )).otherwise(""),
        F.lit(f"{end}Content-Type: application/http; msgtype=response{end}Content-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(end + end),
    )
    # The sink adds the last line feed.
    record = F.concat(head, http, body, F.lit("\r\n\r"))
    placed.select(record.alias("value")).write.option("lineSep", "\n").text(folder)


def _open(path: str):
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    system, name = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _until(file, at: int, size: int, mark: bytes) -> bytes:
    """Bytes from `at` to the end of the first `mark`, empty if there is none before a NUL or the end."""
    found, step = b"", 4096
    while at + len(found) < size:
        begin = max(0, len(found) - len(mark))
        more = file.read_at(min(step, size - at - len(found)), at + len(found))
        found += more
        end = found.find(mark, begin)
        if end >= 0:
            return found[: end + len(mark)]
        if b"\0" in more:
            break
        step *= 2
    return b""


def _fields(head: bytes) -> dict[bytes, bytes]:
    lines = head.split(b"\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines) if k}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of the byte ranges `path, begin, end, size`."""
    for batch in batches:
        for row in batch.to_pylist():
            rows = []
            with _open(row["path"]) as file:
                # A begin that straddles the end of the range belongs to it.
                low = max(0, row["begin"] - len(HEADER_END))
                data = file.read_at(min(row["end"] + 16, row["size"]) - low, low)
                for match in MAGIC.finditer(data):
                    at = low + match.start()
                    if not row["begin"] <= at < row["end"]:
                        continue
                    if at and data[max(0, match.start() - 4) : match.start()] != HEADER_END:
                        continue
                    close = data.find(HEADER_END, match.start())
                    head = data[match.start() : close + 4] if close >= 0 else _until(file, at, row["size"], HEADER_END)
                    length = _fields(head).get(b"content-length", b"")
                    if length.isdigit():
                        block = at + len(head)
                        rows.append((row["path"], at, block + int(length) + 4, block, int(length)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))],
                    ["path", "at", "next", "block", "length"],
                )


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """`path, size` of the archives; their bytes are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return listed.select("path", F.col("length").alias("size")).where("size > 0")


def candidates(files: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """`path, at, next, block, length` of every place that looks like a record."""
    begin = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(range_bytes).cast("bigint")))
    ranges = files.select("path", begin.alias("begin"), "size")
    ranges = ranges.withColumn("end", F.least(F.col("begin") + range_bytes, "size"))
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(parts, "path", "begin").mapInArrow(_scan, CANDIDATES)


def reachable(found: DataFrame) -> DataFrame:
    """`path, at` of candidates that a chain from the start of their file reaches."""
    chain = written(found.select("path", "at", "next", (F.col("at") == 0).alias("reached")), "chain")
    reached = -1
    while True:
        count = chain.where("reached").count()
        if count == reached:
            return chain.where("reached").select("path", "at")
        reached = count
        ahead = chain.select("path", F.col("at").alias("next"), F.col("next").alias("further"))
        hit = chain.where("reached").select("path", F.col("next").alias("at"), F.lit(True).alias("hit")).distinct()
        step = chain.join(ahead, ["path", "next"], "left").join(hit, ["path", "at"], "left")
        later = written(step.select(
            "path", "at", F.coalesce("further", "next").alias("next"),
            (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached"),
        ), "chain")
        drop(chain)
        chain = later


def _read(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, path = None, None
        for batch in batches:
            for part in range(0, batch.num_rows, 64):
                rows = []
                for row in batch.slice(part, 64).to_pylist():
                    if row["path"] != path:
                        if file is not None:
                            file.close()
                        file, path = _open(row["path"]), row["path"]
                    raw = file.read_at(row["block"] + row["length"] - row["at"], row["at"])
                    fields = _fields(raw[: row["block"] - row["at"]])
                    payload = raw[row["block"] - row["at"] :].partition(HEADER_END)[2]
                    text = lambda name: fields[name].decode("utf-8", "replace") if name in fields else None  # noqa: B023, E731
                    kind, name = text(b"warc-type"), text(b"warc-record-id")
                    page = re.fullmatch(r"<urn:page:(-?\d+):.*>", name or "")
                    stated = (text(b"warc-payload-digest") or "").removeprefix("sha1:")
                    own = kind == "response"
                    rows.append((
                        int(page[1]) if page else None, name, kind, text(b"warc-refers-to"), text(b"warc-target-uri"),
                        stated, len(payload) if own else None,
                        base64.b32encode(hashlib.sha1(payload).digest()).decode() if own else None,
                        payload if own and with_payload else None,
                    ))
                types = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]
                names = [c.split(" ")[0] for c in RECORDS.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
                )

    return read


def records(spark: SparkSession, folder: str, range_bytes: int = RANGE, with_payload: bool = True) -> DataFrame:
    """The records of the archives below `folder`; see `RECORDS`.

    Files whose chain does not end at their last byte are an error. Payloads of 64 records
    are in memory at a time; a single range is.
    """
    files = files_of(spark, folder)
    found = written(candidates(files, range_bytes), "candidates")
    real = written(found.join(reachable(found), ["path", "at"], "left_semi"), "records")
    last = real.groupBy("path").agg(F.max("next").alias("next"))
    broken = files.join(last, "path", "left").where("next IS NULL OR next <> size")
    if first := broken.head(1):
        raise ValueError(f"{first[0].path}: the chain of records ends at {first[0].next} of {first[0].size} bytes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = F.floor(F.col("at") / range_bytes).alias("range")
    placed = real.withColumn("range", near).repartition(parts, "path", "range").sortWithinPartitions("path", "at")
    return placed.select("path", "at", "block", "length").mapInArrow(_read(with_payload), RECORDS)


def round_trip(pages: DataFrame, folder: str, least_bytes: int = 0, range_bytes: int = RANGE) -> DataFrame:
    """`page_id, payload_bytes, payload_digest, record_type, refers_to, intact` per page, out of archives.

    Pages are written below `folder` and read back. Size and digest of a revisit are those
    of the response that it refers to; `intact` tells whether the digest that a response
    states is the one of its payload. No pages give no rows.
    """
    spark = pages.sparkSession
    write_archives(pages, folder, least_bytes)
    read = written(records(spark, folder, range_bytes, with_payload=False), "read")
    responses = read.where("record_type = 'response'")
    owners = responses.select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("owner"),
        F.col("payload_bytes").alias("owner_bytes"), F.col("payload_digest").alias("owner_digest"),
    )
    # Rows of the same id and payload are the same record; which of them is met does not matter.
    owners = written(owners.dropDuplicates(["refers_to"]), "owners")
    revisits = read.where("record_type = 'revisit'").join(owners, "refers_to").select(
        "page_id", F.col("owner_bytes").alias("payload_bytes"), F.col("owner_digest").alias("payload_digest"),
        "record_type", F.col("owner").alias("refers_to"), (F.col("owner_digest") == F.col("stated_digest")).alias("intact"),
    )
    own = responses.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("bigint").alias("refers_to"),
        (F.col("payload_digest") == F.col("stated_digest")).alias("intact"),
    )
    return own.union(revisits)
