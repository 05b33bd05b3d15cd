"""Word windows that already occur in an earlier document, and texts without them.

Shared by the two operators that find repeated passages: each supplies, by its own method,
the starts at which a window may be repeated; here equal windows meet and the earliest
document keeps its words.

Rows are `doc_id, at`: `at` packs 32 bits of the text (`tables.text_id`) above the word
position, so documents that share an id but not a text stay apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wordtide.llm import words as W
from wordtide.llm.tables import text_id, written

LOW = 0xFFFFFFFF
WINDOWS = "hash BIGINT, doc_id BIGINT, at BIGINT"


def identified(docs: DataFrame) -> DataFrame:
    """`doc_id, tid, text`. Documents without an id are left out: nothing is smaller than null."""
    return docs.select(F.col("doc_id").cast("bigint"), text_id().alias("tid"), "text").where("doc_id IS NOT NULL")


def position(at: str = "at") -> Column:
    return F.col(at).bitwiseAND(F.lit(LOW))


def by_document(rows: DataFrame, value: Column) -> DataFrame:
    """`doc_id, tid, found`: the values of each document, at most one for each of its words."""
    return rows.groupBy("doc_id", F.shiftrightunsigned("at", 32).alias("tid")).agg(
        F.collect_set(value).alias("found")
    )


def joined(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    return docs.join(found, ["doc_id", "tid"], how)


def packed(tid: pa.Array, text: np.ndarray, start: np.ndarray) -> pa.Array:
    ids = tid.to_numpy(zero_copy_only=False).astype(np.uint64)[text]
    return W.signed((ids << np.uint64(32)) | start.astype(np.uint64))


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """List of each value of a list column, and the values."""
    lengths = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), lengths), column.flatten().to_numpy(zero_copy_only=False)


def least_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Index of the least of `hashes[i:i + width]` for each i, the leftmost of equals."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, reach = np.arange(len(hashes)), 1
    while reach < width:
        step = min(reach, width - reach)
        near, far = best[: len(best) - step], best[step:]
        best = np.where(hashes[far] < hashes[near], far, near)
        reach += step
    return best[:n]


def ranges(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of each run of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return begin, np.diff(np.concatenate([begin, [len(values)]]))


def anchored(docs: DataFrame, length: int, first: int, width: int, depth: int) -> DataFrame:
    """`hash, doc_id, at, n`: representatives of the windows of `length` words.

    The window at s is represented by the least hash of `first` words that starts within
    s to s + `width` - 1; `hash` is that of the `depth` words there, `at` has the first of
    the `n` neighbouring windows that it represents.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.SPACED)
            text, start = W.run_starts(words, length)
            if not len(text):
                continue
            hashes = W.run_hashes(words.hashes, first)
            least = least_of(hashes, width)[start]
            keys = hashes if depth == first else W.run_hashes(words.hashes, depth)
            begin, n = ranges(least)
            yield pa.RecordBatch.from_arrays(
                [W.signed(keys[least[begin]]), batch.column("doc_id").take(pa.array(text[begin])),
                 packed(batch.column("tid"), text[begin], start[begin] - words.offsets[text[begin]]),
                 pa.array(n.astype(np.int32))],
                ["hash", "doc_id", "at", "n"],
            )

    return identified(docs).mapInArrow(scan, f"{WINDOWS}, n INT")


def expanded(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows that `start << 8 | n` stands for."""
    n = value & 255
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(text, n), np.repeat(value >> 8, n) + within


def represented(rows: DataFrame) -> DataFrame:
    return by_document(rows, F.shiftleft(position(), 8).bitwiseOR(F.col("n").cast("bigint")))


Starts = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def windows_at(frame: DataFrame, length: int, starts: Starts) -> DataFrame:
    """Hashes of windows of `length` words of `doc_id, tid, text, found`.

    `starts` makes text and word position of each window out of text and value of `found`.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.SPACED)
            text, start = starts(*flat_lists(batch.column("found")))
            inside = (start >= 0) & (start + length <= words.counts[text])
            text, start = text[inside], start[inside]
            hashes = W.run_hashes(words.hashes, length)
            own = hashes[words.offsets[text] + start] if len(text) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [W.signed(own), batch.column("doc_id").take(pa.array(text)), packed(batch.column("tid"), text, start)],
                ["hash", "doc_id", "at"],
            )

    return frame.select("doc_id", "tid", "text", "found").mapInArrow(hashed, WINDOWS)


def _met(rows: DataFrame) -> DataFrame:
    """`hash, low`: hashes of two documents or more, with the smallest id.

    Each task reduces a hash to one row first. Written, so that the joins that follow are
    between two plain shuffles, of which Spark can split skewed partitions.
    """
    ends = rows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return written(ends.where("low < high").select("hash", "low"), "met")


def in_several(rows: DataFrame) -> DataFrame:
    """Rows whose hash occurs in two documents or more."""
    return rows.join(_met(rows).select("hash"), "hash", "left_semi")


def seen_before(rows: DataFrame) -> DataFrame:
    """`doc_id, at` of windows whose hash also occurs in a document with a smaller id."""
    return rows.join(_met(rows), "hash").where("low < doc_id").select("doc_id", "at")


def covered(n_words: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of `n_words` words lie in a window of `length` words at one of `starts`."""
    change = np.zeros(n_words + 1, np.int64)
    starts = starts[(starts >= 0) & (starts < n_words)]
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, n_words), -1)
    return np.cumsum(change[:-1]) > 0


def without(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """`docs` with `n_words`, `n_removed`, `kept_text` and `kept_sha256`.

    `kept_text` has the words outside the windows at `found`, joined by one space, and is
    null where nothing was removed. The digest is that of all kept words joined by one space.
    Columns of `docs` keep their names; added ones of the same name replace them.
    """
    added = ["n_words", "n_removed", "kept_text", "kept_sha256"]
    own = [c for c in docs.columns if c not in added]
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"), text_id().alias("tid"), "text",
    )
    frame = joined(named, found, "left").select("row", "text", "found")
    schema = "row " + named.schema["row"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            n_words, n_removed, texts, digests = [], [], [], []
            for text, starts in zip(batch.column("text"), batch.column("found"), strict=True):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                n_words.append(len(words))
                kept = words
                if starts.is_valid:
                    kept = list(compress(words, ~covered(len(words), starts.values.to_numpy(zero_copy_only=False), length)))
                whole = b" ".join(kept)
                n_removed.append(len(words) - len(kept))
                texts.append(whole.decode("utf-8", "replace") if len(kept) < len(words) else None)
                digests.append(hashlib.sha256(whole).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                ["row", *added],
            )

    cut_rows = frame.mapInArrow(cut, f"{schema}, n_words BIGINT, n_removed BIGINT, kept_text STRING, kept_sha256 STRING")
    return cut_rows.select("row.*", *added)


def as_documents(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """`docs` with the texts (and `n_chars`, where there is one) after the cut, all else as it was."""
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    cut = without(whole, found, length)
    columns = []
    for name in docs.columns:
        column = F.col(f"whole.`{name}`")
        if name == "text":
            column = F.coalesce("kept_text", "text")
        elif name == "n_chars":
            changed = F.when(F.col("kept_text").isNotNull(), F.char_length("kept_text"))
            column = changed.otherwise(column).cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return cut.select(*columns)
