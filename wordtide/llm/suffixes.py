"""Repeated passages from a sparse suffix array.

Of all suffixes only those at minimisers are kept: within any `window` neighbouring grams of
`gram` words the one of the least hash. A passage of `min_words` words holds a minimiser
among its first `window` positions, the same one in every copy, and the passage goes on for
at least `depth = min_words - window + 1` words from there. So suffixes are sorted by (the
hash of) their first `depth` words, and a suffix that equals neither neighbour is part of
no repetition. Matches are then extended: left by as many words as the minimiser represents,
right up to `min_words`, where equal extensions meet once more.

The sort is a range partitioning over (words, document, position), so a passage that a third
of all documents share is spread over many tasks. Runs of equal suffixes that touch the
edge of a partition are compared across partitions by one row per edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wordtide.llm import spans
from wordtide.llm.tables import drop, written

MIN_WORDS = 50
GRAM, WINDOW = 8, 16

ORDER = ["hash", "doc_id", "at"]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition that equal a neighbour (`same`), and its first and last row (`edge`)."""
    held, held_same, first = None, False, True

    def out(rows: pa.RecordBatch, same: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        kept = pa.array(np.flatnonzero(same | edge))
        columns = [*rows.columns, pa.array(same), pa.array(edge)]
        return pa.RecordBatch.from_arrays(columns, [*rows.schema.names, "same", "edge"]).take(kept)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        hashes = batch.column("hash").to_numpy(zero_copy_only=False)
        equal = hashes[1:] == hashes[:-1]
        same = np.zeros(len(hashes), bool)
        same[1:] |= equal
        same[:-1] |= equal
        same[0] |= held_same
        edge = np.zeros(len(hashes), bool)
        edge[0] = first
        held, held_same = batch.slice(batch.num_rows - 1), bool(same[-1])
        if batch.num_rows > 1:
            yield out(batch.slice(0, batch.num_rows - 1), same[:-1], edge[:-1])
            first = False
    if held is not None:
        yield out(held, np.array([held_same]), np.array([True]))


def with_equal_neighbour(rows: DataFrame) -> DataFrame:
    """Rows of the sorted suffixes whose first words another suffix has too."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    array = rows.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER)
    found = written(array.mapInArrow(_compare, f"{spans.WINDOWS}, n INT, same BOOLEAN, edge BOOLEAN"), "neighbours")
    met = found.where("edge").groupBy("hash").agg(F.count("*").alias("edges")).where("edges > 1").select("hash")
    across = found.where("edge AND NOT same").join(met, "hash", "left_semi")
    return found.where("same").select(*rows.columns).union(across.select(*rows.columns))


def repeated(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """`doc_id, tid, found`: starts of windows that also start in a document with a smaller id."""
    depth = min_words - window + 1
    if not 1 <= gram <= depth or not 1 <= window <= 255:
        raise ValueError("gram must be at most min_words - window + 1, window at most 255")
    suffixes = written(spans.anchored(docs, min_words, gram, window, depth), "suffixes")
    found = written(spans.represented(with_equal_neighbour(suffixes)), "matches")
    drop(suffixes)
    texts = spans.joined(spans.identified(docs), found, "inner")
    rows = written(spans.windows_at(texts, min_words, spans.expanded), "extensions")
    drop(found)
    removed = written(spans.by_document(spans.seen_before(rows), spans.position()), "repeated")
    drop(rows)
    return removed


def suffix_dedup(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """`docs` with `n_words`, `n_removed`, `kept_text`, `kept_sha256` (see `spans.without`).

    A word goes if it lies in a passage of `min_words` words or more (runs of anything but
    white space) that also occurs in a document with a smaller `doc_id`; passages are those
    of the input. Passages that a document repeats by itself stay. Null texts have no words;
    documents without an id neither lose words nor make others lose theirs. Repeated rows
    get the same result each.
    """
    return spans.without(docs, repeated(docs, min_words, gram, window), min_words)
