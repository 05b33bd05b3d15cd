"""Repeated passages by level-wise doubling.

Windows of `first` words that occur in one document alone cannot be part of a longer
window that occurs in two. So windows of `first` words meet first, those repeated alone are
extended to twice that length, these meet again, and so on until `min_words` is reached or
none survives.

At the first level a window of `2 * first` words is represented by the one of its
`first + 1` windows of `first` words with the least hash (the leftmost of equals). Equal
windows have the same representative at the same offset, so no repetition is lost, and only
about 2 of `first + 2` positions cross the network.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from wordtide.llm import spans
from wordtide.llm.tables import drop, written

MIN_WORDS = 50
FIRST = 25


def _twice(length: int):
    """Starts of windows of twice `length`, both halves of which are repeated."""

    def starts(text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = (text.astype(np.int64) << 32) | start
        kept = np.isin(both + length, both)
        return text[kept], start[kept]

    return starts


def repeated(docs: DataFrame, min_words: int = MIN_WORDS, first: int = FIRST) -> DataFrame:
    """`doc_id, tid, found`: starts of windows that also start in a document with a smaller id.

    `min_words` is `first` times a power of two, 2 at least; `first` is below 255.
    Empty tables and texts of fewer words give no rows.
    """
    levels = min_words // first
    if first < 1 or first > 254 or first * levels != min_words or levels < 2 or levels & (levels - 1):
        raise ValueError("min_words must be first (1 to 254) times a power of two, 2 at least")
    texts = spans.identified(docs)
    rows = written(spans.anchored(docs, 2 * first, first, first + 1, first), "level")
    found = written(spans.represented(spans.in_several(rows)), "candidates")
    drop(rows)
    length, starts = 2 * first, spans.expanded
    while True:
        rows = written(spans.windows_at(spans.joined(texts, found, "inner"), length, starts), "level")
        drop(found)
        if length == min_words:
            break
        found = written(spans.by_document(spans.in_several(rows), spans.position()), "candidates")
        drop(rows)
        length, starts = 2 * length, _twice(length)
    removed = written(spans.by_document(spans.seen_before(rows), spans.position()), "repeated")
    drop(rows)
    return removed


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, first: int = FIRST) -> DataFrame:
    """`docs` with `n_words`, `n_removed`, `kept_text`, `kept_sha256` (see `spans.without`).

    Words are runs of anything but white space. A word goes if a window of `min_words`
    consecutive words covers it whose words also start in a document with a smaller
    `doc_id`; windows are judged on the input. Windows that a document repeats by itself
    stay. Null texts have no words; documents without an id neither lose words nor make
    others lose theirs. Repeated rows get the same result each. Words are compared by
    64-bit hashes of windows that already passed the level below.
    """
    return spans.without(docs, repeated(docs, min_words, first), min_words)
