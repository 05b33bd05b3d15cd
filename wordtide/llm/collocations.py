"""Phrases whose words occur together far more often than apart, by Misra-Gries summaries.

1. Words are counted exactly. Only phrases of words that reach the threshold can reach it.
2. Each task counts its phrases (as 64-bit hashes), and sends the counts to the hash partition
   of each. A partition merges them into one Misra-Gries summary. Its capacity exceeds the
   mass of the partition divided by the threshold, so less than the threshold is ever taken
   off any count, and every phrase that reaches it survives. The masses are sent ahead of the
   counts, so each capacity is known before the first of them.
3. A second pass counts the survivors exactly, as words. What else falls on a survivor's place
   in the fixed table of bits that names them is counted as well, and fails the threshold.

Both tables of bits (frequent words, surviving phrases) are `SLOTS` bits, whatever the input:
the fuller they are, the less they save, and results never depend on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from wordtide.llm import words as W
from wordtide.llm.tables import written

THRESHOLD, LONGEST, BEST = 30, 4, 2_000
#: A phrase goes if a longer one that holds it has at least this share of its count.
SHARE_IN_100 = 80
SCALE = 2_000_000
#: Bits of a table of hashes: 16 MB.
SLOTS = 1 << 27
#: Bytes of text that are counted at a time, and counts that a task holds before it sends them.
PORTION, HELD = 2 << 20, 1_000_000
#: Entries of a summary that hash partitions are made small enough for.
ENTRIES = 1 << 20

_U = np.uint64
_WORD, _SPACE, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Scan:
    """The words of some texts: `codes[i]` numbers the i-th one, equal words of one language alike.

    `joined[i]`: the next word is in the same piece. By number: the word's bytes, its language
    and a hash of both.
    """

    codes: np.ndarray
    joined: np.ndarray
    names: pa.Array
    langs: pa.Array
    hashes: np.ndarray


def scan(text: pa.Array, lang: pa.Array) -> Scan:
    data, bounds = W._layout(text)
    data = _LOWER[data]
    kind = _KIND[data]
    inside = kind == _WORD
    begins = bounds[:-1][bounds[:-1] < len(data)]
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    before[begins] = False
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    after[begins[begins > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    owner = np.searchsorted(bounds, starts, "right") - 1
    breaks = np.cumsum(kind == _BREAK)[starts] if len(starts) else starts
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (owner[1:] == owner[:-1]) & (breaks[1:] == breaks[:-1])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    packed = np.ascontiguousarray(data[inside])
    names = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    encoded = names.dictionary_encode()
    langs = pc.fill_null(lang, "und").cast(pa.large_binary()).dictionary_encode()
    n_langs = max(1, len(langs.dictionary))
    of_lang = langs.indices.to_numpy(zero_copy_only=False)[owner] if len(starts) else starts
    keys = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n_langs + of_lang
    distinct, codes = np.unique(keys, return_inverse=True)
    own_names = encoded.dictionary.take(pa.array(distinct // n_langs))
    seeds = [xxhash.xxh3_64_intdigest(x) for x in langs.dictionary.to_pylist()]
    own_langs = (distinct % n_langs).tolist()
    hashes = [xxhash.xxh3_64_intdigest(x, seeds[i]) for x, i in zip(own_names.to_pylist(), own_langs, strict=True)]
    return Scan(
        codes.astype(np.int64), joined, own_names, langs.dictionary.take(pa.array(own_langs, pa.int64())),
        np.array(hashes, np.uint64),
    )


@dataclass
class Grams:
    """The distinct phrases of one length: a place each, how often they occur, and hashes."""

    length: int
    first: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray


def grams(found: Scan, frequent: np.ndarray, longest: int) -> Iterator[Grams]:
    """Phrases of two words up to `longest` of which every word is `frequent` (by number)."""
    usable = frequent[found.codes]
    at = np.flatnonzero(usable)
    number, hashes = found.codes[at], found.hashes
    width = max(1, len(found.hashes))
    for length in range(2, longest + 1):
        last = at + length - 1
        on = last < len(found.codes)
        on[on] = found.joined[last[on] - 1] & usable[last[on]]
        at, number = at[on], number[on]
        word = found.codes[at + length - 1]
        distinct, first, inverse, counts = np.unique(
            number * width + word, return_index=True, return_inverse=True, return_counts=True
        )
        hashes = W.mix(hashes[distinct // width] * _U(0x9E3779B97F4A7C15) + found.hashes[distinct % width] + _U(length))
        number = inverse
        yield Grams(length, at[first], counts, hashes)


class Summary:
    """A Misra-Gries summary: counts of at most `capacity` keys, each too low by `taken` at most.

    Every cut takes the same from more than `capacity` keys, so `taken` stays below the mass
    divided by the capacity. Summaries of parts merge into that of the whole.
    """

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._n = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._n += len(keys)
        if self._n > self.capacity:
            self._merge()

    def merge(self, other: Summary) -> None:
        other._merge()
        self.add(other.keys, other.counts)
        self.taken += other.taken

    def _merge(self) -> None:
        keys, counts = summed(
            np.concatenate([self.keys, *(k for k, _ in self._waiting)]),
            np.concatenate([self.counts, *(c for _, c in self._waiting)]),
        )
        self._waiting, self._n = [], 0
        if len(keys) > self.capacity:
            nth = len(keys) - self.capacity - 1
            cut = int(np.partition(counts, nth)[nth])
            counts = counts - cut
            keys, counts = keys[counts > 0], counts[counts > 0]
            self.taken += cut
        self.keys, self.counts = keys, counts

    def reaching(self, threshold: int) -> np.ndarray:
        """Keys that may have occurred `threshold` times; all that did, if `taken` is below it."""
        self._merge()
        return self.keys[self.counts + self.taken >= threshold]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begin], np.add.reduceat(counts, begin)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def bits_of(slots: DataFrame) -> bytes:
    """The table of bits with those at `slot` set: `SLOTS` / 8 bytes."""
    block = F.shiftright("slot", 15).alias("block")
    rows = slots.groupBy(block).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767))).alias("bits")).collect()
    table = bytearray(SLOTS // 8)
    for row in rows:  # at most SLOTS / 32768, of 4 KB
        table[row.block << 12 : (row.block + 1) << 12] = row.bits
    return bytes(table)


def is_set(table: bytes, hashes: np.ndarray) -> np.ndarray:
    slot = _slot(hashes)
    return (np.frombuffer(table, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[Scan]:
    for batch in W.portions(batches, size=PORTION):
        yield scan(batch.column("text"), batch.column("lang"))


def word_counts(docs: DataFrame) -> DataFrame:
    """`lang, phrase, a, slot` of every word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _portions(batches):
            n = np.bincount(found.codes, minlength=len(found.hashes))
            yield pa.RecordBatch.from_arrays(
                [found.langs.cast(pa.binary()), found.names.cast(pa.binary()), pa.array(n, pa.int64()), pa.array(_slot(found.hashes))],
                ["lang", "phrase", "a", "slot"],
            )

    rows = docs.mapInArrow(counted, "lang BINARY, phrase BINARY, a BIGINT, slot BIGINT")
    strings = rows.select(F.col("lang").cast("string"), F.col("phrase").cast("string"), "a", "slot")
    return strings.groupBy("lang", "phrase").agg(F.sum("a").alias("a"), F.min("slot").alias("slot"))


SENT = "part BIGINT, is_count BOOLEAN, mass BIGINT, keys BINARY, counts BINARY"


def _sent(docs: DataFrame, frequent, log_parts: int, longest: int) -> DataFrame:
    """What each task counted, for every hash partition: its mass, and its counts in blocks."""
    shift = _U(64 - log_parts)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masses: dict[int, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def blocks() -> pa.RecordBatch:
            keys, counts = summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            part = (keys >> shift).astype(np.int64) if log_parts else np.zeros(len(keys), np.int64)
            begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = [*begin[1:].tolist(), len(keys)]
            parts, mass = part[begin].tolist(), np.add.reduceat(counts, begin).tolist()
            for p, m in zip(parts, mass, strict=True):
                masses[p] = masses.get(p, 0) + m
            small = counts.astype(np.uint32)
            spans = list(zip(begin.tolist(), ends, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int64()), pa.array([True] * len(parts)), pa.array([0] * len(parts), pa.int64()),
                 pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([small[a:b].tobytes() for a, b in spans], pa.binary())],
                ["part", "is_count", "mass", "keys", "counts"],
            )

        n = 0
        for found in _portions(batches):
            for g in grams(found, is_set(frequent.value, found.hashes), longest):
                if len(g.hashes):
                    held.append((g.hashes, g.counts.astype(np.int64)))
                    n += len(g.hashes)
            if n > HELD:
                yield blocks()
                held, n = [], 0
        if n:
            yield blocks()
        none = pa.array([None] * len(masses), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(masses, pa.int64()), pa.array([False] * len(masses), pa.bool_()), pa.array(masses.values(), pa.int64()), none, none],
            ["part", "is_count", "mass", "keys", "counts"],
        )

    return docs.mapInArrow(counted, SENT)


def surviving(sent: DataFrame, threshold: int) -> DataFrame:
    """`slot` of every hash that the summary of its partition keeps."""

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept(summary: Summary | None) -> Iterator[pa.RecordBatch]:
            if summary is not None:
                yield pa.RecordBatch.from_arrays([pa.array(_slot(summary.reaching(threshold)))], ["slot"])

        part, mass, summary = None, 0, None
        for batch in batches:
            numbers = (batch.column(c).to_pylist() for c in ("part", "is_count", "mass"))
            keys, counts = batch.column("keys"), batch.column("counts")
            for i, (p, is_count, m) in enumerate(zip(*numbers, strict=True)):
                if p != part:
                    yield from kept(summary)
                    part, mass, summary = p, 0, None
                if not is_count:
                    mass += m
                    continue
                summary = summary or Summary(mass // threshold + 1)
                # Copied, so that the batch can go before the summary takes them in.
                block = np.frombuffer(keys[i].as_buffer(), np.uint64).copy()
                summary.add(block, np.frombuffer(counts[i].as_buffer(), np.uint32).astype(np.int64))
        yield from kept(summary)

    sorted_ = sent.repartition("part").sortWithinPartitions("part", "is_count")
    return sorted_.mapInArrow(summarised, "slot BIGINT")


def phrase_counts(docs: DataFrame, frequent, candidates, threshold: int, longest: int) -> DataFrame:
    """`lang, phrase, a` of the phrases of two words or more that reach the threshold, exactly."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _portions(batches):
            for g in grams(found, is_set(frequent.value, found.hashes), longest):
                own = is_set(candidates.value, g.hashes)
                first, counts = g.first[own], g.counts[own]
                parts = [found.names.take(pa.array(found.codes[first + i])) for i in range(g.length)]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
                lang = found.langs.take(pa.array(found.codes[first]))
                yield pa.RecordBatch.from_arrays(
                    [lang.cast(pa.binary()), phrase.cast(pa.binary()), pa.array(counts, pa.int64())], ["lang", "phrase", "a"]
                )

    rows = docs.mapInArrow(counted, "lang BINARY, phrase BINARY, a BIGINT")
    strings = rows.select(F.col("lang").cast("string"), F.col("phrase").cast("string"), "a")
    return strings.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= threshold)


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """`lang, phrase, a` of the words and phrases that occur `threshold` times; `lang, n` of all words."""
    if threshold < 1 or longest < 1:
        raise ValueError("the threshold and the longest phrase are 1 at least")
    context = docs.sparkSession.sparkContext
    docs = docs.select("text", F.col("lang").cast("string"))
    words = written(word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    often = words.where(F.col("a") >= threshold)
    frequent = context.broadcast(bits_of(often.select("slot")))
    mass = (longest - 1) * (words.agg(F.sum("a")).first()[0] or 0)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Several for each task, so that tasks are alike and blocks small.
    log_parts = max(8 * partitions, mass // (threshold * ENTRIES)).bit_length()
    slots = surviving(_sent(docs, frequent, log_parts, longest), threshold)
    candidates = context.broadcast(bits_of(slots))
    phrases = written(phrase_counts(docs, frequent, candidates, threshold, longest), "phrases")
    return phrases.unionByName(often.select("lang", "phrase", "a")), totals


def _sub(words: str, first: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, first, length), " ")


def scored(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """`lang, phrase, a, l, r, score`: the lowest-scoring cut of each phrase, ties to the first."""
    cut = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    parts = cut.select(
        "lang", "phrase", "a", "k", _sub("words", F.lit(1), F.col("k")).alias("first"),
        _sub("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"),
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    both = parts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(8,0)) * CAST(a AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def held_by_longer(phrases: DataFrame) -> DataFrame:
    """`lang, phrase, most`: the largest count of a longer phrase that holds the words."""
    n = F.size("words")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), n - 1),
            lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: F.array_join(F.slice("words", i, m), " ")),
        )
    )
    inner = phrases.where(n > 2).select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a")
    return inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))


def best_of_each(rows: DataFrame, key: str, order: list[Column], n: int, tie: str) -> DataFrame:
    """The first `n` rows of each key, with their `rank`.

    First the best of every small share of a key, then of every some hundred shares, then of
    the whole, so no task sorts all rows of a key.
    """
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    rows = rows.withColumn("share", F.pmod(F.hash(tie), F.lit(shares)))
    for step in (F.col("share"), F.pmod("share", F.lit(max(1, int(shares**0.5)))), F.lit(0)):
        window = Window.partitionBy(key, step).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)
    return rows.drop("share")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, best: int = BEST) -> DataFrame:
    """`lang, rank, phrase, a, l, r, n, score`: the first `best` phrases of each language.

    Texts are lowered (A to Z), split at `.,;:!?` and line ends into pieces, these at spaces and
    tabs into words. A phrase is 2 to `longest` words of a piece that occur `threshold` times
    (`a`) in its language (null: `und`). Cut in two parts that occur `l` and `r` times it scores
    `SCALE * a // (l + r)`; the lowest cut counts, the first of equals. Phrases that lie in a
    longer one of at least `SHARE_IN_100` % of their count go. `n` is the number of words of the
    language. Order: score, then `a`, both descending, then the phrase's bytes.

    Null and empty texts have no words; repeated rows count each time; other columns are not
    read. A language without phrases has no rows.
    """
    known, totals = frequent_phrases(docs, threshold, longest)
    split = known.withColumn("words", F.split("phrase", " "))
    phrases = split.where(F.size("words") > 1)
    held = held_by_longer(phrases)
    decimal = "decimal(19,0)"
    loose = F.col("most").isNull() | (
        F.col("most").cast(decimal) * F.lit(100) < F.col("a").cast(decimal) * F.lit(SHARE_IN_100)
    )
    kept = scored(phrases, known).join(held, ["lang", "phrase"], "left").where(loose).drop("most")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = best_of_each(kept, "lang", order, best, "phrase").join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint"))
