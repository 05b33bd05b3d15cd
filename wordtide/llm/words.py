"""Words of Arrow text columns as arrays of 64-bit hashes, without a Python object per word.

Two kinds of words, both recognised byte by byte in UTF-8:

* `SPACED`: runs of anything but space and U+0009 to U+000D, unchanged;
* `PLAIN`: runs of digits, letters a to z and everything from U+0080, A to Z lowered.

A hash is a polynomial over the bytes (or, for a run of words, over word hashes) modulo 2^64,
taken from prefix sums and then mixed, so all runs of one length cost a few array operations.
Long sequences have well-known collisions modulo 2^64 whatever the base, so no polynomial is
longer than `LONG` terms: longer words are hashed as bytes, longer runs by a mixed chain of
parts, whole texts (128 bits) over their word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACED, PLAIN = "spaced", "plain"
#: Bytes that are split at a time; bounds the work space, not the length of a text.
PIECE = 1 << 20
#: Terms of a polynomial at most.
LONG = 64

_U = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_TABLE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self._bases = base, pow(base, -1, 1 << 64)
        self._tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __reduce__(self):
        return _Powers, (self._bases[0],)  # without the tables

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._tables[0]) < n:
            for i, base in enumerate(self._bases):
                table = np.full(n, base, np.uint64)
                table[0] = 1
                np.multiply.accumulate(table, out=table)
                self._tables[i] = table
        return self._tables[0][:n], self._tables[1][:n]


_byte_powers, _word_powers = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def _alphabet(kind: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256)
    if kind == SPACED:
        return (codes != 32) & ((codes < 9) | (codes > 13)), _TABLE
    lowered = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    inside = (codes >= 128) | ((codes >= 48) & (codes <= 57)) | ((lowered >= 97) & (lowered <= 122))
    return inside, _TABLE[lowered]


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


_ALPHABETS = {kind: _alphabet(kind) for kind in (SPACED, PLAIN)}


@dataclass
class Words:
    """Words of some texts: those of text i are `offsets[i]:offsets[i + 1]` of the arrays.

    `starts` and `ends` are byte positions in `data`, in which text i is
    `bounds[i]:bounds[i + 1]`.
    """

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def _layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = pc.fill_null(texts, "").cast(pa.large_binary())
    buffers = flat.buffers()
    if len(flat) == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(flat) + 1, np.int64)
    bounds = np.frombuffer(buffers[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    if buffers[2] is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(flat) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def split(texts: pa.Array, kind: str) -> Words:
    """The words of each text; null has none."""
    inside_of, value_of = _ALPHABETS[kind]
    data, bounds = _layout(texts)
    begins = bounds[:-1][bounds[:-1] < len(data)]
    found_starts, found_ends, found_hashes = [], [], []
    at = 0
    while at < len(data):
        to = min(at + PIECE, len(data))
        inside = inside_of[data[at:to]]
        if to < len(data) and inside[-1]:
            gaps = np.flatnonzero(~inside)
            if len(gaps):
                to = at + int(gaps[-1]) + 1
                inside = inside[: to - at]
            else:  # one long word: up to its end
                while to < len(data) and inside_of[data[to - 1]]:
                    to = min(to + PIECE, len(data))
                inside = inside_of[data[at:to]]
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        cuts = begins[np.searchsorted(begins, at) : np.searchsorted(begins, to)] - at
        before[cuts] = False
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        after[cuts[cuts > 0] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        powers, inverse = _byte_powers.get(to - at)
        sums = np.zeros(to - at + 1, np.uint64)
        np.cumsum(value_of[data[at:to]] * powers, out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            word = data[at + starts[i] : at + ends[i]].tobytes()
            hashes[i] = xxhash.xxh3_64_intdigest(word.translate(_LOWER) if kind == PLAIN else word)
        found_hashes.append(hashes)
        found_starts.append(starts + at)
        found_ends.append(ends + at)
        at = to
    def joined(parts, kind):
        return np.concatenate(parts) if parts else np.zeros(0, kind)

    starts = joined(found_starts, np.int64)
    return Words(
        joined(found_hashes, np.uint64), np.searchsorted(starts, bounds), starts,
        joined(found_ends, np.int64), data, bounds,
    )


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of `hashes[i:i + length]` for each i, across texts; see `run_starts` for the valid i."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if length > LONG:
        first, rest = run_hashes(hashes, LONG), run_hashes(hashes, length - LONG)
        return mix(first[:n] * _U(_BYTE_BASE) + rest[LONG : LONG + n])
    powers, inverse = _word_powers.get(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers, out=sums[1:])
    return mix((sums[length:] - sums[:n]) * inverse[:n] + _U(length))


def run_starts(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and first word (index into `words.hashes`) of every run of `length` words."""
    counts = np.maximum(words.counts - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    first = np.arange(len(text)) - np.repeat(begin - words.offsets[:-1], counts)
    return text, first


def runs(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and hash of every run of `length` words."""
    text, first = run_starts(words, length)
    return text, first, run_hashes(words.hashes, length)[first] if len(first) else np.zeros(0, np.uint64)


def shingles(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each shingle; a text of fewer words, but not none, is one shingle."""
    text, _, hashed = runs(words, length)
    short = np.flatnonzero((words.counts > 0) & (words.counts < length))
    if len(short):
        own = _spans(words, words.offsets[short], words.offsets[short + 1])
        text, hashed = np.concatenate([text, short]), np.concatenate([hashed, own])
    return text, hashed


def _spans(words: Words, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    powers, inverse = _word_powers.get(len(words.hashes) + 1)
    sums = np.zeros(len(words.hashes) + 1, np.uint64)
    np.cumsum(words.hashes * powers[:-1], out=sums[1:])
    return mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's sequence of words, as two 64-bit halves."""
    raw, offsets = memoryview(np.ascontiguousarray(words.hashes)).cast("B"), (words.offsets * 8).tolist()
    whole = b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets, offsets[1:], strict=False))
    halves = np.frombuffer(whole, np.uint64).reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as the BIGINT that Spark knows."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def portions(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 2 * PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `size` bytes of text, so work space is bounded.

    A single longer text is a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])
