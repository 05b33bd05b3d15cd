"""Token counts by byte-pair merging with a heap and a linked list.

The count of a piece of text is its number of bytes minus the number of merges: no ids are
made. Adjacent symbols whose merge has a rank lie in a heap; the lowest rank (the leftmost of
equals) is popped, the two symbols become one in a linked list, and the new neighbours are
pushed. Entries whose symbols have changed meanwhile are skipped.

Texts are cut into pieces as the vocabulary file's library does it: added tokens first, then
the pattern of byte-level models. Pieces recur, so each task keeps the counts of up to
`REMEMBERED` of them; the memory empties when it is full, which changes no result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LIMIT = 1024
REMEMBERED = 300_000

#: Characters of a text that are cut into pieces at a time, at least.
SLICE = 1 << 20

#: Fixed: how byte-level models cut text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary.

    Printable bytes stand for themselves, the others are numbered upwards from U+0100.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, free = [], 256
    for byte in range(256):
        symbols.append(chr(byte if byte in printable else free))
        free += byte not in printable
    return symbols


class Merges:
    """Merge ranks between symbols, which are numbered: bytes 0 to 255, then results of merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        parts = model["model"]
        pre = model.get("pre_tokenizer") or {}
        if parts["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True):
            raise ValueError(f"{path}: not a byte-level BPE vocabulary")
        if model.get("normalizer") or pre.get("add_prefix_space") or parts.get("ignore_merges"):
            raise ValueError(f"{path}: a setting that these counts do not know")
        for token in model["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError(f"{path}: an added token that takes more than its own text")
        self.added = [t["content"] for t in model["added_tokens"]]
        number = {symbol: i for i, symbol in enumerate(byte_symbols())}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(parts["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            made = number.setdefault(left + right, len(number))
            self.ranks.setdefault((number[left], number[right]), (rank, made))

    def count(self, piece: bytes) -> int:
        """Tokens of one piece."""
        n = len(piece)
        if n < 2:
            return n
        find = self.ranks.get
        symbols = list(piece)
        heap = []
        for i in range(n - 1):
            known = find((symbols[i], symbols[i + 1]))
            if known:
                heap.append((known[0], i, known[1]))
        if not heap:
            return n
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        left_over = n
        while heap:
            rank, i, made = heappop(heap)
            j = after[i]
            # A symbol that was taken up has number -1, one that grew has another rank.
            if j >= n or symbols[i] < 0:
                continue
            known = find((symbols[i], symbols[j]))
            if known is None or known[0] != rank:
                continue
            symbols[i], symbols[j] = made, -1
            left_over -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                known = find((made, symbols[k]))
                if known:
                    heappush(heap, (known[0], i, known[1]))
            h = before[i]
            if h >= 0:
                known = find((symbols[h], made))
                if known:
                    heappush(heap, (known[0], h, known[1]))
        return left_over


class _Counts(dict):
    """Counts of pieces seen so far."""

    def __init__(self, merges: Merges):
        self.merges = merges

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self.merges.count(piece.encode("utf-8"))
        if len(piece) <= 64:
            self[piece] = found
        return found


def slices(text: str, cut: re.Pattern) -> Iterator[str]:
    """Parts of a long text whose pieces are those of the whole text.

    Parts end after a single line feed between characters that are no white space: it is
    a piece of its own, whether or not the text goes on.
    """
    at = 0
    while len(text) - at > SLICE and (found := cut.search(text, at + SLICE)):
        yield text[at : found.end()]
        at = found.end()
    yield text[at:] if at else text


def counter(path: str) -> Callable[[str], int]:
    """A function from text to its number of tokens, with a memory of its own."""
    import regex

    merges = Merges(path)
    counts = _Counts(merges)
    pieces = regex.compile(PATTERN).findall
    added = regex.compile("|".join(map(regex.escape, sorted(merges.added, key=len, reverse=True)))) if merges.added else None
    cut = regex.compile(r"\S\n(?=\S)")
    get = counts.__getitem__

    def plain(text: str) -> int:
        return sum(sum(map(get, pieces(part))) for part in slices(text, cut))

    def count(text: str) -> int:
        if added is None or not any(token in text for token in merges.added):
            return plain(text)
        parts = added.split(text)
        return len(parts) - 1 + sum(map(plain, parts))

    return count


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """`docs` with `n_bytes`, `n_tokens`, `over_limit`, which replace columns of these names.

    `path` is a byte-level BPE vocabulary, at the same place on all executors. Null and empty
    texts have no tokens. Added tokens inside a text count as one, as the library does by
    default; nothing is added at the ends, cut or padded.
    """
    added = ["n_bytes", "n_tokens", "over_limit"]
    own = [c for c in docs.columns if c not in added]
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), "text")
    schema = "row " + named.schema["row"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column("text"):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                n_bytes.append(len(raw))
                n_tokens.append(count(raw.decode("utf-8", "replace")) if raw else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())],
                ["row", *added],
            )

    counted = named.mapInArrow(scan, f"{schema}, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN")
    return counted.select("row.*", *added)
