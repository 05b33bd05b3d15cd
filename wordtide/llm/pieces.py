"""SentencePiece encoding and decoding of a byte-pair model, by vectorised merge rounds.

The library merges, over a whole text, the adjacent pair of the best rank, the leftmost of
equals, until no pair of neighbours is a piece. Here the symbols of many words lie in flat
arrays. A round takes the least pair rank of every word (a segmented minimum), merges all
leftmost pairs of that rank at once, and compacts the arrays; words without a pair left are
done. Two things make that exact:

* Words are cut where no piece has the two neighbouring characters side by side, so no merge
  ever crosses a cut. Equal words are encoded once for each slice of text.
* A merge may make a pair that ranks before, or like, the one at hand. Then what lies to the
  right of that merge in its word waits for the next round, as it does one by one.

Runs of spaces are cut into the longest piece of spaces first: their pieces all share one
rank, so they grow from the left (checked against the model when it is loaded).
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wordtide.llm import words as W

SPACE = "▁"
#: What the library shows for the unknown piece.
UNKNOWN = " ⁇ "
#: Characters encoded at a time; a longer text is cut between words.
SLICE = 1 << 20
_NONE = np.int32(2**31 - 1)


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def _text(raw: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that is in no character."""
    codecs.register_error("wordtide-each-byte", _each_byte)
    return raw.decode("utf-8", "wordtide-each-byte")


class Model:
    """Tables of a model, numpy arrays all, as large as its vocabulary.

    Symbols are the pieces, and one for any character that is none.
    """

    def __init__(self, path: str):
        import sentencepiece  # on the driver only: it reads the file, tasks get the tables

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.vocab_size()
        special = [library.is_control(i) or library.is_unknown(i) for i in range(n)]
        as_byte = [library.is_byte(i) for i in range(n)]
        if any(library.is_unused(i) for i in range(n)) or sum(as_byte) != 256:
            raise ValueError("a byte-pair model with byte fallback and no unused pieces is needed")
        if [library.normalize(x) for x in (" a  b ", "ﬁ\t", "")] != [f"{SPACE * 2}a{SPACE * 2}b{SPACE}", f"{SPACE}ﬁ\t", ""]:
            raise ValueError("a model that leaves texts as they are, with a space before, is needed")
        names = [library.id_to_piece(i) for i in range(n)]
        own = {name: i for i, name in enumerate(names) if not special[i] and not as_byte[i]}
        self.end, self.size = library.eos_id(), n
        self.byte_ids = np.array([names.index(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.decoded = [
            b"" if special[i] else bytes([int(name[3:5], 16)]) if as_byte[i] else name.replace(SPACE, " ").encode()
            for i, name in enumerate(names)
        ]
        self.decoded[library.unk_id()] = UNKNOWN.encode()
        self.silent = np.array([special[i] and i != library.unk_id() for i in range(n)])
        self.spaced = frozenset(i for name, i in own.items() if name.startswith(SPACE))

        characters = sorted({c for name in own for c in name})
        if not own.keys() >= set(characters):
            raise ValueError("a model in which every character of a piece is a piece is needed")
        symbol = {c: own[c] for c in characters}
        self.other = n
        self.codes = np.array([ord(c) for c in characters], np.uint32)
        self.symbols = np.array([symbol[c] for c in characters], np.int32)
        # Which characters may stand side by side within a piece.
        index = {c: k for k, c in enumerate(characters)}
        self.beside = np.zeros((len(characters) + 1,) * 2, bool)
        pairs: dict[int, tuple[float, int]] = {}
        width = self.other + 1
        for name, i in own.items():
            for a, b in zip(name, name[1:], strict=False):
                self.beside[index[a], index[b]] = True
            for cut in range(1, len(name)):
                left, right = name[:cut], name[cut:]
                a, b = own.get(left), own.get(right)
                if a is not None and b is not None:
                    pairs[a * width + b] = library.get_score(i), i
        scores = np.array([s for s, _ in pairs.values()])
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        order = np.argsort(np.fromiter(pairs, np.int64, len(pairs)))
        self.pair_keys = np.fromiter(pairs, np.int64, len(pairs))[order]
        self.pair_ranks = ranks[order]
        self.pair_pieces = np.array([i for _, i in pairs.values()], np.int32)[order]
        self._hash_pairs()
        self.run = 0
        self.run = self._space_run(own)

    def _hash_pairs(self) -> None:
        """The pairs in a table of open addresses, four times as large."""
        self.bits = max(4, int(np.ceil(np.log2(4 * max(1, len(self.pair_keys))))))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        at = self._slot(self.pair_keys)
        for i, slot in enumerate(at.tolist()):
            while self.slots[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.slots[slot] = i
        self.slot_keys = np.where(self.slots >= 0, self.pair_keys[np.maximum(self.slots, 0)], -1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _space_run(self, own: dict[str, int]) -> int:
        """The longest piece of spaces, if runs of spaces are always cut into it from the left."""
        longest = max((len(name) for name in own if set(name) == {SPACE}), default=0)
        mixed = any(SPACE in name[1:] and set(name) != {SPACE} for name in own)
        if longest < 2 or mixed:
            return 0
        runs = [np.full(n, ord(SPACE), np.uint32) for n in range(1, 3 * longest + 1)]
        known = [self.merged(*self._as_symbols(run))[0].tolist() for run in runs]
        whole = own[SPACE * longest]
        same = all(known[n - 1] == [whole, *known[n - longest - 1]] for n in range(longest + 1, 3 * longest + 1))
        return longest if same and known[longest - 1] == [whole] else 0

    def _as_symbols(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.symbols_of(codes)[1], np.zeros(len(codes), np.int64)

    def symbols_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index among the known characters (their number for others), and symbol of each."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[at] == codes
        return np.where(known, at, len(self.codes)), np.where(known, self.symbols[at], self.other).astype(np.int32)

    def cuts(self, codes: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Where a word begins: no merge reaches across."""
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.beside[index[:-1], index[1:]]
        if self.run:
            space = codes == ord(SPACE)
            begin = space.copy()
            begin[1:] &= ~space[:-1]
            first = np.maximum.accumulate(np.where(begin, np.arange(len(codes)), 0))
            within = np.arange(len(codes)) - first
            cut |= space & (within > 0) & (within % self.run == 0)
        return cut

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (`_NONE` if they make no piece) and piece of pairs of symbols."""
        keys = left.astype(np.int64) * (self.other + 1) + right
        slot = self._slot(keys)
        rank, piece = np.full(len(keys), _NONE), np.zeros(len(keys), np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self.slot_keys[slot]
            hit = found == keys[open_]
            entry = self.slots[slot[hit]]
            rank[open_[hit]], piece[open_[hit]] = self.pair_ranks[entry], self.pair_pieces[entry]
            on = ~hit & (found >= 0)
            open_, slot = open_[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return rank, piece

    def merged(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, and the word of each; words are neighbours in the input."""
        done_symbols, done_word, done_place = [], [], []
        place = np.arange(len(symbols))
        rank, piece = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], piece[inner] = self.looked_up(symbols[inner], symbols[inner + 1])
        while len(symbols):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.concatenate([begin, [len(word)]]))
            least = np.repeat(np.minimum.reduceat(rank, begin), sizes)
            finished = least == _NONE
            if finished.any():
                done_symbols.append(symbols[finished])
                done_word.append(word[finished])
                done_place.append(place[finished])
                rest = ~finished
                symbols, word, place, rank, piece = symbols[rest], word[rest], place[rest], rank[rest], piece[rest]
                continue
            at = _every_other(np.flatnonzero(rank == least))
            at = at[self._in_turn(symbols, word, rank, piece, at)]
            symbols[at] = piece[at]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[np.maximum(at - 1, 0)] = True
            changed[np.maximum(at - 2, 0)] = True  # the left neighbour, if the one between is gone
            symbols, word, place, rank, piece, changed = (x[kept] for x in (symbols, word, place, rank, piece, changed))
            fresh = np.flatnonzero(changed)
            rank[fresh] = _NONE
            fresh = fresh[fresh + 1 < len(word)]
            fresh = fresh[word[fresh] == word[fresh + 1]]
            rank[fresh], piece[fresh] = self.looked_up(symbols[fresh], symbols[fresh + 1])
        if not done_place:
            return symbols, word
        order = np.argsort(np.concatenate(done_place), kind="stable")
        return np.concatenate(done_symbols)[order], np.concatenate(done_word)[order]

    def _in_turn(self, symbols, word, rank, piece, at) -> np.ndarray:
        """Which of the merges `at` come before any pair that a merge left of them makes."""
        own, new = rank[at], piece[at]
        right = np.minimum(at + 2, len(word) - 1)
        after = np.where((at + 2 < len(word)) & (word[right] == word[at]), symbols[right], self.other)
        left = np.maximum(at - 1, 0)
        before = np.where((at > 0) & (word[left] == word[at]), symbols[left], self.other)
        follows = np.zeros(len(at), bool)
        follows[1:] = (at[1:] - at[:-1] == 2) & (word[at[1:]] == word[at[:-1]])
        before[1:] = np.where(follows[1:], new[:-1], before[1:])
        early = (self.looked_up(new, after)[0] <= own) | (self.looked_up(before, new)[0] <= own)
        if not early.any():
            return np.ones(len(at), bool)
        seen = np.cumsum(early) - early
        begin = np.flatnonzero(np.concatenate([[True], word[at[1:]] != word[at[:-1]]]))
        of_word = np.repeat(seen[begin], np.diff(np.concatenate([begin, [len(at)]])))
        return seen == of_word

    def encoded(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of characters, and the index of the character at which each begins its word."""
        index, symbols = self.symbols_of(codes)
        begin = np.flatnonzero(self.cuts(codes, index))
        end = np.concatenate([begin[1:], [len(codes)]])
        raw = np.ascontiguousarray(codes, "<u4").view(np.uint8)
        offsets = np.concatenate([begin, [len(codes)]]).astype(np.int64) * 4
        words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        which = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.full(int(which.max()) + 1, -1, np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        sizes = end[first] - begin[first]
        chosen = _spread(begin[first], sizes)
        merged, owner = self.merged(symbols[chosen].copy(), np.repeat(np.arange(len(first)), sizes))
        # Characters of no piece become their bytes. Equal words are equal characters, so take them in order.
        lost = merged == self.other
        if lost.any():
            unknown = codes[chosen][symbols[chosen] == self.other]
            spelled = [chr(c).encode("utf-8", "replace") for c in unknown.tolist()]
            lengths = np.ones(len(merged), np.int64)
            lengths[lost] = [len(s) for s in spelled]
            grown = np.repeat(merged.astype(np.int64), lengths)
            owner = np.repeat(owner, lengths)
            spread = np.repeat(lost, lengths)
            grown[spread] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
            merged = grown
        counts = np.bincount(owner, minlength=len(first))
        starts = np.cumsum(counts) - counts
        ids = merged.astype(np.int64)[_spread(starts[which], counts[which])]
        return ids, np.repeat(begin, counts[which])

    def decode(self, ids: np.ndarray) -> str:
        """The text of `ids`, as the library's decode gives it."""
        ids = np.asarray(ids, np.int64)
        # Bytes on both sides of a begin or end id are no one character.
        runs = [run[~self.silent[run]] for run in np.split(ids, np.flatnonzero(self.silent[ids]))]
        runs = [run for run in runs if len(run)]
        text = "".join(_text(b"".join(map(self.decoded.__getitem__, run.tolist()))) for run in runs)
        return text[1:] if runs and int(runs[0][0]) in self.spaced else text

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without begin and end."""
        return np.concatenate([*(ids for ids in self.slices(text)), np.zeros(0, np.int64)]).tolist()

    def slices(self, text: str, size: int = SLICE) -> Iterator[np.ndarray]:
        """Ids of consecutive slices of a text of about `size` characters, cut between words."""
        for codes in self._cut(text, size):
            yield self.encoded(codes)[0]

    def _cut(self, text: str, size: int) -> Iterator[np.ndarray]:
        if not text:
            return
        codes = np.frombuffer((SPACE + text.replace(" ", SPACE)).encode("utf-32-le", "replace"), "<u4")
        at, reach = 0, size
        while at + reach < len(codes):
            piece = codes[at : at + reach]
            # Not inside a run of spaces, which is cut from its own beginning.
            index = self.symbols_of(piece)[0]
            inside = np.flatnonzero(~self.beside[index[:-1], index[1:]]) + 1
            if len(inside):
                yield piece[: inside[-1]]
                at, reach = at + int(inside[-1]), size
            else:
                reach *= 2
        yield codes[at:]


def _every_other(at: np.ndarray) -> np.ndarray:
    """Of neighbouring places the first, third, and so on: the leftmost that do not overlap."""
    if not len(at):
        return at
    begins = np.concatenate([[True], np.diff(at) != 1])
    first = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - first) % 2 == 0]


def _spread(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """`begin[i], begin[i] + 1, ...` of `sizes[i]` places each, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)


def _texts(column: pa.Array) -> list[str]:
    raw = column.cast(pa.large_binary()).to_pylist()
    return [(value or b"").decode("utf-8", "replace") for value in raw]


class Coder:
    """Ids and decoded texts of Arrow columns of texts, a slice of characters at a time."""

    def __init__(self, model: Model):
        self.model = model
        self.names = pa.array([f"{i} ".encode() for i in range(model.size)], pa.large_binary())
        self.spelled = pa.array(model.decoded, pa.large_binary())

    def groups(self, texts: list[str]) -> Iterator[list[tuple[int, np.ndarray, bool]]]:
        """Slices of texts, together of about `SLICE` characters: text, characters, whether it begins one."""
        held, size = [], 0
        for i, text in enumerate(texts):
            begins = True
            for codes in self.model._cut(text, SLICE):
                if held and size + len(codes) > SLICE:
                    yield held
                    held, size = [], 0
                held.append((i, codes, begins))
                size += len(codes)
                begins = False
        if held:
            yield held

    def digests(self, texts: list[str], end: bool = True) -> Iterable[tuple[int, str, str]]:
        """Number of ids, digest of the ids and digest of the decoded text, for each text."""
        model = self.model
        counts = [0] * len(texts)
        by_id, by_text = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
        tail = [b""] * len(texts)
        for group in self.groups(texts):
            bounds = np.cumsum([len(codes) for _, codes, _ in group])
            ids, where = self._apart([codes for _, codes, _ in group])
            cut = np.searchsorted(where, bounds)
            names = _bytes_of(self.names, ids)
            spelled = _bytes_of(self.spelled, ids)
            at = 0
            for (i, _, begins), to in zip(group, cut.tolist(), strict=True):
                counts[i] += to - at
                own = names(at, to)
                by_id[i].update(tail[i] + own[:-1])
                tail[i] = own[-1:]
                raw = spelled(at, to)
                if begins and to > at and int(ids[at]) in model.spaced:
                    raw = raw[1:]
                by_text[i].update(_text(raw).encode())
                at = to
        last = str(model.end).encode() if end else b""
        for i in range(len(texts)):
            by_id[i].update((tail[i] if end else b"") + last)
            yield counts[i] + end, by_id[i].hexdigest(), by_text[i].hexdigest()

    def _apart(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of several runs of characters, kept apart by a character that belongs to no piece."""
        model = self.model
        mark = np.array([0x10FFFF], np.uint32)
        joined = np.concatenate([x for part in parts for x in (part, mark)])
        ids, where = model.encoded(joined)
        sizes = np.array([len(p) + 1 for p in parts])
        part = np.repeat(np.arange(len(parts)), sizes)[where]
        marks = np.cumsum(sizes) - 1
        own = ~np.isin(where, marks)
        return ids[own], where[own] - part[own]


def _bytes_of(values: pa.Array, ids: np.ndarray):
    """The bytes of `values` at `ids[a:b]`, end to end, as a function of a and b."""
    taken = values.take(pa.array(ids))
    buffers = taken.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
    data = buffers[2]
    return lambda a, b: data.slice(int(offsets[a]), int(offsets[b] - offsets[a])).to_pybytes() if b > a else b""


def round_trips(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` of each row of `docs`.

    Each whole text is encoded, with an end id unless `end` is false, and its ids are decoded.
    `ids_sha256` is of the decimal ids joined by one space, `decoded_sha256` of the decoded text
    in UTF-8. Null texts are empty; a null `doc_id` stays null; repeated rows give repeated rows;
    other columns are not read. Bytes that are no UTF-8 count as U+FFFD. There is no shuffle.
    """
    tables = docs.sparkSession.sparkContext.broadcast(Model(path))  # as large as the vocabulary

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(tables.value)
        for batch in W.portions(batches):
            found = list(coder.digests(_texts(batch.column("text")), end))
            n, ids, texts = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(texts)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        coded, f"doc_id {kind}, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
    )


def ids_of(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """`doc_id, ids` (an array): the encoding itself. Same rules as `round_trips`."""
    tables = docs.sparkSession.sparkContext.broadcast(Model(path))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tables.value
        last = [model.end] if end else []
        for batch in W.portions(batches):
            ids = [model.encode(text) + last for text in _texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(coded, f"doc_id {kind}, ids ARRAY<INT>")


def texts_of(rows: DataFrame, path: str) -> DataFrame:
    """`doc_id, text` of `doc_id, ids`: decoding. Null ids give an empty text, ids outside the vocabulary an error."""
    tables = rows.sparkSession.sparkContext.broadcast(Model(path))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tables.value
        for batch in batches:
            texts = [model.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, text STRING")
