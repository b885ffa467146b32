"""Token ids of whole texts, with a bounded store of chunks that were met before.

A text is cut before every space, and before and after every line break, that a character
other than white space follows. The pre-tokenizer's pattern always starts a new match there:
of a run of white space it takes all but the last character, which then goes to the next word
if it is a space and stands alone if it is a line break. So the ids of the chunks, one after
the other, are the ids of the text. Chunks repeat often and are encoded once per Python
worker; they are found by a hash over the bytes of whole Arrow columns and then compared byte
by byte.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from .common import worker_store

#: Bounds of the stores of chunks and pre-tokens, which then start anew.
STORE_CHUNKS = 1_500_000
STORE_BYTES = 32 << 20
STORE_WORDS = 30_000
#: Bytes of one pass, and of the longest chunk that is stored.
PASS_BYTES = 1 << 18
LONG_CHUNK = 1 << 12

#: Encodes many different chunks: a list of id sequences, one for each.
EncodeMany = Callable[[list[str]], list]

#: ASCII bytes with Unicode's White_Space property, and bytes that other
#: characters with it start with; before these no text is cut.
ASCII_SPACE = (9, 10, 11, 12, 13, 32)
MAYBE_SPACE = (0xC2, 0xE1, 0xE2, 0xE3)
_OTHER = np.ones(256, dtype=bool)
_OTHER[[*ASCII_SPACE, *MAYBE_SPACE]] = False


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row starts and the last ends."""
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, content = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets) or content is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(content, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the chunks of all texts, ascending; empty texts have none."""
    n = len(data)
    marks = np.zeros(n + 1, dtype=bool)
    if n > 1:
        follows = _OTHER[data[1:]]
        # What follows the last byte of a text belongs to another one.
        inner = offsets[1:-1]
        follows[inner[(inner > 0) & (inner < n)] - 1] = False
        line = (data[:-1] == 10) & follows
        marks[: n - 1] = (data[:-1] == 32) & follows | line
        marks[1:n] |= line
    marks[offsets[:-1]] = True
    return np.flatnonzero(marks[:n])


_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    out = np.full(PASS_BYTES + LONG_CHUNK + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Table:
    """Numbers by hash, in open addressing over arrays."""

    def __init__(self, entries: int) -> None:
        self._bits = max(10, (2 * entries).bit_length())
        self._keys = np.zeros(1 << self._bits, dtype=np.uint64)
        self._values = np.zeros(1 << self._bits, dtype=np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none. No key is zero."""
        found = np.full(len(keys), -1, dtype=np.int64)
        open_, slot = np.arange(len(keys)), self._slots(keys)
        while len(open_):
            there = self._keys[slot]
            same = there == keys[open_]
            found[open_[same]] = self._values[slot[same]]
            more = ~same & (there != 0)
            open_, slot = open_[more], (slot[more] + 1) & (len(self._keys) - 1)
        return found

    def add(self, keys: np.ndarray, first: int) -> None:
        """New different keys, numbered from ``first``."""
        open_, slot = np.arange(len(keys)), self._slots(keys)
        while len(open_):
            free = self._keys[slot] == 0
            self._keys[slot[free]] = keys[open_[free]]
            mine = self._keys[slot] == keys[open_]
            self._values[slot[mine]] = first + open_[mine]
            open_, slot = open_[~mine], (slot[~mine] + 1) & (len(self._keys) - 1)


class _Rows:
    """Sequences of different lengths in one growing array."""

    def __init__(self, dtype: type) -> None:
        self.flat = np.zeros(1 << 16, dtype=dtype)
        self.starts = np.zeros(1 << 16, dtype=np.int64)  # and the end of the last
        self.count = 0

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.starts[self.count])
        total, count = used + len(values), self.count + len(lengths)
        while total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while count >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[used:total] = values
        self.starts[self.count + 1 : count + 1] = used + np.cumsum(lengths)
        self.count = count

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``flat`` of all elements of the rows, and the rows' lengths."""
        starts = self.starts[rows]
        lengths = self.starts[rows + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return np.repeat(starts - ends + lengths, lengths) + np.arange(total), lengths


class ChunkEncoder:
    """``encode(texts)`` gives all ids in one array and the number of ids of each text."""

    def __init__(self, encode_many: EncodeMany) -> None:
        self._encode_many = encode_many
        self._up, self._down = _powers(_FACTOR), _powers(_INVERSE)
        self._clear()

    def _clear(self) -> None:
        self._table, self._known, self._ids = _Table(STORE_CHUNKS), _Rows(np.uint8), _Rows(np.uint32)

    def encode(self, texts: list | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``texts`` as a list or a string column; None counts as the empty text."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        data, offsets = text_bytes(column)
        starts = cuts(data, offsets)
        lengths = np.diff(np.append(starts, len(data)))
        parts, sizes, at = [], [], 0
        # Passes end between chunks, wherever texts do; a long chunk is a pass of its own.
        long = np.append(np.flatnonzero(lengths > LONG_CHUNK), len(starts))
        while at < len(starts):
            next_long = int(long[np.searchsorted(long, at)])
            end = int(np.searchsorted(starts, starts[at] + PASS_BYTES))
            end = at + 1 if next_long == at else min(end, next_long)
            piece = data[starts[at] : starts[end - 1] + lengths[end - 1]]
            if next_long == at:
                own = np.asarray(self._encode_many([piece.tobytes().decode()])[0], dtype=np.uint32)
                parts.append(own)
                sizes.append(np.array([len(own)]))
            else:
                ids, counts = self._pass(piece, starts[at:end] - starts[at], lengths[at:end])
                parts.append(ids)
                sizes.append(counts)
            at = end
        ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
        return ids, np.diff(ends[np.searchsorted(starts, offsets)])

    def _pass(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self._known.count > STORE_CHUNKS - len(starts) or self._known.starts[self._known.count] > STORE_BYTES:
            self._clear()
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], out=sums[1:])
        keys = (sums[starts + lengths] - sums[starts]) * self._down[starts]
        keys[keys == 0] = 1
        rows = self._table.find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            unique, first = np.unique(keys[new], return_index=True)
            self._learn(data, unique, starts[new[first]], lengths[new[first]])
            rows[new] = self._table.find(keys[new])
        # The same hash is not enough: compare what was found, byte by byte.
        known = self._known.starts
        other = known[rows + 1] - known[rows] != lengths
        shift = known[rows] - starts
        shift[other] = 0
        there = np.repeat(shift, lengths) + np.arange(len(data))
        other |= np.logical_or.reduceat(self._known.flat[there % len(self._known.flat)] != data, starts)
        if other.any():
            return self._one_by_one(data, starts, lengths)
        places, counts = self._ids.places(rows)
        return self._ids.flat[places], counts

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        content = data.tobytes()
        chunks = [content[s : s + n] for s, n in zip(starts.tolist(), lengths.tolist())]
        sequences = self._encode_many([c.decode() for c in chunks])
        counts = np.fromiter(map(len, sequences), dtype=np.int64, count=len(chunks))
        ids = np.fromiter(chain.from_iterable(sequences), dtype=np.uint32, count=int(counts.sum()))
        self._table.add(keys, self._known.count)
        self._known.add(np.frombuffer(b"".join(chunks), dtype=np.uint8), lengths)
        self._ids.add(ids, counts)

    def _one_by_one(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without the store: for a pass in which two chunks share a hash."""
        content = data.tobytes()
        chunks = [content[s : s + n].decode() for s, n in zip(starts.tolist(), lengths.tolist())]
        sequences = self._encode_many(chunks)
        counts = np.fromiter(map(len, sequences), dtype=np.int64, count=len(chunks))
        return np.fromiter(chain.from_iterable(sequences), dtype=np.uint32, count=int(counts.sum())), counts


#: Marks that end a match of letters and make one of their own; no apostrophe, which may not.
MARKS = frozenset(".,;:!?")


class WordStore:
    """Ids of a chunk from the ids of its pre-tokens, each of which is encoded once."""

    def __init__(self, pattern: str, encode_word: Callable[[str], list[int]]) -> None:
        self._find = regex.compile(pattern).findall
        self._encode_word = encode_word
        self._words: dict[str, list[int]] = {}

    def encode_many(self, chunks: list[str]) -> list:
        if len(self._words) > STORE_WORDS:
            self._words.clear()
        words, encode, find, out = self._words, self._encode_word, self._find, []
        for chunk in chunks:
            # Letters after at most one space are one match, and so are marks after them.
            if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
                out.append(encode(chunk))
                continue
            ids: list[int] = []
            if chunk[-1] in MARKS and chunk[1:-1].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
                found = (chunk[:-1], chunk[-1])
            else:
                found = find(chunk)
            for word in found:
                known = words.get(word)
                if known is None:
                    known = encode(word)
                    if len(word) <= 64:
                        words[word] = known
                ids += known
            out.append(ids)
        return out


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


def library_encoder(vocabulary: str, pattern: str) -> ChunkEncoder:
    """Encoder by the tokenizers library and a byte-level BPE file (path).

    The library's BPE model encodes each match of ``pattern``, the file's own pre-tokenizer,
    once; special tokens' strings count as ordinary text, and none is added. tests/llm holds
    it against the library's encoding of whole texts.
    """
    known = worker_store()  # one encoder for all tasks of a worker
    if ("library", vocabulary, pattern) in known:
        return known["library", vocabulary, pattern]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    model, letters = Tokenizer.from_file(vocabulary).model, byte_letters()
    tokenize = model.tokenize

    space = letters[ord(" ")]

    def encode_word(word: str) -> list[int]:
        if word.isascii() and word[1:].isalpha():
            spelled = space + word[1:] if word[0] == " " else word
            if spelled[0] == space or word.isalpha():
                return [t.id for t in tokenize(spelled)]
        return [t.id for t in tokenize(word.encode().decode("latin-1").translate(letters))]

    store = WordStore(pattern, encode_word)
    known["library", vocabulary, pattern] = ChunkEncoder(store.encode_many)
    return known["library", vocabulary, pattern]
