"""Byte-level BPE by dynamic programming over prefixes.

Byte-pair encoding has a property that allows encoding without a merge queue: for every
prefix of a byte string the last token of that prefix's encoding is unique. A token t that
ends at position i is that token if and only if the encoding of what precedes it ends in a
token u after which t may stand, that is if the pair (u, t) would not have been merged
differently. One table of last tokens therefore holds the encodings of all prefixes: text
can be appended without touching it, and after an edit it is computed anew only until it
agrees with the old one again.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts, worker_store
from .tokens import ChunkEncoder, WordStore

NEVER = 1 << 62
#: Bound of a worker's store of checked pairs.
STORE_PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class PrefixBpe:
    """Encodes byte strings (one pre-token each) by a rank table; decodes ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self._merged: dict[tuple[int, int], int] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                left, right = self._last_merge(token, rank)
                self._merged[left, right] = rank
                self._halves[rank] = (left, right)
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self._pairs: dict[int, bool] = {}
        size = max(ranks.values()) + 1
        table = [b""] * size
        for token, rank in ranks.items():
            table[rank] = token
        self._bytes = np.frombuffer(b"".join(table), dtype=np.uint8)
        self._ends = np.cumsum([len(t) for t in table])
        self._lengths = np.array([len(t) for t in table])
        self._sizes = [len(t) for t in table]
        self._ending = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._ending.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self._ending.make_automaton()

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens that make ``token``: what merges of lower rank leave of it."""
        parts = [self.ranks[token[i : i + 1]] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((self._merged.get(p, NEVER), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best >= rank:
                raise ValueError(f"no merges lead to the token of rank {rank}")
            parts[at : at + 2] = [best]
        return parts[0], parts[1]

    def _edge(self, token: int, side: int, store: dict) -> list:
        """Tokens at one edge of ``token`` while it is put together, each with the rank at
        which it goes into the next."""
        found = store.get(token)
        if found is None:
            found, now, then = [], token, NEVER
            while True:
                found.append((now, then))
                if now not in self._halves:
                    break
                now, then = self._halves[now][side], now
            found.reverse()
            store[token] = found
        return found

    def _check(self, u: int, t: int) -> bool:
        """Whether ``t`` may stand right after ``u``: no merge across their border comes
        before those that build them. Equal ranks merge from the left."""
        left, right = self._edge(u, 1, self._right), self._edge(t, 0, self._left)
        i = j = 0
        while True:
            (a, until_a), (b, until_b) = left[i], right[j]
            across = self._merged.get((a, b), NEVER)
            if across < until_a and across <= until_b and across != NEVER:
                return False
            if until_a == until_b == NEVER:
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1

    def extend(self, last: list[int], text: bytes, end: int | None = None) -> None:
        """Add the last tokens of the prefixes of ``text`` that ``last`` does not have yet.

        ``last[i - 1]`` belongs to the prefix of i bytes. An automaton gives the tokens that
        end at each position, longest first.
        """
        at, pairs, check = len(last), self._pairs, self._check
        stop = len(text) if end is None else end
        if len(pairs) > STORE_PAIRS:
            pairs.clear()
        last += [-1] * (stop - at)
        first = max(0, at - self.longest)
        for i, (t, before) in self._ending.iter(text[first:stop].decode("latin-1")):
            i += first
            if i < at or last[i] >= 0 or i < before:
                continue
            if i > before:
                key = last[i - before - 1] << 32 | t
                good = pairs.get(key)
                if good is None:
                    pairs[key] = good = check(key >> 32, t)
                if not good:
                    continue
            last[i] = t

    def walk(self, last: list[int]) -> list[int]:
        """Ids of the whole text from its table of last tokens."""
        ids, i, sizes = [], len(last), self._sizes
        while i:
            t = last[i - 1]
            ids.append(t)
            i -= sizes[t]
        ids.reverse()
        return ids

    def encode(self, text: bytes) -> list[int]:
        whole = self.ranks.get(text)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(last, text)
        return self.walk(last)

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self._lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self._ends[ids] - ends, lengths) + np.arange(total)
        return self._bytes[places].tobytes()


class EditableEncoding:
    """The encoding of one byte string that grows and changes."""

    def __init__(self, bpe: PrefixBpe, text: bytes = b"") -> None:
        self._bpe, self.text, self._last = bpe, b"", []
        self.append(text)

    @property
    def ids(self) -> list[int]:
        return self._bpe.walk(self._last)

    def append(self, more: bytes) -> None:
        self.text += more
        self._bpe.extend(self._last, self.text)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of ``text[start:end]``; how many prefixes were computed.

        An entry depends on the ``longest`` bytes and entries before it, so once that many
        in a row agree with the old table, the rest of it holds.
        """
        old, shift = self._last, len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        last = old[:start]
        step = self._bpe.longest
        self._bpe.extend(last, self.text, start + len(new))
        while len(last) < len(self.text):
            at = len(last)
            self._bpe.extend(last, self.text, min(at + step, len(self.text)))
            if last[at:] == old[at - shift : len(last) - shift] and len(last) - at == step:
                break
        computed = len(last) - start
        self._last = last + old[len(last) - shift :]
        return computed


class TextEncoder:
    """Encodes whole texts: each match of ``pattern`` separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.bpe = PrefixBpe(ranks)
        store = WordStore(pattern, lambda word: self.bpe.encode(word.encode()))
        self.chunks = ChunkEncoder(store.encode_many)


def text_encoder(vocabulary: str, pattern: str) -> TextEncoder:
    """The worker's encoder for a rank file and a pattern of pre-tokens."""
    key, known = ("prefix", vocabulary, pattern), worker_store()
    if key not in known:
        known[key] = TextEncoder(read_ranks(vocabulary), pattern)
    return known[key]


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``docs(doc_id, text)`` with ``ids array<int>`` in place of the text."""

    def make():
        encoder = text_encoder(vocabulary, pattern).chunks

        def run(texts):
            ids, counts = encoder.encode(texts)
            return [[part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] if len(texts) else []]

        return run

    return map_texts(docs.select("doc_id", "text"), make, "ids array<int>", as_column=True)


def decode_ids(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``encoded(doc_id, ids)`` with ``content binary`` in place of the ids."""

    def make():
        bpe = text_encoder(vocabulary, pattern).bpe

        def run(ids):
            return [[bpe.decode(np.array(i or [], dtype=np.int64)) for i in ids]]

        return run

    return map_texts(encoded.select("doc_id", "ids"), make, "content binary", text="ids", drop=("ids",))


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row of ``docs``.

    The digest of the ids is over little-endian unsigned 32-bit integers, that of the content
    over the bytes which the ids decode to. NULL counts as the empty text (no ids). Rows that
    repeat come back as often; rows without ``doc_id`` too; no rows give none. Texts are
    encoded whole; memory is bounded by the longest text. Other columns are ignored.
    """

    def make():
        encoder = text_encoder(vocabulary, pattern)

        def run(texts):
            ids, counts = encoder.chunks.encode(texts)
            lengths, id_digests, digests = [], [], []
            at = 0
            for n in counts.tolist():
                own = ids[at : at + n]
                at += n
                lengths.append(n)
                id_digests.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                digests.append(hashlib.sha256(encoder.bpe.decode(own)).hexdigest())
            return [lengths, id_digests, digests]

        return run

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs.select("doc_id", "text"), make, fields, as_column=True)
