"""Secrets in texts: keywords first, anchored patterns near them, then checksums."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import edit_rows, map_texts

#: Kinds in the order in which spans that start together are listed.
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("github", "npm", "jwt", "pem")
KINDS = BASE_KINDS + ADDED_KINDS
REDACTED = "[SECRET]"

#: Keywords in lower case, each with the kind whose pattern is tried where it starts.
KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "eyj": "jwt",
    "-----begin ": "pem",
}
PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "npm": re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+"),
    "pem": re.compile(
        r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----([A-Za-z0-9+/=\s]*)-----END \1PRIVATE KEY-----"
    ),
}
#: A run of hexadecimal digits has no keyword; its pattern is the scan itself.
HEX = re.compile(r"[0-9a-f]{24,}")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

Span = tuple[str, int, int]


def base62(number: int) -> str:
    """Six digits of base 62, zeros in front."""
    digits = ""
    for _ in range(6):
        number, digit = divmod(number, 62)
        digits = BASE62[digit] + digits
    return digits


def _checksum(match: re.Match) -> bool:
    """The last six characters are the crc32 of the thirty before them, in base 62."""
    return base62(zlib.crc32(match[1].encode())) == match[2]


def _part(text: str) -> bytes:
    return base64.urlsafe_b64decode(text + "=" * (-len(text) % 4))


def _json_header(match: re.Match) -> bool:
    try:
        header, claims = json.loads(_part(match[1])), json.loads(_part(match[2]))
    except ValueError:
        return False
    return isinstance(header, dict) and "alg" in header and isinstance(claims, dict)


def _der(match: re.Match) -> bool:
    """A key's body is one DER sequence whose stated length is the length of what follows."""
    try:
        body = base64.b64decode("".join(match[2].split()), validate=True)
    except ValueError:
        return False
    if len(body) < 2 or body[0] != 0x30:
        return False
    if body[1] < 0x80:
        return body[1] == len(body) - 2
    size = body[1] & 0x7F
    return 0 < size <= 4 and int.from_bytes(body[2 : 2 + size], "big") == len(body) - 2 - size


CHECKS: dict[str, Callable[[re.Match], bool]] = {
    "assign": lambda m: len(m[2]) >= 6,
    "access": lambda m: len(m[0]) >= 20,
    "github": _checksum,
    "npm": _checksum,
    "jwt": _json_header,
    "pem": _der,
}


class Scanner:
    """Finds the spans of one text."""

    def __init__(self) -> None:
        self._words = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            self._words.add_word(word, (kind, len(word) - 1))
        self._words.make_automaton()

    def spans(self, text: str | None) -> list[Span]:
        """``(kind, start, end)`` in code points, by start and then kind; None has none.

        Per kind, matches are leftmost and don't overlap; one that fails its check is dropped
        with all its characters, so no shorter match is tried in them.
        """
        if not text:
            return []
        # Only A-Z change, so that places stay the same.
        lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        found: list[Span] = []
        after = dict.fromkeys(PATTERNS, 0)
        hits = sorted((end - before, kind) for end, (kind, before) in self._words.iter(lower))
        for start, kind in hits:
            if start < after[kind]:
                continue
            match = PATTERNS[kind].match(text, start)
            if match:
                after[kind] = match.end()
                if CHECKS[kind](match):
                    found.append((kind, start, match.end()))
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row of ``docs``.

    ``spans`` lists ``kind:start:end`` (code points, end exclusive) by start, then kind;
    ``base_sha256`` is the digest of the list of the three base kinds. Spans of the added
    kinds, all with an embedded checksum or structure that holds, come beside them. NULL counts
    as the empty text: no spans, digest of the empty string. Rows that repeat, or lack
    ``doc_id``, are scanned like any other; no rows give none; other columns are ignored.
    """

    def make():
        scanner = Scanner()

        def run(texts):
            columns: list[list] = [[] for _ in range(5)]
            for text in texts:
                spans = scanner.spans(text)
                base = [s for s in spans if s[0] in BASE_KINDS]
                for column, kind in zip(columns, BASE_KINDS):
                    column.append(sum(s[0] == kind for s in base))
                columns[3].append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                columns[4].append(spans_text(spans))
            return columns

        return run

    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_texts(docs.select("doc_id", "text"), make, fields)


def redact(text: str, spans: list[Span], mark: str = REDACTED) -> str:
    """``text`` with each stretch that spans cover, together or alone, replaced by ``mark``."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text``, and ``n_chars`` (if there) counted anew for
    texts that change. Rows without secrets, and all other columns, stay as they are."""

    def make():
        scanner = Scanner()

        def edit(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            changed = {i: redact(t, spans) for i, t in enumerate(texts) if t and (spans := scanner.spans(t))}
            if not changed:
                return batch
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], batch.schema.field("text").type)
            if "n_chars" in columns:
                old = columns["n_chars"].to_pylist()
                new = [len(changed[i]) if i in changed else n for i, n in enumerate(old)]
                columns["n_chars"] = pa.array(new, batch.schema.field("n_chars").type)
            return pa.RecordBatch.from_arrays([columns[n] for n in batch.schema.names], schema=batch.schema)

        return edit

    return edit_rows(docs, make)
