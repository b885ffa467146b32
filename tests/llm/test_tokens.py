"""Both encoders against the libraries, on texts made to break cutting at white space."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import bpe_prefix, tokens
from barloom.llm.queries import PATTERN, RANKS, VOCABULARY

NASTY = [
    "",
    "a" * 5000,
    " " * 1000 + "x",
    "\n\n \n a   b\t\tc\x85d\x1c e  ",
    "<|endoftext|> hi 's 'S don't  ''s 'll",
    "🎉漢字かな 한국어 é́ ñ 　 x​",
    "ab" * 3000,
    "1234567890 $$$ *** ### " * 50,
    "\r\n\r\nfoo\r\n  bar  ",
    "²Ⅷ5 _x_ ſ K",
]
ALPHABET = st.text(alphabet="ab c\n\t'tslé1.漢  🎉_", max_size=80)


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def plain():
    ranks = bpe_prefix.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def parts(encoder, texts):
    ids, counts = encoder.encode(texts)
    return [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]


def test_texts_are_cut_before_no_white_space():
    spaces = [chr(i).encode() for i in range(0x110000) if regex.match(r"\s", chr(i) if not 0xD800 <= i < 0xE000 else "x")]
    assert {s[0] for s in spaces if len(s) == 1} == set(tokens.ASCII_SPACE)
    assert {s[0] for s in spaces if len(s) > 1} == set(tokens.MAYBE_SPACE)


def chunks(texts):
    data, offsets = tokens.text_bytes(pa.array(texts, pa.string()))
    starts = tokens.cuts(data, offsets).tolist()
    return [data[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(data)])]


def test_cuts():
    assert chunks(["a b\nc", None, "", " d  e \n", "\n\nf\xa0 é", " \xa0"]) == [
        b"a", b" b", b"\n", b"c", b" d ", b" e \n", b"\n", b"\n", b"f\xc2\xa0", b" \xc3\xa9", b" \xc2\xa0",
    ]
    assert chunks([]) == chunks([None, ""]) == []


def test_chunks_with_one_hash(plain, monkeypatch):
    """Nothing depends on hashes being different."""
    monkeypatch.setattr(tokens.ChunkEncoder, "_clear", lambda self: _same_hash(self))
    encoder = tokens.ChunkEncoder(lambda chunks: [plain(c) for c in chunks])
    texts = ["some words and others", "words some", None, "x"]
    assert parts(encoder, texts) == [plain(t or "") for t in texts]


def _same_hash(encoder):
    encoder._table, encoder._known, encoder._ids = tokens._Table(100), tokens._Rows(np.uint8), tokens._Rows(np.uint32)
    encoder._up = np.zeros_like(encoder._up)


def test_long_chunks_and_slices(plain):
    encoder = bpe_prefix.text_encoder(RANKS, PATTERN).chunks
    texts = ["w " * 3, "x" * (tokens.LONG_CHUNK + 5) + " y", "z", "é" * tokens.LONG_CHUNK, None, "end of it " * 300_000]
    assert parts(encoder, texts) == [plain(t or "") for t in texts]
    column = pa.array(["no", *texts[:3], "no"])
    assert parts(encoder, column.slice(1, 3)) == [plain(t) for t in texts[:3]]


def test_library_encoder(whole):
    assert parts(tokens.library_encoder(VOCABULARY, PATTERN), [*NASTY, None]) == [*map(whole, NASTY), []]


def test_prefix_encoder(plain):
    encoder = bpe_prefix.text_encoder(RANKS, PATTERN)
    got = parts(encoder.chunks, [*NASTY, None])
    assert got == [*map(plain, NASTY), []]
    for text, ids in zip(NASTY, got):
        assert encoder.bpe.decode(np.array(ids, dtype=np.int64)) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, max_size=4))
def test_any_text(texts):
    ranks = bpe_prefix.text_encoder(RANKS, PATTERN)
    plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.bpe.ranks, special_tokens={})
    want = [plain.encode_ordinary(t) for t in texts] or [[]]
    assert parts(ranks.chunks, texts) == want
    assert parts(tokens.library_encoder(VOCABULARY, PATTERN), texts) == want


def test_stores_start_anew(plain, monkeypatch):
    monkeypatch.setattr(tokens, "STORE_CHUNKS", 12)
    monkeypatch.setattr(tokens, "STORE_WORDS", 3)
    monkeypatch.setattr(tokens, "PASS_BYTES", 10)
    encoder = bpe_prefix.TextEncoder(bpe_prefix.read_ranks(RANKS), PATTERN)
    texts = [f"some words {i} and others {i * i}" for i in range(30)]
    assert parts(encoder.chunks, texts) == [plain(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_edits(data):
    bpe = bpe_prefix.text_encoder(RANKS, PATTERN).bpe
    piece = st.binary(max_size=40) | st.text(alphabet="helo wrd", max_size=60).map(str.encode)
    own = bpe_prefix.EditableEncoding(bpe, data.draw(piece))
    for _ in range(6):
        if data.draw(st.booleans()):
            own.append(data.draw(piece))
        else:
            start = data.draw(st.integers(0, len(own.text)))
            end = data.draw(st.integers(start, len(own.text)))
            own.replace(start, end, data.draw(piece))
        assert own.ids == bpe.encode(own.text)


def test_an_edit_is_local():
    bpe = bpe_prefix.text_encoder(RANKS, PATTERN).bpe
    own = bpe_prefix.EditableEncoding(bpe, b"some words and others " * 400)
    assert own.replace(4000, 4004, b"x") < 500
    assert own.ids == bpe.encode(own.text)


def test_round_trip_of_the_table(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = bpe_prefix.round_trip(docs, RANKS, PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(plain(texts[r.doc_id]), dtype="<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark, plain):
    rows = [(1, None), (2, ""), (3, "x " * 100_000), (4, "a\n b"), (4, "a\n b"), (None, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS n_tokens")
    found = bpe_prefix.round_trip(frame, RANKS, PATTERN)
    got = sorted(((r.doc_id, r.n_tokens) for r in found.collect()), key=repr)
    assert got == sorted(((i, len(plain(t or ""))) for i, t in rows), key=repr)
    ids = bpe_prefix.encode_texts(frame, RANKS, PATTERN)
    back = bpe_prefix.decode_ids(ids, RANKS, PATTERN).collect()
    assert sorted((bytes(r.content) for r in back)) == sorted((t or "").encode() for _, t in rows)
    empty = frame.limit(0)
    assert bpe_prefix.round_trip(empty, RANKS, PATTERN).count() == 0
    assert bpe_prefix.encode_texts(empty, RANKS, PATTERN).count() == 0


def test_bytes_have_letters():
    letters = tokens.byte_letters()
    assert len(set(letters.values())) == 256
    assert letters[ord("a")] == "a" and letters[ord(" ")] == "Ġ"
    assert public_tokenizers.path("byte_bpe_50k.json") == VOCABULARY
