"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from llm_tables import SMALL, docs_of  # noqa: F401

from tidemark.llm.byte_bpe import BytePairCodec, decode, encode, load_codec

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def peer():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


PARTS = [
    "a", "the", " ", "  ", "\n", "\t", "é", "ß", "ñ", "1", "23", "\x1c", "\x85", "\xa0", "​", "日本", "😀", "'s", "'ll",
    "%%%", "&", "\r", "\x0b", "\x00", "ing", "tion", "﻿", "́", "Ⅷ", "²", "<|endoftext|>",
]


def test_random_texts_encode_like_the_library(peer):
    codec, rng = load_codec(RANKS, PATTERN), random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        ids = codec.encode(text)
        assert ids == peer.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("alphabet", ["a", "abcdefgh", "é", " ", "=", "日本"])
def test_long_pieces(peer, alphabet):
    rng = random.Random(2)
    text = "".join(rng.choice(alphabet) for _ in range(20_000))
    assert load_codec(RANKS, PATTERN).encode(text) == peer.encode_ordinary(text)


def test_small_vocabularies_against_the_definition():
    """Where longest tokens often do not fit: random merges over three letters."""
    rng, compared = random.Random(3), 0
    for _ in range(60):
        tokens = [bytes([b]) for b in range(256)]
        parts = [b"a", b"b", b"c"]
        for _ in range(rng.randint(1, 14)):
            new = rng.choice(parts) + rng.choice(parts)
            if new not in tokens:
                tokens.append(new)
                parts.append(new)
        try:
            codec = BytePairCodec({t: i for i, t in enumerate(tokens)}, r"\w+")
        except ValueError:  # joined from tokens that rank after it
            continue
        for _ in range(60):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            if data not in tokens:
                assert codec.encode_piece(data) == codec._merge(data), (tokens[256:], data)
                compared += 1
    assert compared > 500


def test_a_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError, match="lacks the bytes"):
        BytePairCodec({b"a": 0}, ".")


def test_rows(docs_of, peer):
    long = "word " * 30_000 + "x" * 50_000
    rows = [(1, None), (2, ""), (3, "Hello  world"), (3, "Hello  world"), (4, long), (None, "naïve café")]
    encoded = encode(docs_of(rows, ["token_ids", "decoded"]), RANKS, PATTERN, with_decoded=True)
    assert encoded.columns == ["doc_id", "token_ids", "decoded"]
    got = sorted(((r.doc_id or 0, r.token_ids, bytes(r.decoded)) for r in encoded.collect()), key=str)
    expected = sorted(((i or 0, peer.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=str)
    assert got == expected


def test_decode_of_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [104, 105])], "k long, token_ids array<int>")
    assert {r.k: bytes(r.decoded) for r in decode(df, RANKS, PATTERN).collect()}[1] == b""
    assert {r.k: len(r.decoded) for r in decode(df, RANKS, PATTERN).collect()}[2] == 0


def test_empty_table(docs_of):
    assert decode(encode(docs_of([]), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_query(spark, peer):
    import __spark_entry__ as contract

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = contract.queries()["op3_byte_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = peer.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
