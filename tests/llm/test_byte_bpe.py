"""Byte-level BPE against the tiktoken library: whole texts, stitched chunks, round trips."""

import hashlib
import random

import numpy as np
import pytest

from affinia.llm import byte_bpe

SCHEMA = "doc_id long, text string, ids string, _key string, n_tokens int"


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.load())


def texts():
    rng = random.Random(3)
    parts = ["don't", "we'll", " I've", "'re", " naïve", "日本語", " ", "  ", "\n\n", "\r\n", "\t", "!?", "...", "1234", "½", "é", "😀", "\x1c", "\x00", "_", "ſ", "'S", "a" * 30]
    out = [None, "", " ", "\n", "a", "'", "x" * 3000, " " * 2000 + "b", "ab " * 900, "'ll" * 700, "́" * 1500, "9" * 2500]
    out += ["".join(rng.choice(parts) + rng.choice(["", " ", "word"]) for _ in range(rng.randrange(2, 900))) for _ in range(60)]
    out += [rng.choice(["word ", "'re ", " \n"]) * 300 + "z" * 1700 + rng.choice([" tail", "!", "\n\n "]) * 400 for _ in range(6)]
    return out


def digest(codec, text):
    ids = codec.encoding.encode_ordinary(text or "")
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("size, overlap", [(1 << 15, 1 << 10), (200, 40), (64, 16)])
def test_digests_equal_the_library(spark, codec, size, overlap):
    found = texts()
    rows = [(i, t, "a", "b", 1) for i, t in enumerate(found)] + [(3, found[20], "a", "b", 1)] * 2 + [(None, found[30], "c", "d", 0)]
    got = byte_bpe.token_digest(spark.createDataFrame(rows, SCHEMA), size=size, overlap=overlap).collect()
    want = [(r[0], *digest(codec, r[1])) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_chunks_without_a_common_boundary_grow(spark, codec):
    rows = [("long", "x" * 5000 + " end"), ("words", "some words " * 500)]
    parts = byte_bpe.encoded_chunks(spark.createDataFrame(rows, "key string, text string"), byte_bpe.load(), 100, 20).collect()
    for key, text in rows:
        mine = sorted((r.at, bytes(r.ids)) for r in parts if r.key == key)
        assert np.frombuffer(b"".join(x for _, x in mine), "<u4").tolist() == codec.encoding.encode_ordinary(text)
    assert len([r for r in parts if r.key == "words"]) > 50 > len([r for r in parts if r.key == "long"])


def test_boundaries_shared_once_are_shared_for_good(codec):
    rng = random.Random(8)
    for text in filter(None, texts()):
        whole = set(codec.boundaries(text).tolist())
        at = rng.randrange(len(text))
        own = {at + int(x) for x in codec.boundaries(text[at:])}
        common = min(whole & own)
        assert {x for x in whole if x >= common} == {x for x in own if x >= common}


def test_encode_and_decode_give_the_text_again(spark, codec):
    rows = [(i, t, "a", "b", 1) for i, t in enumerate(texts())]
    tokens = byte_bpe.encode(spark.createDataFrame(rows, SCHEMA), size=300, overlap=50)
    assert tokens.columns == ["doc_id", "_key", "ids", "n_tokens"]
    back = {r.doc_id: r for r in byte_bpe.decode(tokens).collect()}
    for i, text, *_ in rows:
        assert back[i]["ids"] == codec.encoding.encode_ordinary(text or "") and back[i]._key == "b"
        assert bytes(back[i]["bytes"]).decode() == (text or "") and back[i].n_tokens == len(back[i]["ids"])


def test_every_character_is_split_like_the_library(codec):
    for point in [*range(0x3000), *range(0x1F000, 0x1FB00)]:
        text = f"a{chr(point)}1{chr(point)} b"
        assert np.frombuffer(codec.encode(codec.pretokens(text)), "<u4").tolist() == codec.encoding.encode_ordinary(text)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.token_digest(empty).collect() == []
    assert byte_bpe.decode(byte_bpe.encode(empty)).collect() == []
