"""Tokenizer parity and round trips; phrase fingerprints and edits against brute force."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from affinia.llm import phrases, pieces

TEXTS = [
    "", " ", "  two  spaces ", "a", "Hello, world!\nNext line\r\n\ttabbed", "naïve Übergröße ﬁne ½", "日本語のテキスト",
    "emoji 🙂🙂 and \x00 zero", "▁mark ▁▁ marks", "<s> </s> <unk> <0x0A>", "x" * 3000, "word " * 2000, "\n\n\n", "\n a",
    "a\n b\n\n  c", " ", "http://a.b/c?d=e&f#g 12345.678e-9",
]


def random_texts(n=300):
    rng = random.Random(4)
    alphabet = "abcdefghij  \n\t▁éß漢🙂.,<>0x"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_codec_gives_the_ids_of_the_library():
    data = pieces.load()
    codec = pieces.Codec(data)
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = TEXTS + random_texts()
    assert codec.by_word
    assert codec.encode(texts) == own.encode(texts)
    whole = [e.ids for e in codec.whole.encode_batch_fast(texts, add_special_tokens=False)]
    assert whole == own.encode(texts)
    back = codec.decode(codec.encode(texts))
    assert back == [t.replace("▁", " ") for t in texts]
    assert all(trips and same for _, trips, same in codec.verified(texts))


def test_the_word_table_begins_anew():
    codec = pieces.Codec(pieces.load())
    codec.cache = 5
    texts = random_texts(40)
    first = [codec.encode([t])[0] for t in texts]
    assert first == codec.reference(texts)


def test_runs_are_cut_where_no_piece_reaches():
    codec = pieces.Codec(pieces.load())
    assert codec.runs("One, two.\n 3") == ["▁One", ",", "▁two", ".\n", "▁3"]
    apart = pieces._apart(codec.spec)
    for text, _, kind in codec.spec.pieces:
        if kind == pieces.NORMAL:
            inner = text.replace("▁", "")
            assert all(c in apart for c in inner) or not any(c in apart for c in inner)


def test_a_difference_is_reported(monkeypatch):
    codec = pieces.Codec(pieces.load())
    monkeypatch.setattr(codec, "reference", lambda texts: [[1]] * len(texts))
    assert codec.verified(["some words"])[0][1:] == (True, False)


def unigram_model() -> bytes:
    """A tiny unigram model, written field by field."""
    import struct

    def field(number, kind, value):
        return bytes([number << 3 | kind]) + value

    def text(number, value):
        return field(number, 2, bytes([len(value)]) + value)

    listed = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -3.0, 1), ("▁ab", -3.5, 1), ("ba", -6.0, 1)]
    out = b""
    for piece, score, kind in listed:
        body = text(1, piece.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind]))
        out += text(1, body)
    out += text(2, field(3, 0, b"\x01"))
    return out + text(3, text(1, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x01") + field(5, 0, b"\x01"))


def test_unigram_models_too():
    data = unigram_model()
    codec = pieces.Codec(data)
    texts = ["ab", "aab ab", " b  a ", "", "baba abba"]
    assert codec.spec.kind == pieces.UNIGRAM and not codec.by_word
    assert codec.encode(texts) == codec.reference(texts)


def test_token_queries(spark):
    texts = [None, *TEXTS]
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, ids string")
    own = sentencepiece.SentencePieceProcessor(model_proto=pieces.load())
    got = sorted(pieces.token_digest(docs).collect())
    want = [own.encode(t or "") for t in texts]
    assert [(r.n_tokens, r.ids_sha256) for r in got] == [(len(w), hashlib.sha256(np.array(w, "<i4").tobytes()).hexdigest()) for w in want]
    assert all(r.round_trip and r.parity for r in got)
    tokens = pieces.encode(docs)
    assert tokens.columns == ["doc_id", "ids", "n_tokens"]
    assert [r.ids for r in sorted(tokens.collect())] == want
    back = sorted(pieces.decode(tokens).select("doc_id", "text").collect())
    assert [r.text for r in back] == [(t or "").replace("▁", " ") for t in texts]
    assert pieces.token_digest(docs.limit(0)).collect() == [] and pieces.encode(docs.limit(0)).collect() == []


def brute_phrases(text):
    words = text.encode("utf-8").split()
    if any(len(w) > 16 for w in words):
        words = [w[i : i + 8] for w in words for i in range(0, len(w), 8)]
    known, current = set(), ()
    for w in words:
        current += (w,)
        if current not in known:
            known.add(current)
            current = ()
    return known


def test_phrases_are_those_of_the_parse():
    rng = random.Random(6)
    for _ in range(60):
        text = " ".join(rng.choice("a b c dd eee".split()) for _ in range(rng.randrange(200)))
        assert len(phrases.phrases(text)) == len(brute_phrases(text))
    assert len(phrases.phrases("x" * 1000)) == len(brute_phrases("x" * 1000))


def test_likeness_estimates_the_share_of_common_phrases():
    rng = random.Random(7)
    errors = []
    for _ in range(40):
        a = [rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(600)]
        b = a[: rng.randrange(600)] + [rng.choice("xyz") + str(rng.randrange(50)) for _ in range(300)]
        a, b = " ".join(a), " ".join(b)
        p, q = brute_phrases(a), brute_phrases(b)
        errors.append(phrases.likeness(phrases.signature(a), phrases.signature(b)) - len(p & q) / len(p | q))
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.2
    assert phrases.likeness(phrases.signature(""), phrases.signature(" \n")) == 1.0
    assert phrases.likeness(phrases.signature(""), phrases.signature("a")) == 0.0


def brute_rows(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        other = text[: len(text) - half] + following[:half]
        a, b, c = (phrases.signature(t) for t in (text, other, following))
        sha = hashlib.sha256(other.encode()).hexdigest()
        out.append((doc_id, len(text), sha, a.hex(), b.hex(), phrases.likeness(a, b), phrases.likeness(a, c)))
    return sorted(out)


@pytest.mark.parametrize("n", [1, 2, 90])
def test_fingerprints_of_edits(spark, n):
    rng = random.Random(n)
    words = "the quick brown fox é 漢字 jumps".split()
    ids = rng.sample(range(-500, 500), n)
    rows = [(i, rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(1, 80)))])) for i in ids]
    docs = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, part int, fingerprint string")
    got = phrases.fingerprints_with_edits(docs.repartition(3)).collect()
    assert sorted(map(tuple, got)) == brute_rows(rows)


def test_fingerprints_of_repeated_and_missing_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c d"), (None, "e f"), (None, None), (5, "g")]
    got = phrases.fingerprints_with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert phrases.fingerprints_with_edits(spark.createDataFrame([], "doc_id long, text string")).collect() == []
