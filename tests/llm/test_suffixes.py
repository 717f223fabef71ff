"""Removal of repeated 200-byte strings and the deep-shallow sort against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from affinia.llm import suffixes

SCHEMA = "doc_id long, text string, n_chars long, text_key string, spans int, lo int"


def brute(texts, length=200):
    whole = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + length] for b in whole for i in range(len(b) - length + 1))
    out = []
    for b in whole:
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i] += 1
                gone[min(i + length, len(b))] -= 1
        out.append(np.cumsum(gone)[: len(b)] > 0)
    return out


def digest(texts, length=200):
    rows = []
    for t, gone in zip(texts, brute(texts, length)):
        b = np.frombuffer((t or "").encode(), np.uint8)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        rows.append((len(b), int(gone.sum()), runs, hashlib.sha256(b[~gone].tobytes()).hexdigest()))
    return rows


def corpus(seed=3):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [prose(n) for n in (150, 198, 199, 200, 201, 260, 400, 900)]
    texts = [None, "", "short", "a" * 199, "b" * 200, "c" * 201, "ab" * 700, prose(3000)]
    for i in range(60):
        texts.append("".join(prose(rng.randrange(120)) + rng.choice(shared) for _ in range(rng.randrange(1, 4))) + prose(30))
    for _ in range(25):  # near copies
        t = list(texts[7])
        for _ in range(rng.randrange(1, 8)):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        texts.append("".join(t))
    return [*texts, texts[20], texts[20], "z" * 5000, prose(90_000)]


@pytest.mark.parametrize("options", [{}, {"group": 3}, {"shallow": 8}])
def test_equals_brute_force(spark, options):
    texts = corpus()
    rows = [(i, t, 1, "k", 2, 3) for i, t in enumerate(texts)]
    got = suffixes.removal_digest(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == digest(texts)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    texts = corpus(8)[:40]
    pieces = [np.frombuffer((t or "").encode(), np.uint8) for t in texts]
    import pyarrow as pa

    seen = [[] for _ in texts]
    for chunk in suffixes._pieces(pa.array([p.tobytes() for p in pieces], pa.binary()), 200):
        piece, _, lo, hi, _, _ = suffixes.contexts([p for _, _, p in chunk])
        for i, a, b in zip(piece, lo, hi):
            row, base, _ = chunk[i]
            seen[row] += range(base + a, base + b + 1)
    assert [sorted(s) for s in seen] == [list(range(len(p) - 199)) for p in pieces]


def test_strip_returns_the_same_columns(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 1, "k", 2, 3) for i, t in enumerate(texts)], SCHEMA)
    got = suffixes.strip_repeats(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    for i, (t, gone) in enumerate(zip(texts, brute(texts))):
        b = np.frombuffer((t or "").encode(), np.uint8)
        left = b[~gone].tobytes().decode("utf-8", "ignore")
        if gone.any() and not left:
            assert i not in rows
        else:
            assert rows[i].text == (t if t is None else left)
            assert rows[i].n_chars == (None if t is None else len(left))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffixes.removal_digest(empty).collect() == []
    assert suffixes.strip_repeats(empty).collect() == []


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_blind_trie_sorts():
    rng = random.Random(2)
    for _ in range(300):
        strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(1, 30))]
        order, lengths = suffixes.blind_trie_order(strings)
        ordered = [strings[i] for i in order]
        assert sorted(order) == list(range(len(strings))) and ordered == sorted(strings)
        assert lengths[0] == 0 and lengths[1:] == [common(a, b) for a, b in zip(ordered, ordered[1:])]


@pytest.mark.parametrize("shallow", [8, 16, 64])
def test_sorted_suffixes(shallow):
    rng = random.Random(shallow)
    text = bytes(rng.choice(b"ab") for _ in range(3000))
    data = np.frombuffer(text + bytes(16), np.uint8)
    start = np.array([rng.randrange(3000) for _ in range(800)])
    size = np.array([rng.randrange(0, min(90, 3001 - s)) for s in start])
    group = np.sort(np.array([rng.randrange(20) for _ in start]))
    order, lengths = suffixes.sorted_suffixes(data, start, size, group, shallow)
    value = lambda i: text[start[i] : start[i] + size[i]]
    assert sorted(order) == list(range(800)) and (np.diff(group[order]) >= 0).all()
    for k in range(800):
        if k and group[order[k]] == group[order[k - 1]]:
            a, b = value(order[k - 1]), value(order[k])
            assert lengths[k] == common(a, b)
            assert a <= b  # only b"\x00" at the end could tie, and there is none
        else:
            assert lengths[k] == -1
