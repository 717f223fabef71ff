"""Ranked search by presence masks against plain scoring and SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from affinia.llm import lexical
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, item_id long, n int, score string"
PATTERN = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=10):
    held = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    n_docs, n_terms = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        asked, scored = Counter(words(text)), []
        for doc_id, counts, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(
                often * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t, often in asked.items() if t in counts
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (s, none, d) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, rank, None if none else d, -s))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    vocabulary = [f"{a}{b}{c}" for a in ("Um", "ño", "é", "日") for b in "abcdefg" for c in ("", "1", "X")] + ["the"] * 40
    make = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "-", "\n", "_"]) for _ in range(n))
    docs = [(i, make(rng.randrange(1, 120))) for i in range(400)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [(None, docs[5][1]), (None, "the"), (5, docs[5][1]), docs[5]]
    docs += [(2000, None), (2001, ""), (2002, "?!"), (2003, make(30_000)), (2004, "the " * 50_000)]
    items = [(i, make(rng.randrange(1, 90))) for i in range(12)] + [(20, docs[5][1]), (21, None), (22, "!"), (23, "unknownword")]
    items += [(0, "the"), (None, make(9)), (24, " ".join(vocabulary) * 2), (25, "the the UMA1")]
    return docs, items


def frames(spark, docs, items, parts=5):
    d = spark.createDataFrame([(*x, 1, 2, "x") for x in docs], SCHEMA).repartition(parts)
    i = spark.createDataFrame([(*reversed(x), 3, "y", 7) for x in items], "text string, item_id long, n int, doc_id string, rank int")
    return d, i


@pytest.mark.parametrize("block_terms", [1 << 16, 100])
def test_rows_equal_plain_scoring(spark, block_terms, monkeypatch):
    docs, items = corpus()
    got = lexical.search(*frames(spark, docs, items), block_terms=block_terms).collect()
    assert sorted(map(tuple, got), key=str) == plain(docs, items)


def test_equals_its_sql(spark):
    query = lambda s, d: lexical.search(s.read.parquet(f"{d}/documents.parquet"), s.read.parquet(f"{d}/benchmark.parquet"))
    assert compare(spark, SF, query, lexical.oracle()) > 0


def test_empty_tables(spark):
    d, i = frames(spark, *corpus())
    assert lexical.search(d.limit(0), i).collect() == [] == lexical.search(d, i.limit(0)).collect()


def slice_of(rng, docs=300, terms=90):
    rows = [sorted(rng.sample(range(terms), rng.randrange(0, 40))) for _ in range(docs)]
    offsets = np.cumsum([0, *map(len, rows)])
    numbers = np.array([t for r in rows for t in r], np.int32)
    tfs = np.array([rng.randrange(1, 5) for _ in numbers], np.int32)
    weights = np.array([rng.randrange(0, 9000) for _ in range(terms)], np.int64)
    lengths = np.array([max(1, 2 * len(r)) for r in rows], np.int64)
    return rows, lexical.Slice(list(range(docs)), lengths, offsets, numbers, tfs, weights, docs, int(lengths.sum()))


def test_groups_are_those_of_equal_masks():
    rng = random.Random(2)
    rows, part = slice_of(rng)
    for asked in (sorted(rng.sample(range(90), 5)), list(range(90))):
        at = np.searchsorted(part.present, asked)
        masks, docs, begins = part.groups(at)
        found = {}
        for g, (a, b) in enumerate(zip(begins, [*begins[1:], len(docs)])):
            for d in docs[a:b]:
                found[int(d)] = tuple(asked[i] for i in np.flatnonzero(masks[:, g]))
        assert found == {i: tuple(t for t in r if t in asked) for i, r in enumerate(rows) if set(r) & set(asked)}
        assert len(set(found.values())) == len(begins)


def test_no_group_scores_above_its_bound_and_late_groups_are_left_out():
    rng = random.Random(6)
    _, part = slice_of(rng)
    item = lexical.Item(1, np.array(sorted(rng.sample(range(90), 30))), np.ones(30, np.int64))
    rows = np.searchsorted(part.present, item.terms)
    masks, docs, begins = part.groups(rows)
    bound = (item.times * part.most[rows]) @ masks
    exact = part.scores(rows, item.times, docs)
    assert (exact <= np.repeat(bound, np.diff([*begins, len(docs)]))).all()
    seen = []
    part.scores = lambda r, t, d, f=part.scores: seen.append(len(d)) or f(r, t, d)
    best = part.search(item, [])
    assert [-s for s, *_ in best] == sorted(exact.tolist(), reverse=True)[:10] and sum(seen) < len(docs)
