"""Neighbours against brute force; licence lines planted in prose."""

import numpy as np
import pytest

from affinia.llm import licenses, neighbours

SCHEMA = "vec_id long, embedding array<float>, score double, rank int"


def brute(rows, top=20, every=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, v in zip(ids, x):
        if i % every == 0:
            s = (x * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:top]
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    got = {}
    for r in sorted(df.collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def vectors(n=900, d=24, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d)) * 2
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, d))
    x[100:220] = x[100]  # copies
    return [(int(i), [float(v) for v in row]) for i, row in enumerate(x.astype(np.float32))]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], SCHEMA)


def test_all_lists_give_the_exact_answer(spark):
    rows = vectors()
    got, want = found(neighbours.nearest(frame(spark, rows), probes=10_000)), brute(rows)
    assert set(got) == set(want)
    same = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(same) > 0.99
    assert got[100] == [(i, pytest.approx(s)) for i, s in want[100]]  # only copies: ties by id


def test_recall_with_several_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PER_LIST", 60)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rows = vectors(1500, seed=2)
    got, want = found(neighbours.nearest(frame(spark, rows))), brute(rows)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9 and all(len(v) == 20 for v in got.values())
    for q, pairs in got.items():
        exact = dict(brute([r for r in rows if r[0] == q or r[0] in dict(pairs)], 20)[q])
        assert all(exact[i] == pytest.approx(s) for i, s in pairs)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [-1.0, 0.0]), (3, [1.0, 0.0])]
    odd = [(40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]), (160, [1.0]), (None, [1.0, 0.0])]
    got = found(neighbours.nearest(frame(spark, [*good, *odd, good[0]])))
    assert got == {
        0: [(3, 1.0), (1, 0.5), (20, -1.0)],
        20: [(1, -0.5), (0, -1.0), (3, -1.0)],
    }
    assert neighbours.nearest(frame(spark, odd[:3])).collect() == []
    assert neighbours.nearest(frame(spark, [])).collect() == []


def test_error_bounds_hold():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(2000, 96)), rng.normal(size=(50, 96))
    centre, turn = x.mean(axis=0), neighbours.rotation(96)
    bits, length, fit = neighbours.encode(x, centre, turn)
    assert bits.shape == (2000, 12)
    about, error = neighbours.estimate(bits, length, fit, q @ centre, q @ turn)
    off = np.abs(about - q @ x.T)
    assert (off <= error).mean() > 0.99
    assert abs((about - q @ x.T).mean()) < 0.1  # no bias
    spread = np.sqrt(1 - fit**2) / fit * length * np.linalg.norm(q, axis=1)[:, None] / np.sqrt(95)
    assert off.mean() < spread.mean()  # a normal error of that deviation has a mean size of 0.8


PROSE = "of the rend and threlyes in the work for which this is a reason to be at the end of use"


def test_licence_lines_are_found(spark):
    notices = [t for ts in licenses.TEMPLATES.values() for t in ts]
    rows = [(i, f"{PROSE} {i}\n{PROSE}. This is free of use.", 1, "x") for i in range(80)]
    rows += [(100 + i, f"{PROSE}\n{t}\n{PROSE}", 2, "y") for i, t in enumerate(notices)]
    rows += [(300, None, 0, ""), (301, "", 0, ""), (302, "a license to thrill", 0, ""), (303, "word " * 50_000, 0, ""), rows[80], (None, "Released under the MIT License.", 0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family int, similarity string")
    got = licenses.scan(docs).collect()
    by_place = {(r.doc_id, r.line_no): r for r in got}
    family = {t: f for f, ts in licenses.TEMPLATES.items() for t in ts}
    for i, t in enumerate(notices):
        r = by_place[(100 + i, 1)]
        assert (r.family, r.confirmed) == (family[t], True) and r.similarity > 0.9
    confirmed = {(r.doc_id, r.line_no) for r in got if r.confirmed}
    assert confirmed == {(100 + i, 1) for i in range(len(notices))} | {(None, 0)}
    assert len(got) == len({(r.doc_id, r.line_no) for r in got}) + 1  # the repeated row


def test_licence_scan_of_nothing(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
