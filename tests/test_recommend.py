import random
from collections import defaultdict

import pytest

from affinia.operators import recommend as rec
from affinia.operators import similarity as sim
from affinia.operators.sampling import sample_keys, split


def random_ratings(seed, users=20, items=15, hot=True):
    rng = random.Random(seed)
    rows = {(u, i): rng.randrange(1, 11) / 2 for u in range(users) for i in range(items) if rng.random() < 0.25}
    if hot:  # one user rates everything, one item is rated by everyone
        rows.update({(0, i): rng.randrange(1, 11) / 2 for i in range(items)})
        rows.update({(u, 0): rng.randrange(1, 11) / 2 for u in range(users)})
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double")


def jaccard(rows):
    users = defaultdict(set)
    for u, i in rows:
        users[i].add(u)
    out = {}
    for a in users:
        for b in users:
            if a < b and users[a] & users[b]:
                out[a, b] = len(users[a] & users[b]) / len(users[a] | users[b])
    return out


def similarities(df):
    return {(r["item1"], r["item2"]): pytest.approx(r["similarity"]) for r in df.collect()}


@pytest.mark.parametrize("heavy,bits", [(10_000, 60), (3, 60), (3, 2), (3, 0)])
def test_exact_similarity_with_and_without_hot_users(spark, monkeypatch, heavy, bits):
    monkeypatch.setattr(sim, "MASK_BITS", bits)
    rows = random_ratings(1)
    assert jaccard(rows) == similarities(sim.item_similarity(frame(spark, rows), heavy_user=heavy))


def test_distance_limit(spark):
    rows = random_ratings(2)
    got = similarities(sim.item_similarity(frame(spark, rows), max_distance=0.7))
    assert got == {p: s for p, s in jaccard(rows).items() if 1 - s < 0.7}


@pytest.mark.parametrize("least,heavy", [(0.2, 10_000), (0.5, 2), (1.0, 10_000)])
def test_bounded_similarity_has_all_pairs_above_the_bound(spark, least, heavy):
    rows = random_ratings(6, users=40, items=30)
    rows |= {(u, 100 + k): 1.0 for u in (3, 5, 8) for k in range(4)}  # items with equal users
    rows |= {(u, 200 + k): 1.0 for u in range(k, k + 6) for k in range(6)}
    got = similarities(sim.item_similarity_bounded(frame(spark, rows), least, heavy))
    assert got == {p: s for p, s in jaccard(rows).items() if s >= least} and got


def test_few_pairs_below_the_bound_are_formed(spark):
    rng = random.Random(9)
    rows = {(rng.randrange(300), i): 1.0 for i in range(200) for _ in range(rng.randrange(2, 30))}
    rows |= {(0, i): 1.0 for i in range(200)}  # a user of everything
    pairs = frame(spark, rows).select("user", "item")
    formed = sim.candidates(pairs, 0.3).count()
    assert formed < 0.05 * len(jaccard(rows))


@pytest.mark.parametrize("heavy", [10_000, 1])
def test_lsh_pairs_are_exact_pairs_and_recall_grows(spark, heavy):
    rows = random_ratings(3, users=60, items=25)
    exact = jaccard(rows)
    found = {}
    for tables in (1, 5, 40):
        got = similarities(sim.item_similarity_lsh(frame(spark, rows), tables, heavy_bucket=heavy))
        assert set(got) <= set(exact)
        assert all(got[p] == exact[p] for p in got)
        found[tables] = len(got)
    assert found[1] < found[5] < found[40]
    assert found[40] > 0.9 * len(exact)


def test_lsh_accepts_string_users(spark):
    rows = random_ratings(4)
    df = frame(spark, rows).selectExpr("concat('u', user) AS user", "item", "rating")
    assert set(similarities(sim.item_similarity_lsh(df, 20))) <= set(jaccard(rows))


def predicted(rows, target, near):
    user, item = target
    pairs = [(near[item, j], r) for (u, j), r in rows.items() if u == user and (item, j) in near]
    return sum(s * r for s, r in pairs) / sum(s for s, _ in pairs) if pairs else None


@pytest.mark.parametrize("limits", [(10_000, 100_000, 2_000_000), (4, 5, 0), (4, 5, 2_000_000), (10_000, 5, 0)])
def test_predictions_equal_brute_force(spark, limits):
    rows = random_ratings(5)
    similar = jaccard(rows)
    near = {**similar, **{(b, a): s for (a, b), s in similar.items()}}
    train = frame(spark, rows)
    near_df = sim.stored_neighbours(train, "exact")
    got = {(r["user"], r["item"]): r["predicted"] for r in rec.predict_unseen(train, near_df, *limits).collect()}
    targets = [(u, i) for u in range(20) for i in range(15) if (u, i) not in rows]
    want = {t: predicted(rows, t, near) for t in targets}
    assert got == {t: pytest.approx(p) for t, p in want.items() if p is not None}
    unseen = {tuple(r) for r in rec.unseen_pairs(train, near_df, *limits).select("user", "item").collect()}
    assert unseen == set(got)

    rated = rec.predict_pairs(train, train, sim.neighbours(sim.item_similarity(train), False), *limits)
    got = {(r["user"], r["item"]): r["predicted"] for r in rated.collect()}
    want = {t: predicted(rows, t, similar) for t in rows}
    assert got == {t: pytest.approx(p) for t, p in want.items() if p is not None}


def test_evaluation_of_nothing_and_of_unscored_pairs(spark):
    held = spark.createDataFrame([(1, 1, 4.0), (1, 2, 3.0), (2, 1, 1.0)], "user long, item long, rating double")
    scored = spark.createDataFrame(
        [(1, 1, 3.0), (2, 1, float("nan"))], "user long, item long, predicted double"
    )
    errs = rec.errors(held, scored)
    assert tuple(rec.evaluate(errs).first()) == (3, 1, 1.0, 1.0)
    guard = {r["mode"]: (r["n_null"], r["mae"]) for r in rec.null_guard(errs).collect()}
    assert guard == {"excluded": (2, 1.0), "filled": (2, pytest.approx(1 / 3))}
    assert tuple(rec.evaluate(rec.errors(held.limit(0), scored)).first()) == (0, 0, None, None)


def test_zero_similarity_gives_no_division_error(spark):
    train = spark.createDataFrame([(1, 1, 4.0)], "user long, item long, rating double")
    near = spark.createDataFrame([(2, 1, 0.0)], "item long, neighbour long, similarity double")
    assert rec.predict_unseen(train, near).first()["predicted"] is None


def test_clamp_ties_and_titles(spark):
    pred = spark.createDataFrame([(1, 9, 6.0), (1, 3, 5.5), (1, 4, 2.0)], "user long, item long, predicted double")
    titles = spark.createDataFrame([(3, "three")], "item long, title string")
    rows = rec.recommend_items(pred, titles, 2, max_rating=5.0).orderBy("rank").collect()
    assert [tuple(r) for r in rows] == [(1, 1, 3, "three", 5.0), (1, 2, 9, None, 5.0)]


def test_split_is_complete_and_independent_of_partitioning(spark):
    df = spark.range(2000).selectExpr("id AS user", "id % 7 AS item")
    train, held = split(df, ["user", "item"])
    again, _ = split(df.repartition(7), ["user", "item"])
    assert train.count() + held.count() == 2000
    assert 0.87 < train.count() / 2000 < 0.93
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, again.collect()))
    assert 120 < sample_keys(df, "user").count() < 280


def test_dedup_keeps_the_latest_then_the_highest(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0, 1), (1, 1, 2.0, 2), (1, 1, 3.0, 2)], "user long, item long, rating double, ts long"
    )
    assert [tuple(r) for r in sim.dedup_ratings(df).collect()] == [(1, 1, 3.0)]
