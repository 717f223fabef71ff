"""Products of ratings and pairs of items are summed where they arise and not shuffled one by one."""

import re

import pytest

from affinia.operators import recommend as rec
from affinia.operators import similarity as sim
from tests.test_plans import plan
from tests.test_recommend import frame, jaccard, predicted, random_ratings, similarities


def exchanged(df):
    return re.findall(r"hashpartitioning\((.*?), \d+\)", plan(df))


@pytest.mark.parametrize("hot_item", [10_000, 3])
def test_pairs_of_items_are_not_shuffled(spark, hot_item):
    rows = random_ratings(11, users=40, items=20)
    rows[None, 3] = rows[None, 4] = 1.0  # counts as a user of an item, but meets nobody
    got = sim.item_similarity(frame(spark, rows), heavy_user=50, hot_item=hot_item)
    sizes = {i: len({u for u, j in rows if j == i}) for _, i in rows}
    own = {p: set() for p in jaccard(rows)}
    for a, b in own:
        own[a, b] = {u for u, i in rows if i == a and u is not None} & {u for u, i in rows if i == b}
    assert similarities(got) == {(a, b): len(s) / (sizes[a] + sizes[b] - len(s)) for (a, b), s in own.items() if s}
    if hot_item == 10_000:
        assert exchanged(got) == [e for e in exchanged(got) if "item2" not in e]


def test_found_pairs_are_counted_in_slices(spark, monkeypatch):
    monkeypatch.setattr(sim, "FOUND_ROWS", 40)
    rows = random_ratings(12, users=60, items=25)
    got = similarities(sim.item_similarity_lsh(frame(spark, rows), 40))
    exact = jaccard(rows)
    assert len(got) > 0.9 * len(exact) and all(got[p] == exact[p] for p in got)


@pytest.mark.parametrize("costs", [0, 10**9])
def test_a_bound_gives_the_same_pairs_by_prefixes_and_by_counting_all(spark, monkeypatch, costs):
    monkeypatch.setattr(sim, "COSTS", costs)
    rows = random_ratings(13, users=40, items=30)
    got = similarities(sim.item_similarity_bounded(frame(spark, rows), 0.3))
    assert got == {p: s for p, s in jaccard(rows).items() if s >= 0.3} and got


@pytest.mark.parametrize("heavy", [10_000, 4])
def test_similarities_beyond_one_copy_are_copied_in_slices(spark, heavy):
    rows = random_ratings(14)
    similar = jaccard(rows)
    near = {**similar, **{(b, a): s for (a, b), s in similar.items()}}
    train, rest = frame(spark, rows), 10  # rows of a slice, fewer than there are similarities
    near_df = sim.stored_neighbours(train, "exact")
    assert near_df.count() > 3 * rest
    unseen = rec.predict_unseen(train, near_df, heavy, 100_000, rest)
    if heavy == 10_000:  # sums of (user, item) are complete where they arise
        assert not any("item" in e and "user" in e for e in exchanged(unseen))
    targets = [(u, i) for u in range(20) for i in range(15)]
    want = {t: predicted(rows, t, near) for t in targets}
    got = {(r["user"], r["item"]): r["predicted"] for r in unseen.collect()}
    assert got == {t: pytest.approx(p) for t, p in want.items() if p is not None and t not in rows}
    asked = spark.createDataFrame(targets, "user long, item long")
    got = rec.predict_pairs(asked, train, near_df, heavy, 100_000, rest).collect()
    assert {(r["user"], r["item"]): r["predicted"] for r in got} == {t: pytest.approx(p) for t, p in want.items() if p is not None}


@pytest.mark.parametrize("heavy", [10_000, 4])
def test_few_copies_pass_the_driver_at_once(spark, monkeypatch, heavy):
    stored, store = [], rec.store
    monkeypatch.setattr(rec, "store", lambda df, name: stored.append(plan(df)) or store(df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        train = frame(spark, random_ratings(15))
        near = sim.stored_neighbours(train, "exact")
        titles = spark.createDataFrame([(3, "three")], "item long, title string")
        want = rec.recommend_items(rec.predict_unseen(train, near), titles, 3).collect()
        got = rec.recommend_items(rec.best_unseen(train, near, 3, heavy_user=heavy, broadcast_rows=10), titles, 3)
        assert {tuple(r)[:4]: pytest.approx(r["predicted"]) for r in want} == {tuple(r)[:4]: r["predicted"] for r in got.collect()}
        copies = {text.count("BroadcastExchange") for text in [*stored, plan(got)]}
        assert len(stored) > 2 and max(copies) <= 2 * rec.AT_ONCE  # a plan's text names each node twice
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("short,heavy,hot_item", [(500, 10_000, 10**6), (6, 10_000, 10**6), (3, 8, 10**6), (500, 10_000, 5)])
def test_found_pairs_are_counted_beside_all_pairs_of_short_lists(spark, monkeypatch, short, heavy, hot_item):
    rows = random_ratings(16, users=60, items=25)
    rows[None, 3] = rows[None, 4] = 1.0  # counts as a user of an item, but meets nobody
    users = {i: {u for u, j in rows if j == i} for _, i in rows}
    pairs = frame(spark, rows).select("user", "item")
    found = [(i, j) if len(users[i]) <= len(users[j]) else (j, i) for i in users for j in users if i < j and (i + j) % 3]
    found = spark.createDataFrame([(i, j, len(users[i]), len(users[j])) for i, j in found], "item long, other long, n1 long, n2 long")
    got = sim._with_shared(found, pairs, heavy, short, hot_item)
    own = {i: u - {None} for i, u in users.items()}
    sizes = lambda i, j: tuple(sorted((len(users[i]), len(users[j]))))
    want = [((i, j), sizes(i, j), len(own[i] & own[j])) for i in users for j in users if i < j and (i + j) % 3 and own[i] & own[j]]
    rows = got.collect()
    assert sorted(((r["item1"], r["item2"]), tuple(sorted((r["n1"], r["n2"]))), r["n_shared"]) for r in rows) == sorted(want)
    if (short, hot_item) == (500, 10**6):  # only lists are shuffled, by the first item
        assert not any("item2" in e or "other" in e for e in exchanged(got))
