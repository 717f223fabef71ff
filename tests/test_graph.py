import random

import pytest

from affinia.operators.graph import mutual_neighbours, recommend_friends
from affinia.operators.skew import ranked, spread_join


def brute_force(edges, n=10):
    friends = {}
    for a, b in edges:
        friends.setdefault(a, set()).add(b)
    out = {}
    for user, own in friends.items():
        score = {}
        for friend in own:
            for other in friends.get(friend, ()):
                if other != user and other not in own:
                    score[other] = score.get(other, 0) + 1
        best = sorted(score.items(), key=lambda item: (-item[1], item[0]))[:n]
        if best:
            out[user] = best
    return out


def collected(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r["src"], r["rank"])):
        out.setdefault(row["src"], []).append((row["candidate"], row["n_mutual"]))
    return out


def random_edges(seed, n=60, m=150, hubs=2):
    rng = random.Random(seed)
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    for hub in range(hubs):
        for v in range(n):
            if rng.random() < 0.7:
                edges.add((v, hub))
            if rng.random() < 0.5:
                edges.add((hub, v))
    return sorted(edges)


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
@pytest.mark.parametrize("seed,hub_paths,max_hubs", [(1, 10**9, 6), (2, 400, 6), (3, 400, 1), (4, 30, 6), (5, 0, 6), (6, 3, 4096), (7, 0, 4096)])
def test_hubs_give_the_same_candidates(spark, seed, hub_paths, max_hubs, broadcast_rows):
    edges = random_edges(seed, hubs=2 if seed < 6 else 5, n=60 if seed < 6 else 110)
    df = spark.createDataFrame(edges, "src long, dst long")
    got = mutual_neighbours(df, n=3, hub_paths=hub_paths, busy_paths=20, max_hubs=max_hubs, broadcast_rows=broadcast_rows, block_bytes=400)
    assert collected(got) == brute_force(edges, 3)


def test_friendless_vertex_self_loop_and_friend_without_own_row(spark):
    vertices = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    edges = spark.createDataFrame(
        [(1, 2), (1, 2), (2, 1), (2, 2), (2, 3), (3, 9)], "src long, dst long"
    )
    rows = {r["id"]: list(r["recs"]) for r in recommend_friends(vertices, edges).collect()}
    assert rows == {1: [3], 2: [9], 3: [], 4: []}


def test_spread_join_equals_join(spark):
    left = spark.createDataFrame([(i % 3, i) for i in range(60)], "k long, a long")
    right = spark.createDataFrame([(i % 4, i) for i in range(40)], "k long, b long")
    want = sorted(map(tuple, left.join(right, "k").collect()))
    assert sorted(map(tuple, spread_join(left, right, "k", [0, 2], 5).collect())) == want


def test_ranked_equals_row_number(spark):
    rng = random.Random(7)
    rows = [("a" if rng.random() < 0.9 else "b", v) for v in rng.sample(range(10_000), 500)]
    got = ranked(spark.createDataFrame(rows, "g string, v long"), ["g"], ["v"]).collect()
    for g in "ab":
        want = {v: i + 1 for i, v in enumerate(sorted(v for h, v in rows if h == g))}
        assert {r["v"]: r["rank"] for r in got if r["g"] == g} == want
