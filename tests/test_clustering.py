import random

import numpy as np
import pytest
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from affinia.functions.vectors import centroid, mahalanobis, spread
from affinia.operators import profile as prof
from affinia.operators import summaries as summ
from affinia.operators.bfr import Bfr, BfrSettings, chunk_rows, final_report, merge_compressed, run_chunks, set_sizes
from affinia.operators.ward import ward_clusters
from affinia.streaming.bfr_stream import cluster_stream


def blobs(seed, n=240, d=3, centers=4, far=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + 15 * rng.integers(0, centers, size=(n, 1))
    x[rng.choice(n, far, replace=False)] *= -7
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, features array<double>")


SETTINGS = BfrSettings(k=4, over=3, rows_per_task=30)


@pytest.fixture(scope="module")
def batch(spark):
    rows = blobs(1)
    bfr, version = run_chunks(frame(spark, rows), 60, SETTINGS)
    return rows, bfr, version


def test_every_point_is_in_exactly_one_set(batch):
    rows, bfr, version = batch
    clusters, assigned, retained = bfr.finish(version)
    ids = [r["id"] for r in assigned.collect()] + [r["id"] for r in retained.collect()]
    assert sorted(ids) == [i for i, _ in rows]
    sizes = {r["kind"]: r["points"] for r in set_sizes(clusters, retained).collect()}
    assert sum(sizes.values()) == len(rows)
    report = bfr.report(version).orderBy("chunk").collect()
    seen = 0
    for line in report:
        seen += line["n_points"]
        assert line["ds_points"] + line["cs_points"] + line["rs_points"] == seen
    assert [r["chunk"] for r in report] == list(range(version + 1))
    shown = final_report(clusters).first()
    assert len(shown["sum3"]) == 3


def test_summaries_rebuilt_from_the_assignment_are_the_kept_ones(batch, spark):
    rows, bfr, version = batch
    clusters, assigned, _ = bfr.finish(version)
    members = assigned.join(frame(spark, rows), "id")
    rebuilt = {(r["kind"], r["cluster"]): r for r in summ.summarise(members, ["kind", "cluster"]).collect()}
    kept = {(r["kind"], r["cluster"]): r for r in clusters.collect()}
    assert set(rebuilt) == set(kept)
    for key, row in kept.items():
        assert row["n"] == rebuilt[key]["n"]
        assert row["sum"] == pytest.approx(rebuilt[key]["sum"])
        assert row["sumsq"] == pytest.approx(rebuilt[key]["sumsq"])


def test_a_replayed_chunk_changes_nothing(batch, spark):
    rows, bfr, version = batch
    before = sorted(map(tuple, bfr.report(version).collect()))
    bfr.update(frame(spark, rows[:60]), 1)
    assert sorted(map(tuple, bfr.report(version).collect())) == before


def test_stream_equals_batch(batch, spark, tmp_path):
    rows, bfr, version = batch
    for chunk in range(4):
        frame(spark, rows[60 * chunk : 60 * chunk + 60]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    streamed, last = cluster_stream(spark, str(tmp_path / "in"), SETTINGS)
    assert last == version
    groups = []
    for state in (bfr, streamed):
        members = {}
        for r in state.finish(version)[1].collect():
            members.setdefault((r["kind"], r["cluster"]), set()).add(r["id"])
        groups.append(sorted(sorted(m) for m in members.values()))
    assert groups[0] == groups[1]


def test_a_stream_goes_on_where_it_ended(batch, spark, tmp_path):
    rows, bfr, version = batch
    state, checkpoint, folder = (str(tmp_path / n) for n in ("state", "checkpoint", "in"))
    frame(spark, []).write.parquet(folder)
    assert cluster_stream(spark, folder, SETTINGS, 1, state, checkpoint)[1] in (None, 0)
    for chunk in range(4):
        frame(spark, rows[60 * chunk : 60 * chunk + 60]).coalesce(1).write.mode("append").parquet(folder)
        streamed, last = cluster_stream(spark, folder, SETTINGS, 1, state, checkpoint)
    again, same = cluster_stream(spark, folder, SETTINGS, 1, state, checkpoint)
    assert same == last
    clusters, assigned, retained = again.finish(same)
    ids = [r["id"] for r in assigned.collect()] + [r["id"] for r in retained.collect()]
    assert sorted(ids) == [i for i, _ in rows]


def test_a_small_first_chunk_waits(spark):
    rng = np.random.default_rng(2)
    x = [(i, [float(v) for v in rng.normal(size=3) + 30 * (i % 3)]) for i in range(202)]
    settings = BfrSettings(k=3, over=3, rows_per_task=300)
    bfr = Bfr(spark, settings=settings)
    bfr.update(frame(spark, x[:2]), 0)
    bfr.update(frame(spark, x[2:]), 1)
    report = {r["chunk"]: r for r in bfr.report(1).collect()}
    assert (report[0]["ds_clusters"], report[0]["rs_points"]) == (0, 2)
    assert report[1]["ds_clusters"] == 3
    assert report[1]["ds_points"] + report[1]["cs_points"] + report[1]["rs_points"] == 202


def test_chunks_are_cut_by_rank(spark):
    rows = [(i * 1000, v) for i, v in blobs(7, n=130, far=0)]
    bfr, version = run_chunks(frame(spark, rows), 50, SETTINGS)
    assert [r["n_points"] for r in bfr.report(version).orderBy("chunk").collect()] == [50, 50, 30]


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e8])
def test_own_points_are_near_under_any_offset(spark, offset):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=4) + offset]) for i in range(400)]
    df = frame(spark, rows).withColumn("cluster", F.lit("a"))
    halves = df.withColumn("half", F.col("id") % 2)
    merged = summ.merge_summaries(summ.summarise(halves, ["half", "cluster"]).drop("half"), ["cluster"])
    for summary in (summ.summarise(df, ["cluster"]), merged):
        near = summ.nearest_cluster(df.select("id", "features"), summary, 2.0)
        assert near.filter("cluster IS NOT NULL").count() >= 399


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = None
        for a in range(len(groups)):
            for b in range(a + 1, len(groups)):
                ca, cb = x[groups[a]].mean(axis=0), x[groups[b]].mean(axis=0)
                na, nb = len(groups[a]), len(groups[b])
                cost = na * nb / (na + nb) * ((ca - cb) ** 2).sum()
                if best is None or cost < best[0]:
                    best = (cost, a, b)
        _, a, b = best
        groups[a] += groups.pop(b)
    return sorted(sorted(g) for g in groups)


def groups_of(rows, k):
    out = {}
    for r in rows:
        if r["k"] == k:
            out.setdefault(r["cluster"], []).append(r["id"])
    return sorted(sorted(g) for g in out.values())


def test_ward_on_few_points_is_plain_ward(spark):
    rows = blobs(3, n=40)
    got = ward_clusters(frame(spark, rows), [3, 5, 8]).collect()
    x = np.array([v for _, v in rows])
    for k in (3, 5, 8):
        assert groups_of(got, k) == plain_ward(x, k)


def test_ward_through_micro_clusters_is_nested_and_near_the_built_in_method(spark):
    rows = blobs(4, n=300, far=0)
    df = frame(spark, rows)
    labels = ward_clusters(df, [3, 4, 6], micro=30).cache()
    got = labels.collect()
    for fine, coarse in ((6, 4), (4, 3)):
        outer = [set(g) for g in groups_of(got, coarse)]
        assert all(any(set(g) <= o for o in outer) for g in groups_of(got, fine))
        assert len(groups_of(got, fine)) == fine
    assert sorted(r["id"] for r in got if r["k"] == 4) == list(range(300))
    n, r = F.col("n"), F.col("radius")
    stats = summ.cluster_stats(labels.filter("k = 4").join(df, "id"), ["cluster"])
    ours = stats.agg(F.sum(n * r * r)).first()[0]
    vectors = df.select(array_to_vector("features").alias("features"))
    built_in = BisectingKMeans(k=4, seed=1).fit(vectors).summary.trainingCost
    assert ours <= 1.05 * built_in


def test_ward_with_fewer_points_than_clusters(spark):
    got = ward_clusters(frame(spark, blobs(5, n=4, far=0)), [3, 8]).collect()
    assert len(groups_of(got, 3)) == 3
    assert len(groups_of(got, 8)) == 4


def test_cluster_stats_of_single_points_and_equal_points(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [5.0, 5.0])]
    df = frame(spark, rows).withColumn("cluster", F.when(F.col("id") < 2, "same").otherwise("one"))
    got = {r["cluster"]: tuple(r)[1:] for r in summ.cluster_stats(df, ["cluster"]).collect()}
    assert got == {"same": (2, 0.0, 0.0, 0.0, 0.0), "one": (1, 0.0, 0.0, 0.0, 0.0)}


def test_cluster_stats_survive_a_large_offset(spark):
    rows = [(i, [1e9 + v, -1e9 + v]) for i, v in enumerate([0.0, 1.0, 2.0, 3.0])]
    got = summ.cluster_stats(frame(spark, rows).withColumn("cluster", F.lit(0)), ["cluster"]).first()
    assert got["radius"] == pytest.approx(2.5**0.5)
    assert got["diameter"] == pytest.approx((20 / 3) ** 0.5)


def test_published_statistics_satisfy_the_diameter_identity():
    # size, radius, diameter of three clusters of a published run
    for n, radius, diameter in ((456, 579.27, 820.11), (59, 1042.18, 1486.52), (1586, 322.23, 455.85)):
        assert radius * (2 * n / (n - 1)) ** 0.5 == pytest.approx(diameter, abs=0.02)


def test_nearest_cluster_in_blocks_with_zero_variance_and_missing_values(spark, monkeypatch):
    rng = random.Random(5)
    members = [(c, [c * 4 + rng.random(), 1.0]) for c in range(5) for _ in range(6)]
    clusters = summ.summarise(spark.createDataFrame(members, "cluster int, features array<double>"), ["cluster"])
    points = frame(spark, [(0, [0.5, 1.0]), (1, [16.5, 1.0]), (2, [8.5, 1.1]), (3, [100.0, 1.0]), (4, [float("nan"), 1.0])])
    for block in (2_000_000, 2):
        monkeypatch.setattr(summ, "BLOCK_VALUES", block)
        got = {r["id"]: r["cluster"] for r in summ.nearest_cluster(points, clusters, 2.0).collect()}
        assert got == {0: 0, 1: 4, 2: None, 3: None, 4: None}
    near = summ.nearest_cluster(points.filter("id < 2"), clusters, 2.0).join(
        clusters.select("cluster", "n", "sum", "m2"), "cluster"
    )
    n, s, q = F.col("n"), F.col("sum"), F.col("m2")
    expression = mahalanobis(F.col("features"), centroid(n, s), spread(n, q))
    for row in near.select("distance", expression.alias("d")).collect():
        assert row["d"] == pytest.approx(row["distance"])
    empty = summ.nearest_cluster(points, clusters.limit(0), 2.0)
    assert empty.filter("cluster IS NOT NULL").count() == 0


def test_profile_orders_numbers_before_names_and_counts_missing(spark):
    assigned = spark.createDataFrame([(1, "10"), (2, "9"), (3, "CS_1"), (4, "9"), (5, "9")], "id long, cluster string")
    labels = spark.createDataFrame([(1, "Rock"), (2, "Pop"), (3, None), (4, "Folk"), (9, "Jazz")], "id long, label string")
    counts = prof.label_counts(assigned, labels)
    report = prof.profile_report(prof.profile_clusters(counts)).orderBy(*prof.cluster_order(), "place")
    assert [r["line"] for r in report.collect()] == [
        "Cluster 9:", "  Folk: 1 songs", "  Pop: 1 songs", "",
        "Cluster 10:", "  Rock: 1 songs", "",
        "Cluster CS_1:", "  ( with no genre): 1 songs", "",
    ]
    assert tuple(prof.coverage(assigned, labels).first()) == (5, 5, 4)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan"), [1.0]), (2, 1.0, [float("nan")]), (3, 1.0, [2.0])], "id long, x double, f array<double>")
    assert [r["id"] for r in prof.complete_rows(df).collect()] == [3]
    assert {r["column"]: r["n_non_null"] for r in prof.table_profile(df).collect()} == {"id": 3, "x": 2, "f": 3}


def summary(kind, name, points):
    mean = [sum(x) / len(points) for x in zip(*points)]
    m2 = [sum((p[d] - mean[d]) ** 2 for p in points) for d in range(len(mean))]
    return kind, name, len(points), [sum(x) for x in zip(*points)], m2


def test_compressed_clusters_merge_while_they_stay_tight():
    rng = random.Random(3)
    around = lambda x, y, s, n=8: [(x + rng.gauss(0, s), y + rng.gauss(0, s)) for _ in range(n)]
    rows = [summary("DS", "0", around(0, 0, 1.0, 40))]
    rows += [summary("CS", f"CS_{i}", around(20 + 0.2 * i, 5, 0.1)) for i in range(3)]  # one place
    rows += [summary("CS", f"CS_{3 + i}", around(-30 * (i + 1), 9 * i, 0.1)) for i in range(4)]  # far apart
    assert merge_compressed(rows, BfrSettings()) == {"CS_1": "CS_0", "CS_2": "CS_0"}
    few = merge_compressed(rows, BfrSettings(most=2))
    assert len(few) == 5 and not set(few.values()) & set(few)  # names lead straight to those that are left
    assert merge_compressed(rows[:1], BfrSettings()) == {} == merge_compressed([], BfrSettings())


def test_many_compressed_clusters_stay_within_their_bound():
    rng = random.Random(8)
    rows = [summary("CS", f"CS_{i}", [(rng.uniform(0, 900), rng.uniform(0, 900))] * 2) for i in range(140)]
    into = merge_compressed(rows, BfrSettings(most=50))
    assert 140 - len(into) == 50
    assert {r[1] for r in rows} >= set(into.values()) and not set(into) & set(into.values())


def test_the_number_of_chunks_does_not_grow():
    assert [chunk_rows(n) for n in (0, 10, 1000, 10_001)] == [250, 250, 250, 2501]
