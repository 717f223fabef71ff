"""Raking and sampling, and the Feistel shards, against brute force and SQL."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinia.llm import mixing, sharding
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, weight double, shard int"


def test_mixture_equals_its_sql(spark):
    query = lambda s, d: mixing.mixture(s.read.parquet(f"{d}/documents.parquet"))
    assert compare(spark, SF, query, mixing.oracle()) > 0


def test_raked_marginals():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 1000, (5, 3, 2)).astype(float)
    targets = [mixing.tempered(tokens, axis, 0.5) for axis in range(3)]
    factors = mixing.rake(tokens, targets, 60)
    share = np.einsum("ijk,i,j,k->ijk", tokens, *factors) / tokens.sum()
    for axis, target in enumerate(targets):
        assert share.sum(axis=tuple(i for i in range(3) if i != axis)) == pytest.approx(target)


def documents(n=3000):
    return [(i, "w " * (i % 7 + 1), "xy"[i % 5 == 0], f"s{min(i % 9, 4)}", 1.0, 1) for i in range(n)]


def test_sample_follows_given_targets(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    rows = mixing.mixture(docs, {"source": {"s0": 0.4, "s1": 0.3}}).collect()
    assert len(rows) == 3000
    for r in rows:
        assert 0 <= r.probability <= 1
    expected = Counter()
    for r in rows:
        expected[r.source] += r.probability * r.n_tokens
    share = {s: v / sum(expected.values()) for s, v in expected.items()}
    assert share["s0"] == pytest.approx(0.4, abs=1e-4) and share["s1"] == pytest.approx(0.3, abs=1e-4)
    assert max(r.probability for r in rows) == 1.0
    drawn = [r for r in rows if r.sampled]
    assert len(drawn) == pytest.approx(sum(r.probability for r in rows), rel=0.1)
    kept = mixing.sample(docs, {"source": {"s0": 0.4, "s1": 0.3}})
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in drawn)


def test_rest_class_loses_nothing(spark):
    docs = spark.createDataFrame(documents(400), SCHEMA)
    names, tokens = mixing.cell_table(mixing.features(docs), most=2)
    assert mixing.REST in names[0] and tokens.sum() == sum(i % 7 + 1 for i in range(400))


def test_mixture_of_odd_rows(spark):
    rows = [(1, None, None, None, 0.0, 0), (2, "", "x", None, 0.0, 0), (None, "a b", None, "s", 0.0, 0), (3, "a " * 50_000, "x", "s", 0.0, 0)]
    docs = spark.createDataFrame([*rows, rows[3]], SCHEMA)
    assert mixing.mixture(docs).count() == 5
    assert mixing.mixture(docs.limit(0)).collect() == [] and mixing.sample(docs.limit(0)).collect() == []
    blank = spark.createDataFrame(rows[:2], SCHEMA)
    assert [r.probability for r in mixing.mixture(blank).collect()] == [1.0, 1.0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 17, 99, 100, 1000])
def test_permutation(spark, n):
    got = spark.range(n).select(sharding.permuted(F.col("id"), n).alias("at")).collect()
    assert sorted(r.at for r in got) == list(range(n))
    placed = spark.range(n).select("id", sharding.permuted(F.col("id"), n).alias("at")).collect()
    for r in placed[:200]:
        assert (r.at % 24, r.at // 24) == sharding.place(r.id, n)


def test_shards_of_documents(spark):
    rows = [(i, f"text é {i % 40}", "x", "s", 1.0, 9) for i in range(500)]
    rows += [(None, None, None, None, None, None), (7, "text é 7", "x", "s", 1.0, 9), (1000, "y" * 100_000, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sharding.sharded_documents(docs).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], len((r[1] or "").encode()) + 8, None if r[1] is None else zlib.crc32(r[1].encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in range(24):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(counts[shard]))
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32 or 0, r.size))
    assert [r.row_number for r in order] == list(range(len(rows))) or order[8].doc_id == order[9].doc_id
    for r in got:
        assert (r.shard, r.slot) == sharding.place(r.row_number, len(rows))
    again = sharding.sharded_documents(docs.repartition(2)).collect()
    assert Counter((r.doc_id, r.size, r.shard, r.slot) for r in again if r.doc_id != 7) == Counter(
        (r.doc_id, r.size, r.shard, r.slot) for r in got if r.doc_id != 7
    )
    assert sharding.sharded_documents(docs.limit(0)).collect() == []
