"""Paths are counted where they arise, however many links there are."""

import re

import pytest

from affinia.operators import graph
from tests.test_graph import brute_force, collected, random_edges
from tests.test_plans import plan


@pytest.mark.parametrize("rows,hub_paths", [(40, 10**9), (150, 10**9), (150, 30)])
def test_links_beyond_one_copy_are_copied_in_slices(spark, monkeypatch, rows, hub_paths):
    monkeypatch.setattr(graph, "ROUND", 3)
    edges = random_edges(8, n=80, m=300)
    df = spark.createDataFrame(edges, "src long, dst long")
    got = graph.mutual_neighbours(df, n=3, hub_paths=hub_paths, broadcast_rows=rows, block_bytes=400)
    assert collected(got) == brute_force(edges, 3)


def test_paths_are_not_shuffled(spark):
    edges = spark.createDataFrame(random_edges(9, n=80, m=300), "src long, dst long")
    text = plan(graph.mutual_neighbours(edges, n=3, broadcast_rows=150))
    parts = re.findall(r"hashpartitioning\((.*?), \d+\)", text)
    assert parts and not any("src" in p and "dst" in p for p in parts)


def test_small_blocks_do_not_make_many_rounds(spark, monkeypatch):
    stored, store = [], graph.store
    monkeypatch.setattr(graph, "store", lambda df, name: stored.append(name) or store(df, name))
    # every source is reached by the first hub only and every target leads on from it, so lists stay open to the end
    n = 100
    edges = [(v, 1000) for v in range(n)] + [(1000, 5000 - v) for v in range(n)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = graph.mutual_neighbours(df, n=200, hub_paths=100, block_bytes=20)
    assert collected(got) == brute_force(edges, 200)
    assert 2 < stored.count("sources") < 12


@pytest.mark.parametrize("hub_paths", [10**9, 30])
def test_links_do_not_pass_the_driver(spark, monkeypatch, hub_paths):
    plans, store = [], graph.store
    monkeypatch.setattr(graph, "store", lambda df, name: plans.append(plan(df)) or store(df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        edges = random_edges(10, n=80, m=300)
        got = graph.mutual_neighbours(spark.createDataFrame(edges, "src long, dst long"), n=3, hub_paths=hub_paths, block_bytes=400)
        plans.append(plan(got))
        assert collected(got) == brute_force(edges, 3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the hubs' numbers alone, a list of bounded length, are copied
    assert sum("BroadcastExchange" in text for text in plans) == (2 if hub_paths == 30 else 0)


def test_a_middle_of_many_links_is_several_lists(spark, monkeypatch):
    monkeypatch.setattr(graph, "LIST", 10)
    edges = random_edges(12, n=80, m=300)
    got = graph.mutual_neighbours(spark.createDataFrame(edges, "src long, dst long"), n=3, hub_paths=400)
    assert collected(got) == brute_force(edges, 3)
