import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from affinia.operators import baskets as ops


def brute_force(tx, min_support, max_size=3):
    baskets = {}
    for basket, item in tx:
        baskets.setdefault(basket, set()).add(item)
    count = Counter(c for items in baskets.values() for k in range(1, max_size + 1) for c in combinations(sorted(items), k))
    return {c: n for c, n in count.items() if n >= min_support}


def random_tx(seed, n=80, items=12, long=3):
    rng = random.Random(seed)
    tx = [(f"b{b}", f"i{rng.randrange(items)}") for b in range(n) for _ in range(rng.randrange(1, 6))]
    tx += [(f"long{b}", f"i{i}") for b in range(long) for i in range(items) if rng.random() < 0.9]
    return tx + tx[:20]


def mined(spark, tx, *args, **kwargs):
    df = ops.frequent_itemsets(spark.createDataFrame(tx, "basket string, item string"), *args, **kwargs)
    return {tuple(r["items"]): r["support"] for r in df.collect()}


@pytest.mark.parametrize("seed,min_support,heavy", [(1, 6, 2000), (2, 6, 6), (3, 4, 3), (4, 3, 1), (5, 2, 1)])
def test_itemsets_equal_brute_force_with_long_baskets_set_aside(spark, seed, min_support, heavy):
    tx = random_tx(seed)
    assert mined(spark, tx, min_support, heavy_basket=heavy) == brute_force(tx, min_support)


def test_one_basket_with_every_item_and_hundreds_of_long_ones(spark):
    tx = random_tx(7, n=60, items=14, long=150) + [("all", f"i{i}") for i in range(14)]
    assert mined(spark, tx, 90, heavy_basket=5) == brute_force(tx, 90)


def test_fpgrowth_agrees(spark):
    tx = spark.createDataFrame(random_tx(9), "basket string, item string").distinct()
    n = tx.select("basket").distinct().count()
    lists = tx.groupBy("basket").agg(F.collect_set("item").alias("items"))
    fp = FPGrowth(minSupport=5 / n).fit(lists).freqItemsets.filter(F.size("items") <= 3)
    want = {tuple(sorted(r["items"])): r["freq"] for r in fp.collect()}
    got = {tuple(r["items"]): r["support"] for r in ops.frequent_itemsets(tx, 5).collect()}
    assert got == want


def test_item_in_every_basket_has_equal_lift_bounds(spark):
    tx = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "a"), ("y", "b")], "basket string, item string")
    rules = ops.association_rules(ops.frequent_itemsets(tx, 2), 2).collect()
    assert len(rules) == 2
    assert all(r["standardized_lift"] == 0 and r["lift"] == 1 and r["interest"] == 0 for r in rules)


def test_report_lines(spark):
    tx = spark.createDataFrame(
        [("x", "1"), ("x", "2"), ("y", "1"), ("y", "2"), ("z", "1"), ("w", "3")], "basket string, item string"
    )
    names = spark.createDataFrame([("1", "cold"), ("1", "a cold")], "code string, text string")
    dictionary = ops.item_dictionary(names, "code", "text")
    itemsets = ops.frequent_itemsets(tx, 2)
    lines = [r["line"] for r in ops.itemset_report(itemsets, dictionary).orderBy("section", "rank").collect()]
    assert lines == [
        "Count of frequent itemsets (size 1): 2",
        "Count of frequent itemsets (size 2): 1",
        "Count of frequent itemsets (size 3): 0",
        "1 (a cold) -> support: 3",
        "2 (Unknown) -> support: 2",
        "1 (a cold), 2 (Unknown) -> support: 2",
    ]
    rules = ops.strong_rules(ops.association_rules(itemsets, 4))
    lines = [r["line"] for r in ops.rule_report(rules, dictionary).orderBy("line").collect()]
    assert lines == [
        "2 -> a cold | SL: 1.0000, lift: 1.3333, conf: 1.0000, interest: 0.2500",
        "a cold -> 2 | SL: 1.0000, lift: 1.3333, conf: 0.6667, interest: 0.1667",
    ]
