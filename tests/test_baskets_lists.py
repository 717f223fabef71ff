import itertools
import random
from collections import Counter

from affinia.operators import baskets


def test_short_and_long_baskets_together_give_the_counts_of_all(spark, monkeypatch):
    monkeypatch.setattr(baskets, "SHORT", 4)
    rng = random.Random(3)
    held = {f"b{i}": {f"x{rng.randrange(12):02d}" for _ in range(rng.randrange(1, 9))} for i in range(60)}
    tx = spark.createDataFrame([(b, x) for b, items in held.items() for x in items] + [(None, "x01")], "basket string, item string")
    want = Counter(c for items in held.values() for k in (1, 2, 3) for c in itertools.combinations(sorted(items), k))
    want["x01",] += 1
    for heavy in (2000, 6):
        found = {tuple(r["items"]): r["support"] for r in baskets.frequent_itemsets(tx, 5, heavy_basket=heavy).collect()}
        assert found == {k: n for k, n in want.items() if n >= 5}


def test_pairs_of_short_baskets_are_formed_without_a_join(spark):
    lists = spark.createDataFrame([(["a", "b", "c"],), (["a", "c"],)], "items array<string>")
    pairs = baskets._listed_pairs(lists)
    assert Counter(map(tuple, pairs.collect())) == {("a", "b"): 1, ("a", "c"): 2, ("b", "c"): 1}
    assert "Join" not in pairs._jdf.queryExecution().toString() and "Exchange" not in pairs._jdf.queryExecution().toString()
