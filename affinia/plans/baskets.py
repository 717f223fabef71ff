"""Queries over baskets: an order holds the brands of its parts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from affinia.operators import baskets as ops
from affinia.plans.tables import table
from affinia.session import store

SUPPORT_SHARE = 0.0033
STRONG = 0.15


def transactions(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (
        lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
        .select(F.col("l_orderkey").cast("string").alias("basket"), F.col("p_brand").alias("item"))
        .distinct()
    )


def _dictionary(spark, sf_dir):
    return ops.item_dictionary(table(spark, sf_dir, "part"), "p_brand", "p_type")


def _mined(spark, sf_dir, max_size=3):
    tx = store(transactions(spark, sf_dir), "transactions")
    n = tx.select("basket").distinct().count()
    return ops.frequent_itemsets(tx, max(2, math.ceil(SUPPORT_SHARE * n)), max_size, distinct=True), n


def _joined(column):
    return F.concat_ws(",", column)


def _itemsets_of(size):
    def query(spark, sf_dir):
        itemsets, _ = _mined(spark, sf_dir, size)
        return itemsets.filter(F.col("size") == size).select(_joined("items").alias("items"), "support")

    return query


def itemsets_median(spark, sf_dir):
    """All itemsets at the median pair support, where half of the pairs are pruned."""
    tx = store(transactions(spark, sf_dir), "transactions")
    n = tx.select("basket").distinct().count()
    pairs = ops.frequent_itemsets(tx, max(2, math.ceil(SUPPORT_SHARE * n)), 2, distinct=True)
    median = pairs.filter(F.col("size") == 2).agg(F.median("support")).first()[0]
    itemsets = ops.frequent_itemsets(tx, math.ceil(median), distinct=True)
    return itemsets.select("size", _joined("items").alias("items"), "support")


def itemsets_past_long_baskets(spark, sf_dir):
    """The same with one basket that holds every item, and long baskets from five items on."""
    every = table(spark, sf_dir, "part").select(F.lit("every").alias("basket"), F.col("p_brand").alias("item"))
    tx = store(transactions(spark, sf_dir).union(every.distinct()), "transactions")
    n = tx.select("basket").distinct().count()
    support = max(2, math.ceil(SUPPORT_SHARE * n))
    itemsets = ops.frequent_itemsets(tx, support, heavy_basket=4, distinct=True)
    return itemsets.select("size", _joined("items").alias("items"), "support")


def itemset_counts(spark, sf_dir):
    return ops.itemset_counts(_mined(spark, sf_dir)[0])


def itemsets_top10(spark, sf_dir):
    top = ops.top_itemsets(_mined(spark, sf_dir)[0])
    return top.select("size", "rank", _joined("items").alias("items"), "support")


def itemset_report(spark, sf_dir):
    return ops.itemset_report(_mined(spark, sf_dir)[0], _dictionary(spark, sf_dir))


def _rules(spark, sf_dir):
    itemsets, n = _mined(spark, sf_dir)
    return ops.association_rules(itemsets, n)


def _shown(rules):
    return rules.select(
        _joined("antecedent").alias("antecedent"),
        _joined("consequent").alias("consequent"),
        *[F.round(c, 9).alias(c) for c in ("confidence", "interest", "lift", "standardized_lift")],
    )


def rules_all(spark, sf_dir):
    return _shown(_rules(spark, sf_dir))


def rules_filtered(spark, sf_dir):
    return _shown(ops.strong_rules(_rules(spark, sf_dir), STRONG))


def rule_report(spark, sf_dir):
    strong = ops.strong_rules(_rules(spark, sf_dir), STRONG)
    return ops.rule_report(strong, _dictionary(spark, sf_dir)).select(
        _joined("antecedent").alias("antecedent"), _joined("consequent").alias("consequent"), "line"
    )


def item_dictionary(spark, sf_dir):
    return _dictionary(spark, sf_dir)


def baskets(spark, sf_dir):
    """Distinct items of each basket in long form, with the basket's size."""
    tx = transactions(spark, sf_dir)
    sizes = tx.groupBy("basket").agg(F.count(F.lit(1)).alias("n_items"))
    return tx.join(sizes, "basket")


_TX = """
tx AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS basket, p_brand AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey),
nb AS (SELECT count(DISTINCT basket) AS n FROM tx),
"""
_ITEMSETS = f"""{_TX}
ms AS (SELECT greatest(2, ceil({SUPPORT_SHARE} * n)) AS s FROM nb),
s1 AS (SELECT item AS items, count(*) AS support FROM tx GROUP BY 1 HAVING count(*) >= (SELECT s FROM ms)),
s2 AS (
  SELECT a.item || ',' || b.item AS items, count(*) AS support
  FROM tx a JOIN tx b ON a.basket = b.basket AND a.item < b.item
  GROUP BY 1 HAVING count(*) >= (SELECT s FROM ms)),
s3 AS (
  SELECT a.item || ',' || b.item || ',' || c.item AS items, count(*) AS support
  FROM tx a JOIN tx b ON a.basket = b.basket AND a.item < b.item
  JOIN tx c ON b.basket = c.basket AND b.item < c.item
  GROUP BY 1 HAVING count(*) >= (SELECT s FROM ms)),
sets AS (
  SELECT 1 AS size, items, support FROM s1 UNION ALL SELECT 2, items, support FROM s2
  UNION ALL SELECT 3, items, support FROM s3)
"""
_TOP = f"""{_ITEMSETS},
top AS (
  SELECT size, CAST(rank AS INTEGER) AS rank, items, support FROM (
    SELECT *, row_number() OVER (PARTITION BY size ORDER BY support DESC, string_split(items, ',')) AS rank FROM sets)
  WHERE rank <= 10)
"""
_DICT = "dict AS (SELECT p_brand AS item, min(p_type) AS description FROM part GROUP BY 1)"
_RULES = f"""{_ITEMSETS},
sp AS (SELECT size, string_split(items, ',') AS i, support FROM sets WHERE size >= 2),
pick AS (SELECT unnest([[1],[2],[3],[1,2],[1,3],[2,3]]) AS p),
sides AS (
  SELECT list_transform(p, lambda x: i[x]) AS a, i, support
  FROM sp JOIN pick ON list_max(p) <= size AND len(p) < size),
named AS (
  SELECT array_to_string(a, ',') AS antecedent,
         array_to_string(list_filter(i, lambda x: NOT list_contains(a, x)), ',') AS consequent, support
  FROM sides),
probs AS (
  SELECT antecedent, consequent, named.support / sa.support AS confidence,
         sa.support / n AS p_a, sb.support / n AS p_b
  FROM named JOIN sets sa ON antecedent = sa.items JOIN sets sb ON consequent = sb.items, nb),
bounds AS (
  SELECT *, confidence / p_b AS lift, confidence - p_b AS interest,
         least(1 / p_a, 1 / p_b) AS hi, greatest((p_a + p_b - 1) / (p_a * p_b), 0) AS lo
  FROM probs),
rules AS (
  SELECT antecedent, consequent, confidence, interest, lift,
         CASE WHEN hi = lo THEN 0 ELSE (lift - lo) / (hi - lo) END AS standardized_lift
  FROM bounds)
"""
_SHOWN = """SELECT antecedent, consequent, round(confidence, 9) AS confidence, round(interest, 9) AS interest,
  round(lift, 9) AS lift, round(standardized_lift, 9) AS standardized_lift FROM rules"""

QUERIES = {
    "baskets": baskets,
    "item_dictionary": item_dictionary,
    "itemsets_1": _itemsets_of(1),
    "itemsets_2": _itemsets_of(2),
    "itemsets_3": _itemsets_of(3),
    "itemsets_median": itemsets_median,
    "itemsets_past_long_baskets": itemsets_past_long_baskets,
    "itemset_counts": itemset_counts,
    "itemsets_top10": itemsets_top10,
    "itemset_report": itemset_report,
    "rules_all": rules_all,
    "rules_filtered": rules_filtered,
    "rule_report": rule_report,
}

ORACLES = {
    "baskets": f"WITH {_TX} sizes AS (SELECT basket, count(*) AS n_items FROM tx GROUP BY 1) "
    "SELECT tx.basket, item, n_items FROM tx JOIN sizes ON tx.basket = sizes.basket",
    "item_dictionary": f"WITH {_DICT} SELECT item, description FROM dict",
    **{f"itemsets_{k}": f"WITH {_ITEMSETS} SELECT items, support FROM s{k}" for k in (1, 2, 3)},
    "itemsets_past_long_baskets": "WITH "
    + _ITEMSETS.replace("l_partkey = p_partkey)", "l_partkey = p_partkey UNION SELECT 'every', p_brand FROM part)", 1)
    + " SELECT size, items, support FROM sets",
    "itemsets_median": f"""WITH {_ITEMSETS},
high AS (SELECT ceil(median(support)) AS s FROM s2)
SELECT size, items, support FROM sets WHERE support >= (SELECT s FROM high)""",
    "itemset_counts": f"WITH {_ITEMSETS} SELECT size, count(*) AS n FROM sets GROUP BY 1",
    "itemsets_top10": f"WITH {_TOP} SELECT size, rank, items, support FROM top",
    "itemset_report": f"""WITH {_TOP}, {_DICT},
shown AS (
  SELECT size, rank, support, string_agg(item || ' (' || description || ')', ', ' ORDER BY item) AS txt
  FROM (SELECT size, rank, support, unnest(string_split(items, ',')) AS item FROM top)
  JOIN dict USING (item) GROUP BY ALL)
SELECT 0 AS section, k AS rank,
  'Count of frequent itemsets (size ' || k || '): ' || (SELECT count(*) FROM sets WHERE size = k) AS line
FROM (SELECT unnest([1, 2, 3]) AS k)
UNION ALL SELECT size, rank, txt || ' -> support: ' || support FROM shown""",
    "rules_all": f"WITH {_RULES} {_SHOWN}",
    "rules_filtered": f"WITH {_RULES} {_SHOWN} WHERE standardized_lift >= {STRONG}",
    "rule_report": f"""WITH {_RULES}, {_DICT}
SELECT antecedent, consequent,
  array_to_string(list_transform(string_split(antecedent, ','), lambda x: m[x]), ', ') || ' -> ' ||
  array_to_string(list_transform(string_split(consequent, ','), lambda x: m[x]), ', ') ||
  printf(' | SL: %.4f, lift: %.4f, conf: %.4f, interest: %.4f', standardized_lift, lift, confidence, interest) AS line
FROM rules, (SELECT map(list(item), list(description)) AS m FROM dict)
WHERE standardized_lift >= {STRONG}""",
}
