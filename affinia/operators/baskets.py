"""Frequent itemsets of up to three items and association rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.functions.text import fixed
from affinia.operators.bitmaps import bitmaps, n_common, numbered
from affinia.operators.skew import heavy_keys, spread_join
from affinia.session import store

ITEMS = ("i1", "i2", "i3")
SHORT = 60  # items of a basket that is one row with a list


def item_dictionary(df: DataFrame, item: str, description: str) -> DataFrame:
    """One description per item, the smallest where several are given."""
    return df.groupBy(F.col(item).alias("item")).agg(F.min(description).alias("description"))


def frequent_itemsets(
    tx: DataFrame,
    min_support: int,
    max_size: int = 3,
    heavy_basket: int = 2000,
    distinct: bool = False,
) -> DataFrame:
    """Itemsets held by at least `min_support` baskets: `(size, items, support)`.

    `tx` is `(basket, item)`; duplicates count once (`distinct` says that there are none)
    and items are sorted as strings.
    Each level is written once, because the next one is pruned by it: pairs are built
    from frequent items only, triples from frequent pairs only. Baskets of up to `SHORT` frequent items are gathered
    once as lists, whose pairs and triples are formed and counted where they lie; the others are joined.

    Baskets with more than `heavy_basket` frequent items would yield the square of
    their length. Up to `min_support - 1` of the longest are therefore set aside: an
    itemset that reaches the threshold with their help still has
    `min_support - (number set aside)` other baskets, so those itemsets are the only
    candidates. Each item has a bitmap of the long baskets that hold it, and a candidate's long baskets are
    the common bits of its items, so no pair or triple of a long basket is formed. The result is exact.
    Long baskets beyond that number are joined in slices.
    """
    tx = tx.select("basket", "item")
    if not distinct:
        tx = store(tx.distinct(), "transactions")
    level = store(
        tx.groupBy("item").agg(F.count(F.lit(1)).alias("support")).filter(F.col("support") >= min_support),
        "itemsets1",
    )
    found = [_as_itemsets(level.withColumnRenamed("item", "i1"), 1)]
    if max_size == 1:
        return found[0]

    kept = store(tx.join(level, "item", "left_semi").select("basket", "item"), "kept")
    long = heavy_keys(kept, "basket", heavy_basket, 1000)
    heavy, sliced = long[: min_support - 1], long[min_support - 1 :]
    light = kept.filter(~F.col("basket").isin(heavy)) if heavy else kept
    if heavy:
        held = store(bitmaps(numbered(kept, "basket", heavy), "item", len(heavy)), "long_baskets")

    lists, others = _short(light, sliced)
    joined = None if others is None else _pairs(others, sliced)
    for size in range(2, max_size + 1):
        keys = list(ITEMS[:size])
        occurrences = _listed_pairs(lists) if size == 2 else _listed_triples(lists, level)
        if size == 3 and joined is not None:
            joined = _triples(joined, level, sliced)
        if joined is not None:
            occurrences = occurrences.select(*keys).unionByName(joined.select(*keys))
        counts = occurrences.groupBy(*keys).agg(F.count(F.lit(1)).alias("support"))
        if heavy:
            counts = counts.filter(F.col("support") >= min_support - len(heavy))
            counts = _probe(store(counts, "candidates"), held, keys)
        level = store(counts.filter(F.col("support") >= min_support), f"itemsets{size}")
        found.append(_as_itemsets(level, size))
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def _short(light: DataFrame, sliced: list) -> tuple[DataFrame, DataFrame | None]:
    """Short baskets as sorted lists `(items)`, and the rows of the others, if there are any.

    A basket is known to be short before its items are gathered, so no list is longer than `SHORT`.
    """
    named = light.filter(F.col("basket").isNotNull())
    rest = named.filter(~F.col("basket").isin(sliced)) if sliced else named
    sized = rest.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("basket")))
    alone = F.when(F.col("n") > SHORT, F.col("item")).alias("alone")  # a row an item, or null: one a basket
    gathered = sized.groupBy("basket", alone).agg(F.array_sort(F.collect_list("item")).alias("items"))
    gathered = store(gathered.filter(F.col("alone").isNotNull() | (F.size("items") > 1)), "lists")
    long = gathered.filter(F.col("alone").isNotNull()).select("basket", F.col("alone").alias("item"))
    if sliced:
        long = long.unionByName(named.filter(F.col("basket").isin(sliced)).select("basket", "item"))
    elif long.isEmpty():
        long = None
    return gathered.filter(F.col("alone").isNull()).select("items"), long


def _listed_pairs(lists: DataFrame) -> DataFrame:
    first = lists.select("items", F.posexplode("items").alias("at", "i1"))
    after = F.slice("items", F.col("at") + 2, F.size("items"))
    return first.select("i1", F.explode(after).alias("i2"))


def _listed_triples(lists: DataFrame, frequent: DataFrame) -> DataFrame:
    """Triples of the lists whose three pairs are all frequent."""
    first = lists.select("items", F.posexplode("items").alias("at", "i1"))
    after = first.select("i1", F.slice("items", F.col("at") + 2, F.size("items")).alias("items"))
    pairs = after.select("i1", "items", F.posexplode("items").alias("at", "i2")).join(
        frequent.select("i1", "i2"), ["i1", "i2"], "left_semi"
    )
    found = pairs.select("i1", "i2", F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("i3"))
    for a, b in (("i1", "i3"), ("i2", "i3")):
        found = found.join(frequent.select(F.col("i1").alias(a), F.col("i2").alias(b)), [a, b], "left_semi")
    return found


def _pairs(kept: DataFrame, sliced: list) -> DataFrame:
    first, second = [kept.select("basket", F.col("item").alias(c)) for c in ("i1", "i2")]
    return spread_join(first, second, "basket", sliced).filter(F.col("i1") < F.col("i2"))


def _triples(pairs: DataFrame, frequent: DataFrame, sliced: list) -> DataFrame:
    """Triples whose three pairs are all frequent; the join key is (basket, first item).

    Baskets whose pairs are joined in slices are sliced here as well.
    """
    pairs = pairs.join(frequent, ["i1", "i2"], "left_semi").select("basket", "i1", "i2")
    longer = pairs.withColumnRenamed("i2", "i3")
    tail = frequent.select(F.col("i1").alias("i2"), F.col("i2").alias("i3"))
    return (
        spread_join(pairs, longer, "basket", sliced, more=["i1"])
        .filter(F.col("i2") < F.col("i3"))
        .join(tail, ["i2", "i3"], "left_semi")
    )


def _probe(candidates: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Add the long baskets that hold all items of a candidate to its support.

    `held` has a bitmap of the long baskets for each item; a candidate stays one row.
    """
    rows = candidates
    for key in keys:
        rows = rows.join(held.select(F.col("item").alias(key), F.col("bits").alias(f"_{key}")), key, "left")
    extra = F.coalesce(n_common(*(f"_{key}" for key in keys)), F.lit(0).cast("long"))
    return rows.select(*keys, (F.col("support") + extra).alias("support"))


def _as_itemsets(level: DataFrame, size: int) -> DataFrame:
    return level.select(
        F.lit(size).alias("size"), F.array(*ITEMS[:size]).alias("items"), "support"
    )


def itemset_counts(itemsets: DataFrame) -> DataFrame:
    return itemsets.groupBy("size").agg(F.count(F.lit(1)).alias("n"))


def top_itemsets(itemsets: DataFrame, n: int = 10, sizes=(1, 2, 3)) -> DataFrame:
    """The `n` itemsets of each size with the highest support: `(size, rank, items, support)`."""
    order = [F.col("support").desc(), F.col("items")]
    tops = [itemsets.filter(F.col("size") == size).orderBy(*order).limit(n) for size in sizes]
    top = tops[0]
    for part in tops[1:]:
        top = top.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("size").orderBy(*order))
    return top.select("size", rank.alias("rank"), "items", "support")


def association_rules(itemsets: DataFrame, n_baskets: int | Column) -> DataFrame:
    """All rules of the frequent pairs (1 to 1) and triples (1 to 2, 2 to 1).

    With s the support and P(X) = s(X) / n: confidence = s(AB) / s(A), lift =
    confidence / P(B), interest = confidence - P(B). The standardised lift places the
    lift between its bounds max((P(A) + P(B) - 1) / (P(A) P(B)), 0) and
    min(1 / P(A), 1 / P(B)) and is 0 where the two bounds meet.
    """
    split = {
        2: [[1], [2]],
        3: [[1], [2], [3], [1, 2], [1, 3], [2, 3]],
    }
    places = {
        size: F.array(*[F.array(*[F.lit(p) for p in place]) for place in parts])
        for size, parts in split.items()
    }
    sides = (
        itemsets.filter(F.col("size") >= 2)
        .withColumn("place", F.explode(F.when(F.col("size") == 2, places[2]).otherwise(places[3])))
        .withColumn(
            "antecedent", F.transform("place", lambda p: F.element_at(F.col("items"), p))
        )
        .select(
            "antecedent",
            F.array_except("items", "antecedent").alias("consequent"),
            F.col("support").alias("s_both"),
        )
    )
    known = itemsets.filter(F.col("size") <= 2)
    rules = sides.join(
        known.select(F.col("items").alias("antecedent"), F.col("support").alias("s_a")), "antecedent"
    ).join(known.select(F.col("items").alias("consequent"), F.col("support").alias("s_b")), "consequent")

    n = F.lit(n_baskets) if isinstance(n_baskets, int) else n_baskets
    rules = rules.select(
        "antecedent",
        "consequent",
        (F.col("s_both") / F.col("s_a")).alias("confidence"),
        (F.col("s_a") / n).alias("p_a"),
        (F.col("s_b") / n).alias("p_b"),
    )
    confidence, p_a, p_b = F.col("confidence"), F.col("p_a"), F.col("p_b")
    lift = confidence / p_b
    lowest = F.greatest((p_a + p_b - 1) / (p_a * p_b), F.lit(0.0))
    highest = F.least(1 / p_a, 1 / p_b)
    return rules.select(
        "antecedent",
        "consequent",
        "confidence",
        (confidence - p_b).alias("interest"),
        lift.alias("lift"),
        F.when(highest == lowest, F.lit(0.0))
        .otherwise(F.try_divide(lift - lowest, highest - lowest))
        .alias("standardized_lift"),
    )


def strong_rules(rules: DataFrame, min_standardized_lift: float = 0.2) -> DataFrame:
    """Rules at or above the threshold, strongest first."""
    return rules.filter(F.col("standardized_lift") >= min_standardized_lift).orderBy(
        F.col("standardized_lift").desc(), "antecedent", "consequent"
    )


def describe(df: DataFrame, items: str, dictionary: DataFrame, key: list[str], unknown: Column, show) -> DataFrame:
    """Replace an item array of at most three items by text: `show(item, description)` joined by ', '."""
    parts = df.select(*key, F.posexplode(items).alias("place", "item")).join(dictionary, "item", "left")
    text = show(F.col("item"), F.coalesce("description", unknown))
    lists = parts.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("place", text.alias("text")))).alias("_parts")
    )
    return lists.select(
        *key, F.concat_ws(", ", F.transform("_parts", lambda p: p["text"])).alias(f"{items}_text")
    )


def itemset_report(itemsets: DataFrame, dictionary: DataFrame, n: int = 10, sizes=(1, 2, 3)) -> DataFrame:
    """Report lines `(section, rank, line)`: section 0 counts the itemsets of each
    size, section k lists the best itemsets of size k."""
    # a size without itemsets is reported as 0
    counts = itemset_counts(itemsets).select("size", "n")
    every = itemsets.sparkSession.createDataFrame([(s,) for s in sizes], "size int")
    head = every.join(counts, "size", "left").select(
        F.lit(0).alias("section"),
        F.col("size").alias("rank"),
        F.format_string(
            "Count of frequent itemsets (size %d): %d", "size", F.coalesce("n", F.lit(0).cast("long"))
        ).alias("line"),
    )
    top = top_itemsets(itemsets, n, sizes)
    text = describe(
        top, "items", dictionary, ["size", "rank"], F.lit("Unknown"),
        lambda item, description: F.concat(item, F.lit(" ("), description, F.lit(")")),
    )
    body = top.join(text, ["size", "rank"]).select(
        F.col("size").alias("section"),
        "rank",
        F.concat("items_text", F.lit(" -> support: "), F.col("support").cast("string")).alias("line"),
    )
    return head.unionByName(body)


def rule_report(rules: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One formatted line per rule, `antecedent -> consequent | SL: …`, with the items'
    descriptions; an item without description shows itself."""
    key = ["antecedent", "consequent"]
    # an array used as a key twice is carried as the key and exploded as a copy
    sides = []
    for side in key:
        parts = rules.select(*key, F.col(side).alias("shown"))
        sides.append(
            describe(parts, "shown", dictionary, key, F.col("item"), lambda item, text: text)
            .withColumnRenamed("shown_text", f"{side}_text")
        )
    numbers = ["standardized_lift", "lift", "confidence", "interest"]
    line = F.format_string(
        "%s -> %s | SL: %s, lift: %s, conf: %s, interest: %s",
        "antecedent_text", "consequent_text", *[fixed(c, 4) for c in numbers],
    )
    return rules.join(sides[0], key).join(sides[1], key).select(*key, "standardized_lift", line.alias("line"))
