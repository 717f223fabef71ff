"""Jaccard similarity of items by the users they share: exact, or found by MinHash."""

from __future__ import annotations

import functools
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.skew import heavy_keys, n_parts, n_slices, ranked, spread_join
from affinia.session import store

MASK_BITS = 60  # users that fit into the bits of a long
HOT_ITEM = 100_000  # ratings
MEETINGS = 2_000_000  # pairs of items that a task counts
SHORT = 500  # items of a user whose pairs are all counted to look found ones up
COSTS = 4  # a pair that meets by prefixes costs about as much as so many that are counted
FOUND_ROWS = 2_000_000  # found pairs that are copied to all tasks at once
PRIME = 2_147_483_647  # 2**31 - 1; products of two residues stay within a long


def dedup_ratings(ratings: DataFrame, time: str = "ts") -> DataFrame:
    """One rating per (user, item): the latest, among equal times the highest."""
    latest = F.max_by("rating", F.struct(F.col(time), F.col("rating")))
    return ratings.groupBy("user", "item").agg(latest.alias("rating"))


def item_users(ratings: DataFrame) -> DataFrame:
    """The users of each item in long form, with their number: `(item, user, n_users)`.

    An item's users are never gathered into one value, popular items have too many.
    """
    pairs = ratings.select("item", "user").distinct()
    return pairs.join(_sizes(pairs), "item")


def _sizes(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n_users"))


def item_similarity(
    ratings: DataFrame, max_distance: float = 1.0, heavy_user: int = 10_000, hot_item: int = HOT_ITEM
) -> DataFrame:
    """All item pairs below `max_distance`: `(item1 < item2, similarity)`.

    Each rating sends the later items of its user to the smaller item, as one list, so that the pairs of an
    item are formed and counted in one task and are not shuffled one by one; the items' sizes travel with them. Hot
    items are counted map-side and shuffled as pairs instead.
    Users with more than `heavy_user` items would each contribute the square of their
    length to that count. The longest of them become bits of a mask per item instead: a
    pair of items appears once, with the number of common bits. The next ones are
    joined in slices.
    """
    pairs = store(item_users(ratings), "rated")
    return _jaccard(_all_shared(pairs, heavy_user, hot_item), max_distance)


def _all_shared(pairs: DataFrame, heavy_user: int, hot_item: int = HOT_ITEM) -> DataFrame:
    """`(item1 < item2, n1, n2, n_shared)` of all pairs of items in `(item, user, n_users)`."""
    pairs = pairs.filter("user IS NOT NULL")
    long = heavy_keys(pairs, "user", heavy_user, 1000)
    masked, sliced = long[:MASK_BITS], long[MASK_BITS:]
    shared = _shared_by_lists(pairs.filter(~F.col("user").isin(long)) if long else pairs, hot_item)
    if not long:
        return shared
    shared = shared.select("item1", "item2", "n_shared")
    if sliced:
        some = pairs.filter(F.col("user").isin(sliced)).select("user", "item")
        met = spread_join(some.withColumnRenamed("item", "item1"), some.withColumnRenamed("item", "item2"), "user", sliced)
        met = met.filter(F.col("item1") < F.col("item2")).groupBy("item1", "item2")
        shared = shared.unionByName(met.agg(F.count(F.lit(1)).alias("n_shared")))
    if masked:
        shared = shared.unionByName(_shared_by_mask(pairs.select("user", "item"), masked))
    shared = shared.groupBy("item1", "item2").agg(F.sum("n_shared").alias("n_shared"))
    known = pairs.select("item", "n_users").distinct()
    sizes = [known.select(F.col("item").alias(f"item{i}"), F.col("n_users").alias(f"n{i}")) for i in (1, 2)]
    return shared.join(sizes[0], "item1").join(sizes[1], "item2")


def _shared_by_lists(pairs: DataFrame, hot_item: int) -> DataFrame:
    """`(item1 < item2, n1, n2, n_shared)` over users whose items fit into a list."""
    own = F.sort_array(F.collect_list(F.struct("item", "n_users")))
    lists = pairs.groupBy("user").agg(own.alias("own")).filter(F.size("own") > 1)
    lists = store(lists.select(F.col("own.item").alias("items"), F.col("own.n_users").alias("sizes")), "lists")
    length = F.size("items").cast("long")
    met = lists.agg(F.sum(length * (length - 1) / 2).cast("long")).first()[0]
    placed = lists.select(F.posexplode("items").alias("p", "item1"), "items", "sizes")
    rest = F.greatest(F.size("items") - F.col("p") - 1, F.lit(0))
    later = placed.filter(rest > 0).select(
        "item1",
        F.get("sizes", F.col("p")).alias("n1"),
        F.slice("items", F.col("p") + 2, rest).alias("items"),
        F.slice("sizes", F.col("p") + 2, rest).alias("sizes"),
    )
    hot = heavy_keys(pairs, "item", hot_item, 1000)
    is_hot = F.col("item1").isin(hot)
    n = n_parts(pairs.sparkSession, met, MEETINGS)
    shared = _counted((later.filter(~is_hot) if hot else later).repartition(n, "item1"))
    return shared.unionByName(_counted(later.filter(is_hot))) if hot else shared


def _counted(later: DataFrame) -> DataFrame:
    each = later.select("item1", "n1", F.posexplode("items").alias("p", "item2"), "sizes")
    sized = each.select("item1", "item2", "n1", F.get("sizes", F.col("p")).alias("n2"))
    return sized.groupBy("item1", "item2", "n1", "n2").agg(F.count(F.lit(1)).alias("n_shared"))


def _shared_by_mask(pairs: DataFrame, users: list) -> DataFrame:
    """Item pairs with the number of given users they share, each pair once.

    Items meet at every common user but the pair is kept at the first one only.
    """
    place = F.array_position(F.array(*[F.lit(u) for u in users]), F.col("user")).cast("int") - 1
    bits = pairs.filter(F.col("user").isin(users)).select("item", place.alias("bit"))
    one = F.expr("shiftleft(1L, bit)")
    masks = store(
        bits.join(bits.groupBy("item").agg(F.bit_or(one).alias("mask")), "item"), "masks"
    )
    common = F.col("mask1").bitwiseAND(F.col("mask2"))
    return (
        spread_join(
            masks.select("bit", F.col("item").alias("item1"), F.col("mask").alias("mask1")),
            masks.select("bit", F.col("item").alias("item2"), F.col("mask").alias("mask2")),
            "bit",
            list(range(len(users))),
        )
        .filter((F.col("item1") < F.col("item2")) & (common.bitwiseAND(one - 1) == 0))
        .select("item1", "item2", F.bit_count(common).cast("long").alias("n_shared"))
    )


def _jaccard(shared: DataFrame, max_distance: float) -> DataFrame:
    """`shared (item1, item2, n1, n2, n_shared)` to similarities."""
    similarity = F.col("n_shared") / (F.col("n1") + F.col("n2") - F.col("n_shared"))
    return shared.select("item1", "item2", similarity.alias("similarity")).filter(
        1 - F.col("similarity") < max_distance
    )


def hash_coefficients(tables: int, seed: int) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(tables)]


def minhash(pairs: DataFrame, tables: int = 5, seed: int = 42) -> DataFrame:
    """`(item, n_users, bucket)`, one bucket per hash table: the smallest hash of the item's users.

    A minimum is combined map-side, so an item's users never meet in one place.
    """
    if pairs.schema["user"].dataType.typeName() == "string":
        number = F.pmod(F.xxhash64("user"), F.lit(PRIME - 1))
    else:
        number = F.pmod(F.col("user").cast("long"), F.lit(PRIME - 1))
    hashed = pairs.select("item", (number + 1).alias("u"))
    lowest = hashed.groupBy("item").agg(
        F.count(F.lit(1)).alias("n_users"),
        *[
            F.min((F.col("u") * a + b) % PRIME).alias(f"h{t}")
            for t, (a, b) in enumerate(hash_coefficients(tables, seed))
        ],
    )
    buckets = [F.lit(t).cast("long") * (PRIME + 1) + F.col(f"h{t}") for t in range(tables)]
    return lowest.select("item", "n_users", F.explode(F.array(*buckets)).alias("bucket"))


def item_similarity_lsh(
    ratings: DataFrame,
    tables: int = 5,
    max_distance: float = 1.0,
    seed: int = 42,
    heavy_bucket: int = 10_000,
) -> DataFrame:
    """Item pairs that share a MinHash bucket, with their exact similarity.

    Finds a pair of similarity s with probability 1 - (1 - s)^tables, so it leaves out
    mostly pairs that hardly matter. The similarity
    of a found pair is exact: users of both are counted (see `_with_shared`).
    """
    pairs = store(ratings.select("user", "item").distinct(), "rated")
    buckets = store(minhash(pairs, tables, seed), "buckets")
    heavy = heavy_keys(buckets, "bucket", heavy_bucket, 1000)
    sides = [
        buckets.select("bucket", F.col("item").alias(f"item{i}"), F.col("n_users").alias(f"n{i}")) for i in (1, 2)
    ]
    first_is_rarer = F.col("n1") <= F.col("n2")
    found = store(
        spread_join(*sides, "bucket", heavy)
        .filter(F.col("item1") < F.col("item2"))
        .select(
            F.when(first_is_rarer, F.col("item1")).otherwise(F.col("item2")).alias("item"),
            F.when(first_is_rarer, F.col("item2")).otherwise(F.col("item1")).alias("other"),
            F.least("n1", "n2").alias("n1"),
            F.greatest("n1", "n2").alias("n2"),
        )
        .distinct(),
        "found",
    )
    return _jaccard(_with_shared(found, pairs, heavy_bucket, SHORT), max_distance)


def _with_shared(found: DataFrame, pairs: DataFrame, heavy: int, short: int = 0, hot_item: int = HOT_ITEM) -> DataFrame:
    """`(item1, item2, n1, n2, n_shared)` of found pairs (item the rarer one, other, n1, n2).

    All pairs of users with up to `short` items are counted beside the found ones (see `_marked`).
    For longer lists the partners of each item are copied to all tasks, at most FOUND_ROWS pairs at a time, and compared with the
    lists of the users' items: only what a user has of both leaves the task. Users with more than
    `heavy` items are looked up by joins (see `_looked_up`).
    """
    pairs = pairs.filter("user IS NOT NULL")
    long = heavy_keys(pairs, "user", heavy, 1000)
    is_long = F.col("user").isin(long) if long else F.lit(False)
    lists = pairs.filter(~is_long).groupBy("user").agg(F.sort_array(F.collect_list("item")).alias("items"))
    lists = store(lists.filter(F.size("items") > 1).select("items"), "lists")
    counts = []
    if short:
        marked = _marked(found, lists.filter(F.size("items") <= short), pairs, hot_item)
        lists = lists.filter(F.size("items") > short)
        if not long and lists.isEmpty():
            return marked
        first_is_rarer = F.col("n1") <= F.col("n2")
        either = [F.when(first_is_rarer, F.col(x)).otherwise(F.col(y)) for x, y in (("item1", "item2"), ("item2", "item1"))]
        counts.append(marked.select(either[0].alias("item"), either[1].alias("other"), "n_shared"))
    slices = 0 if short and lists.isEmpty() else n_slices(found.count(), FOUND_ROWS)
    for k in range(slices):
        # by both items, so that an item with very many partners is cut as well
        some = found.filter(F.pmod(F.xxhash64("item", "other"), F.lit(slices)) == k)
        partners = some.groupBy("item").agg(F.collect_list("other").alias("others"))
        met = lists.select(F.explode("items").alias("item"), "items").join(F.broadcast(partners), "item")
        both = met.select("item", F.explode(F.array_intersect("others", "items")).alias("other"))
        counts.append(store(both.groupBy("item", "other").agg(F.count(F.lit(1)).alias("n_shared")), "shared"))
    if long:
        counts.append(_looked_up(found, pairs.filter(is_long), heavy))
    shared = functools.reduce(DataFrame.union, counts)
    if len(counts) > slices:
        shared = shared.groupBy("item", "other").agg(F.sum("n_shared").alias("n_shared"))
    return shared.join(found, ["item", "other"]).select(
        F.least("item", "other").alias("item1"), F.greatest("item", "other").alias("item2"), "n1", "n2", "n_shared"
    )


def _marked(found: DataFrame, lists: DataFrame, pairs: DataFrame, hot_item: int) -> DataFrame:
    """`(item1 < item2, n1, n2, n_shared)` of found pairs (item, other, n1, n2) that share users of the given `lists`.

    Pairs are counted as in `_shared_by_lists`. The found ones travel with them as lists and tell which counts to keep, so that
    no pair is shuffled by itself and the work does not grow with their number.
    """
    length = F.size("items").cast("long")
    met = lists.agg(F.sum(length * (length - 1) / 2).cast("long")).first()[0]
    rest = F.greatest(F.size("items") - F.col("p") - 1, F.lit(0))
    placed = lists.select(F.posexplode("items").alias("p", "item1"), "items")
    later = placed.filter(rest > 0).select("item1", F.slice("items", F.col("p") + 2, rest).alias("items"))
    later = later.withColumn("sizes", F.lit(None).cast("array<struct<n1: bigint, n2: bigint>>"))
    forward = F.col("item") < F.col("other")
    marks = found.select(
        F.when(forward, F.col("item")).otherwise(F.col("other")).alias("item1"),
        F.when(forward, F.col("other")).otherwise(F.col("item")).alias("item2"),
        F.when(forward, F.struct("n1", "n2")).otherwise(F.struct(F.col("n2").alias("n1"), F.col("n1").alias("n2"))).alias("n"),
    )
    marks = marks.groupBy("item1").agg(F.collect_list(F.struct("item2", "n")).alias("m"))
    rows = later.unionByName(marks.select("item1", F.col("m.item2").alias("items"), F.col("m.n").alias("sizes")))
    n = n_parts(pairs.sparkSession, met, MEETINGS)
    hot = heavy_keys(pairs, "item", hot_item, 1000)
    is_hot = F.col("item1").isin(hot)
    counted = _kept((rows.filter(~is_hot) if hot else rows).repartition(n, "item1"))
    return counted.unionByName(_kept(rows.filter(is_hot))) if hot else counted


def _kept(rows: DataFrame) -> DataFrame:
    each = rows.select("item1", F.posexplode("items").alias("p", "item2"), "sizes")
    size = F.get("sizes", F.col("p"))
    sized = each.select("item1", "item2", size["n1"].alias("n1"), size["n2"].alias("n2"))
    shared = F.count_if(F.col("n1").isNull()).alias("n_shared")
    sums = sized.groupBy("item1", "item2").agg(F.max("n1").alias("n1"), F.max("n2").alias("n2"), shared)
    return sums.filter("n1 IS NOT NULL AND n_shared > 0")


def _looked_up(found: DataFrame, pairs: DataFrame, heavy: int) -> DataFrame:
    """`(item, other, n_shared)`: the users of the rarer item are looked up in the other.

    Items with very many partners are joined in slices.
    """
    busy = heavy_keys(found, "item", heavy, 1000)
    return (
        spread_join(found.select("item", "other"), pairs, "item", busy)
        .join(pairs.withColumnRenamed("item", "other"), ["other", "user"], "left_semi")
        .groupBy("item", "other")
        .agg(F.count(F.lit(1)).alias("n_shared"))
    )


def prefixes(pairs: DataFrame, least: float) -> DataFrame:
    """`(item, user, place, n_users)`: the rarest users of each item, enough of them to meet its like.

    With users in one order, rarest first, two items of n1 and n2 users and similarity `least` or more share
    one of the first n - ceil(least * n) + 1 users of either. Places count from 1.
    """
    rarity = pairs.groupBy("user").agg(F.count(F.lit(1)).alias("n_items"))
    sized = pairs.join(rarity, "user").join(_sizes(pairs), "item")
    placed = ranked(sized, ["item"], ["n_items", "user"], "place")
    length = F.col("n_users") - F.ceil(F.lit(least) * F.col("n_users") - 1e-9) + 1
    return placed.filter(F.col("place") <= length).select("item", "user", "place", "n_users")


def candidates(pairs: DataFrame, least: float, heavy_user: int = 10_000) -> DataFrame:
    """Pairs (item the rarer one, other, n1, n2) that may have similarity `least` or more, all such among them.

    Items meet at the users of their prefixes. A meeting counts if the sizes allow the similarity, and if enough
    users are left after it in both, as they are at the first user that a similar pair shares.
    """
    return _meeting(store(prefixes(pairs, least), "prefixes"), least, heavy_user)


def _meeting(first: DataFrame, least: float, heavy_user: int) -> DataFrame:
    hot = heavy_keys(first, "user", heavy_user, 1000)
    sides = [
        first.select("user", F.col("item").alias(f"item{i}"), F.col("place").alias(f"p{i}"), F.col("n_users").alias(f"n{i}"))
        for i in (1, 2)
    ]
    needed = F.ceil(F.lit(least / (1 + least)) * (F.col("n1") + F.col("n2")) - 1e-9)
    left = 1 + F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2"))
    smaller = (F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("item1") < F.col("item2")))
    met = spread_join(*sides, "user", hot).filter(
        smaller & (F.col("n1") >= F.lit(least) * F.col("n2") - 1e-9) & (left >= needed)
    )
    return met.select(F.col("item1").alias("item"), F.col("item2").alias("other"), "n1", "n2").distinct()


def item_similarity_bounded(ratings: DataFrame, least: float, heavy_user: int = 10_000) -> DataFrame:
    """All item pairs of similarity `least` (above 0) or more, exact: `(item1 < item2, similarity)`.

    Pairs below the bound are hardly ever formed: see `candidates`. A user with very many items
    takes part only for items whose users are all as busy.
    """
    if not 0 < least <= 1:
        raise ValueError("the bound must lie above 0, up to 1")
    pairs = store(item_users(ratings), "rated")
    first = store(prefixes(pairs.select("item", "user"), least), "prefixes")
    if COSTS * _meetings(first) < _meetings(pairs):
        found = store(_meeting(first, least, heavy_user), "found")
        shared = _with_shared(found, pairs.select("item", "user"), heavy_user)
    else:  # a low bound spares so few users that looking all found pairs up costs more than to count them all
        shared = _all_shared(pairs, heavy_user)
    return _jaccard(shared, 2.0).filter(F.col("similarity") >= least - 1e-12)


def _meetings(pairs: DataFrame) -> float:
    """How many pairs of items meet at the users of `pairs`."""
    n = pairs.groupBy("user").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return n.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0.0


def neighbours(similar: DataFrame, symmetric: bool = True) -> DataFrame:
    """`(item, neighbour, similarity)`. Symmetric: both directions of each pair;
    otherwise an item sees only neighbours with a larger id."""
    forward = F.struct(F.col("item1").alias("item"), F.col("item2").alias("neighbour"), "similarity")
    if not symmetric:
        return similar.select(forward.alias("p")).select("p.*")
    backward = F.struct(F.col("item2").alias("item"), F.col("item1").alias("neighbour"), "similarity")
    return similar.select(F.inline(F.array(forward, backward)))


def stored_neighbours(ratings: DataFrame, method: str = "lsh", symmetric: bool = True, **options) -> DataFrame:
    """Similarities written once, since prediction and evaluation both read them."""
    build = {"exact": item_similarity, "lsh": item_similarity_lsh}[method]
    return neighbours(store(build(ratings, **options), "similarity"), symmetric)
