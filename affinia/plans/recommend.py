"""Queries over ratings: customers rate suppliers (or parts) by the quantity they order."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinia.operators import recommend as rec
from affinia.operators import similarity as sim
from affinia.operators.sampling import sample_keys, split
from affinia.plans.tables import table
from affinia.session import store

TABLES, SEED = 5, 42


def raw_ratings(spark, sf_dir, item="l_suppkey"):
    """One row per order line; a customer may rate the same item several times."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", item, "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user"),
        F.col(item).alias("item"),
        (F.col("l_quantity") / 10).alias("rating"),
        F.col("l_shipdate").alias("ts"),
    )


def ratings(spark, sf_dir, item="l_suppkey"):
    return sim.dedup_ratings(raw_ratings(spark, sf_dir, item))


def split_ratings(spark, sf_dir, item="l_suppkey"):
    both = store(ratings(spark, sf_dir, item), "ratings")
    train, held_out = split(both, ["user", "item"], 90, SEED)
    return store(train, "train"), held_out


def near_items(train, symmetric=True, method="lsh"):
    options = {"tables": TABLES, "seed": SEED} if method == "lsh" else {}
    return sim.stored_neighbours(train, method, symmetric, **options)


def titles(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("item"), F.col("s_name").alias("title")
    )


def _shown(df):
    return df.withColumn("predicted", F.round("predicted", 6))


def ratings_dedup(spark, sf_dir):
    return ratings(spark, sf_dir)


def split_counts(spark, sf_dir):
    return rec.split_counts(*split_ratings(spark, sf_dir))


def cf_user_sample(spark, sf_dir):
    train, _ = split_ratings(spark, sf_dir)
    return sample_keys(train, "user").groupBy("user").agg(F.count(F.lit(1)).alias("n_ratings"))


def item_users(spark, sf_dir):
    return sim.item_users(ratings(spark, sf_dir, "l_partkey"))


def item_similarity_exact(spark, sf_dir):
    similar = sim.item_similarity(store(ratings(spark, sf_dir, "l_partkey"), "ratings"))
    return similar.withColumn("similarity", F.round("similarity", 9))


LEAST = 0.05  # about one pair in thirty at the middle scale


def item_similarity_bounded(spark, sf_dir):
    similar = sim.item_similarity_bounded(store(ratings(spark, sf_dir, "l_partkey"), "ratings"), LEAST)
    return similar.withColumn("similarity", F.round("similarity", 9))


def item_similarity_lsh(spark, sf_dir):
    similar = sim.item_similarity_lsh(
        store(ratings(spark, sf_dir, "l_partkey"), "ratings"), TABLES, seed=SEED
    )
    return similar.withColumn("similarity", F.round("similarity", 9))


def unseen_pairs(spark, sf_dir):
    train, _ = split_ratings(spark, sf_dir)
    return rec.unseen_pairs(train, near_items(train))


def cf_predict(spark, sf_dir):
    train, _ = split_ratings(spark, sf_dir)
    similar = store(sim.item_similarity_lsh(train, TABLES, seed=SEED), "similarity")
    unseen = rec.predict_unseen(train, sim.neighbours(similar))
    rated = rec.predict_pairs(train, train, sim.neighbours(similar, symmetric=False))
    return _shown(
        unseen.select(F.lit("unseen").alias("targets"), "*").unionByName(
            rated.select(F.lit("rated").alias("targets"), "*")
        )
    )


# Parts are many and seldom bought together: with this bound most pairs are out of reach.
FAR = 0.9


def _near_parts(train, symmetric=True):
    return sim.stored_neighbours(train, "lsh", symmetric, tables=TABLES, seed=SEED, max_distance=FAR)


def cf_parts_top_n(spark, sf_dir):
    """Top 10 parts of each user that has any in reach."""
    train, _ = split_ratings(spark, sf_dir, "l_partkey")
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))
    return _shown(rec.recommend_items(rec.best_unseen(train, _near_parts(train)), names))


def cf_parts_evaluate(spark, sf_dir):
    """Predictions for the held-out pairs only."""
    train, held_out = split_ratings(spark, sf_dir, "l_partkey")
    result = rec.evaluate(rec.errors(held_out, rec.predict_pairs(held_out, train, _near_parts(train))))
    return result.withColumns({c: F.round(c, 6) for c in ("mae", "rmse")})


def cf_sampled_evaluate(spark, sf_dir):
    """The evaluation on the held-out pairs of 10 % of the users."""
    train, held_out = split_ratings(spark, sf_dir)
    some = sample_keys(held_out, "user")
    predictions = rec.predict_pairs(some, sample_keys(train, "user"), near_items(train, False))
    result = rec.evaluate(rec.errors(some, predictions))
    return result.withColumns({c: F.round(c, 6) for c in ("mae", "rmse")})


def cf_top_n(spark, sf_dir):
    train, _ = split_ratings(spark, sf_dir)
    return _shown(rec.recommend_items(rec.best_unseen(train, near_items(train)), titles(spark, sf_dir)))


def cf_sampled_top_n(spark, sf_dir):
    """Top 10 among the rated items of 10 % of the users, each item seeing larger ids only."""
    train, _ = split_ratings(spark, sf_dir)
    near = near_items(train, symmetric=False)
    sampled = sample_keys(train, "user")
    predictions = rec.predict_pairs(sampled, sampled, near)
    return _shown(rec.recommend_items(predictions, titles(spark, sf_dir), max_rating=5.0))


def cf_preview(spark, sf_dir):
    """The first 50 predictions by (user, item) and by (user, prediction) descending."""
    train, _ = split_ratings(spark, sf_dir)
    near = near_items(train)
    orders = {
        "by_item": [F.col("user"), F.col("item")],
        "by_rating": [F.col("user").desc(), F.round("predicted", 6).desc(), F.col("item")],
    }
    parts = []
    for which, order in orders.items():
        first = lambda some: some.orderBy(*order).limit(50)  # noqa: B023, used at once
        found = first(rec.predict_unseen(train, near, keep=first))
        parts.append(_shown(found).select(F.lit(which).alias("which"), "user", "item", "predicted"))
    return parts[0].unionByName(parts[1])


def first_rating(spark, sf_dir):
    """One true rating per (user, item) of the raw rows."""
    raw = raw_ratings(spark, sf_dir)
    return raw.groupBy("user", "item").agg(F.min("rating").alias("true_rating"))


def _errors(spark, sf_dir, method="lsh"):
    train, held_out = split_ratings(spark, sf_dir)
    # larger ids only, so that some held-out pairs have no neighbour and no prediction
    near = near_items(train, False, method)
    return rec.errors(held_out, rec.predict_pairs(held_out, train, near))


def cf_evaluate(spark, sf_dir, method="lsh"):
    result = rec.evaluate(_errors(spark, sf_dir, method))
    return result.withColumns({c: F.round(c, 6) for c in ("mae", "rmse")})


def cf_evaluate_exact(spark, sf_dir):
    """The same with all similar pairs in place of those found by MinHash."""
    return cf_evaluate(spark, sf_dir, "exact")


def eval_null_guard(spark, sf_dir):
    return rec.null_guard(_errors(spark, sf_dir)).withColumn("mae", F.round("mae", 6))


def _ratings_sql(item):
    return f"""raw AS (
  SELECT o_custkey AS u, {item} AS i, l_quantity / 10 AS rating, l_shipdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings AS (SELECT u, i, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY u, i ORDER BY ts DESC, rating DESC) AS r FROM raw) WHERE r = 1)"""


def _bucket_sql(text):
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) % 100"


def _split_sql(item):
    return f"""{_ratings_sql(item)},
marked AS (SELECT *, {_bucket_sql(f"'{SEED}:' || u || ':' || i")} AS b FROM ratings),
train AS (SELECT u, i, rating FROM marked WHERE b < 90),
val AS (SELECT u, i, rating FROM marked WHERE b >= 90)"""


_SPLIT = _split_sql("l_suppkey")


def _similarity_sql(source):
    """All similar pairs as `every`, those that share a MinHash bucket as `sims`."""
    tables = " UNION ALL ".join(
        f"SELECT {t} AS t, i, min(((u % {sim.PRIME - 1} + 1) * {a} + {b}) % {sim.PRIME}) AS h FROM {source} GROUP BY i"
        for t, (a, b) in enumerate(sim.hash_coefficients(TABLES, SEED))
    )
    return f"""sizes AS (SELECT i, count(*) AS n FROM {source} GROUP BY 1),
shared AS (
  SELECT a.i AS i1, b.i AS i2, count(*) AS n FROM {source} a JOIN {source} b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2),
every AS (
  SELECT i1, i2, shared.n / (x.n + y.n - shared.n) AS s
  FROM shared JOIN sizes x ON x.i = i1 JOIN sizes y ON y.i = i2),
hashed AS ({tables}),
found AS (SELECT DISTINCT a.i AS i1, b.i AS i2 FROM hashed a JOIN hashed b ON a.t = b.t AND a.h = b.h AND a.i < b.i),
sims AS (SELECT i1, i2, s FROM every JOIN found USING (i1, i2))"""


_SIM = f"{_SPLIT}, {_similarity_sql('train')}"
_NEAR = "near AS (SELECT i1 AS i, i2 AS j, s FROM sims UNION ALL SELECT i2, i1, s FROM sims)"
NEAR_SQL = f"{_SIM}, {_NEAR}"
_UNSEEN = f"""{NEAR_SQL},
unseen AS (
  SELECT t.u, near.i, round(sum(s * rating) / sum(abs(s)), 6) AS predicted
  FROM train t JOIN near ON t.i = near.j
  WHERE NOT EXISTS (SELECT 1 FROM train k WHERE k.u = t.u AND k.i = near.i) GROUP BY 1, 2)"""
_RATED = """rated AS (
  SELECT t.u, t.i, sum(s * n.rating) / sum(abs(s)) AS predicted
  FROM train t JOIN sims ON t.i = i1 JOIN train n ON n.u = t.u AND n.i = i2 GROUP BY 1, 2)"""


def _errors_sql(pairs):
    return f"""{_SIM},
scored AS (
  SELECT v.u, v.i, any_value(v.rating) - sum(s * n.rating) / sum(abs(s)) AS error
  FROM val v JOIN {pairs} ON v.i = i1 JOIN train n ON n.u = v.u AND n.i = i2 GROUP BY 1, 2),
errs AS (SELECT v.u, v.i, error FROM val v LEFT JOIN scored s ON v.u = s.u AND v.i = s.i)"""


_EVALUATE = """SELECT count(*) AS n_val, count(error) AS n_scored,
  round(avg(abs(error)), 6) AS mae, round(sqrt(avg(error * error)), 6) AS rmse FROM errs"""

_PARTS = f"""{_split_sql("l_partkey")}, {_similarity_sql("train")},
near AS (
  SELECT i1 AS i, i2 AS j, s FROM sims WHERE 1 - s < {FAR} UNION ALL SELECT i2, i1, s FROM sims WHERE 1 - s < {FAR})"""

QUERIES = {
    "cf_parts_top_n": cf_parts_top_n,
    "cf_parts_evaluate": cf_parts_evaluate,
    "cf_sampled_evaluate": cf_sampled_evaluate,
    "ratings_dedup": ratings_dedup,
    "split_counts": split_counts,
    "cf_user_sample": cf_user_sample,
    "item_users": item_users,
    "item_similarity_exact": item_similarity_exact,
    "item_similarity_bounded": item_similarity_bounded,
    "item_similarity_lsh": item_similarity_lsh,
    "unseen_pairs": unseen_pairs,
    "cf_predict": cf_predict,
    "cf_top_n": cf_top_n,
    "cf_sampled_top_n": cf_sampled_top_n,
    "cf_preview": cf_preview,
    "window_first": first_rating,
    "cf_evaluate": cf_evaluate,
    "cf_evaluate_exact": cf_evaluate_exact,
    "eval_null_guard": eval_null_guard,
}

ORACLES = {
    "cf_parts_top_n": f"""WITH {_PARTS},
unseen AS (
  SELECT t.u, near.i, round(sum(s * rating) / sum(abs(s)), 6) AS predicted
  FROM train t JOIN near ON t.i = near.j
  WHERE NOT EXISTS (SELECT 1 FROM train k WHERE k.u = t.u AND k.i = near.i) GROUP BY 1, 2),
top AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY predicted DESC, i) AS rank FROM unseen)
SELECT u AS "user", CAST(rank AS INTEGER) AS rank, i AS item, p_name AS title, predicted
FROM top LEFT JOIN part ON p_partkey = i WHERE rank <= 10""",
    "cf_parts_evaluate": f"""WITH {_PARTS},
scored AS (
  SELECT v.u, v.i, any_value(v.rating) - sum(s * n.rating) / sum(abs(s)) AS error
  FROM val v JOIN near ON v.i = near.i JOIN train n ON n.u = v.u AND n.i = near.j GROUP BY 1, 2),
errs AS (SELECT v.u, v.i, error FROM val v LEFT JOIN scored s ON v.u = s.u AND v.i = s.i)
{_EVALUATE}""",
    "cf_sampled_evaluate": f"WITH {_errors_sql('sims')} {_EVALUATE} WHERE {_bucket_sql(f"'{SEED}:' || u")} < 10",
    "ratings_dedup": f'WITH {_ratings_sql("l_suppkey")} SELECT u AS "user", i AS item, rating FROM ratings',
    "split_counts": f"""WITH {_SPLIT} SELECT CASE WHEN b < 90 THEN 'train' ELSE 'validation' END AS part,
  count(*) AS n FROM marked GROUP BY 1""",
    "cf_user_sample": f"""WITH {_SPLIT} SELECT u AS "user", count(*) AS n_ratings FROM train
  WHERE {_bucket_sql(f"'{SEED}:' || u")} < 10 GROUP BY 1""",
    "item_users": """WITH p AS (SELECT DISTINCT l_partkey AS item, o_custkey AS u
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT item, u AS "user", count(*) OVER (PARTITION BY item) AS n_users FROM p""",
    "item_similarity_exact": f"""WITH {_ratings_sql("l_partkey")}, {_similarity_sql("ratings")}
SELECT i1 AS item1, i2 AS item2, round(s, 9) AS similarity FROM every""",
    "item_similarity_bounded": f"""WITH {_ratings_sql("l_partkey")}, {_similarity_sql("ratings")}
SELECT i1 AS item1, i2 AS item2, round(s, 9) AS similarity FROM every WHERE s >= {LEAST}""",
    "item_similarity_lsh": f"""WITH {_ratings_sql("l_partkey")}, {_similarity_sql("ratings")}
SELECT i1 AS item1, i2 AS item2, round(s, 9) AS similarity FROM sims""",
    "unseen_pairs": f'WITH {_UNSEEN} SELECT u AS "user", i AS item FROM unseen',
    "cf_predict": f"""WITH {_UNSEEN}, {_RATED}
SELECT 'unseen' AS targets, u AS "user", i AS item, predicted FROM unseen
UNION ALL SELECT 'rated', u, i, round(predicted, 6) FROM rated""",
    "cf_top_n": f"""WITH {_UNSEEN},
top AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY predicted DESC, i) AS rank FROM unseen)
SELECT u AS "user", CAST(rank AS INTEGER) AS rank, i AS item, s_name AS title, predicted
FROM top LEFT JOIN supplier ON s_suppkey = i WHERE rank <= 10""",
    "cf_sampled_top_n": f"""WITH {_SIM}, {_RATED},
chosen AS (
  SELECT u, i, round(least(predicted, 5.0), 6) AS predicted FROM rated WHERE {_bucket_sql(f"'{SEED}:' || u")} < 10),
top AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY predicted DESC, i) AS rank FROM chosen)
SELECT u AS "user", CAST(rank AS INTEGER) AS rank, i AS item, s_name AS title, predicted
FROM top LEFT JOIN supplier ON s_suppkey = i WHERE rank <= 10""",
    "cf_preview": f"""WITH {_UNSEEN}
SELECT * FROM (SELECT 'by_item' AS which, u AS "user", i AS item, predicted FROM unseen ORDER BY u, i LIMIT 50)
UNION ALL
SELECT * FROM (SELECT 'by_rating' AS which, u, i, predicted FROM unseen ORDER BY u DESC, predicted DESC, i LIMIT 50)""",
    "window_first": f"""WITH {_ratings_sql("l_suppkey")}
SELECT DISTINCT u AS "user", i AS item, min(rating) OVER (PARTITION BY u, i) AS true_rating FROM raw""",
    "cf_evaluate": f"WITH {_errors_sql('sims')} {_EVALUATE}",
    "cf_evaluate_exact": f"WITH {_errors_sql('every')} {_EVALUATE}",
    "eval_null_guard": f"""WITH {_errors_sql("sims")}
SELECT 'excluded' AS mode, count(*) - count(error) AS n_null, round(avg(abs(error)), 6) AS mae FROM errs
UNION ALL SELECT 'filled', count(*) - count(error), round(avg(coalesce(abs(error), 0)), 6) FROM errs""",
}
