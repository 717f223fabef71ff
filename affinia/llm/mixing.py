"""Mixing sources to target weights: raking (iterative proportional fitting) and sampling."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.names import apart
from affinia.session import store

DIMENSIONS = ("source", "lang", "topic")
MOST = 512  # with more classes in a dimension the factors are raked as tables and not on the driver
BROADCAST_ROWS = 200_000  # factors of a dimension that are broadcast; more are joined
SWEEPS = 20
#: Targets are the natural shares to these powers: below 1, large classes give to small ones.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
REST = "\x00rest"
MISSING = "\x00null"
SEED = 17
_UNIT = 1 << 52

#: What a text is about, by the first pattern it contains.
TOPICS = {
    "legal": "(?i)licen[cs]e|rights reserved|copyright",
    "contact": "[0-9a-z]@[0-9a-z]",
    "table": r" \| ",
}


def topic(text: Column) -> Column:
    found = F.lit("prose")
    for name, pattern in reversed(TOPICS.items()):
        found = F.when(text.rlike(pattern), F.lit(name)).otherwise(found)
    return F.coalesce(found, F.lit("prose"))


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the doc_id only; rows without one share a number."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(_UNIT))


def features(docs: DataFrame) -> DataFrame:
    """`docs` with `_source`, `_lang`, `_topic` (null is a class of its own) and `_tokens`."""
    columns = {f"_{d}": F.coalesce(F.col(d).cast("string"), F.lit(MISSING)) for d in DIMENSIONS[:2]}
    return docs.withColumns(columns | {"_topic": topic(F.col("text")), "_tokens": n_tokens(F.col("text"))})


def cell_table(rows: DataFrame, most: int = MOST) -> tuple[list[list[str]], np.ndarray]:
    """Tokens of each (source, lang, topic): the classes of each dimension and a cube.

    The `most` classes with most tokens of each dimension stand for themselves, all others
    are one class, so at most (most + 1)^2 * 4 sums reach the driver, however large the input.
    """
    names, cube = [], rows.groupBy(*(f"_{d}" for d in DIMENSIONS)).agg(F.sum("_tokens").alias("tokens"))
    cube = store(cube, "cells")
    for d in DIMENSIONS:
        top = cube.groupBy(f"_{d}").agg(F.sum("tokens").alias("n")).orderBy(F.desc("n"), f"_{d}").limit(most + 1)
        found = sorted((-r.n, r[0]) for r in top.collect())
        names.append(sorted(name for _, name in found[:most]) + ([REST] if len(found) > most else []))
        if len(found) > most:
            known = F.array(*map(F.lit, names[-1]))
            cube = cube.withColumn(f"_{d}", F.when(F.array_contains(known, F.col(f"_{d}")), F.col(f"_{d}")).otherwise(REST))
    sums = cube.groupBy(*(f"_{d}" for d in DIMENSIONS)).agg(F.sum("tokens").alias("tokens")).collect()
    tokens = np.zeros([len(n) for n in names])
    place = [{v: i for i, v in enumerate(n)} for n in names]
    for r in sums:
        tokens[tuple(place[i][r[i]] for i in range(3))] = r.tokens
    return names, tokens


def tempered(tokens: np.ndarray, axis: int, power: float) -> np.ndarray:
    """Target shares of the classes along an axis: natural shares to a power."""
    sums = tokens.sum(axis=tuple(i for i in range(tokens.ndim) if i != axis))
    share = np.where(sums > 0, (sums / max(sums.sum(), 1)) ** power, 0.0)
    return share / share.sum() if share.sum() else share


def rake(tokens: np.ndarray, targets: list[np.ndarray], sweeps: int = SWEEPS) -> list[np.ndarray]:
    """A factor for each class so that the weighted tokens have the target marginals.

    A weight is the product of its factors. Each step fits one marginal and so disturbs the
    others less and less. Classes without tokens or without a target keep the factor 1 or get 0.
    """
    factors = [np.ones(n) for n in tokens.shape]
    weighted = tokens.astype(float)
    total = tokens.sum()
    for _ in range(sweeps):
        for axis, target in enumerate(targets):
            now = weighted.sum(axis=tuple(i for i in range(tokens.ndim) if i != axis))
            step = np.divide(target * total, now, out=np.ones_like(now), where=now > 0)
            factors[axis] *= step
            weighted *= step.reshape([-1 if i == axis else 1 for i in range(tokens.ndim)])
    return factors


def _target_shares(cells: DataFrame, d: str, given: Mapping[str, float] | None) -> DataFrame:
    """(_d, target): the shares of all classes of a dimension, as `weighted` describes them."""
    sums = cells.groupBy(f"_{d}").agg(F.sum("tokens").alias("n"))
    total = sums.agg(F.sum("n").cast("double")).first()[0] or 1.0
    share = F.col("n").cast("double") / F.lit(total)
    if given is None:
        shares = sums.select(f"_{d}", F.pow(share, F.lit(POWERS[d])).alias("target"))
    else:
        named = sums.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()], f"_{d} string, given double")
        both = sums.select(f"_{d}", share.alias("share")).join(named, f"_{d}", "left")
        open_ = F.when(F.col("given").isNull(), F.col("share"))
        free, taken = both.agg(F.sum(open_), F.sum("given")).first()
        left = max(0.0, 1 - (taken or 0.0)) / max(free or 0.0, 1e-300)
        shares = both.select(f"_{d}", F.coalesce("given", F.col("share") * F.lit(left)).alias("target"))
    whole = shares.agg(F.sum("target")).first()[0] or 1.0
    return shares.select(f"_{d}", (F.col("target") / F.lit(whole)).alias("target"))


def _with_factors(cells: DataFrame, factors: Mapping[str, DataFrame]) -> DataFrame:
    """`cells` with `_weight`, the product of the factors of its classes."""
    for d in DIMENSIONS:
        cells = cells.join(factors[d], f"_{d}")
    weight = F.col("_factor_source") * F.col("_factor_lang") * F.col("_factor_topic")
    return cells.withColumn("_weight", weight).drop(*(f"_factor_{d}" for d in DIMENSIONS))


def rake_tables(
    cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, sweeps: int | None = None
) -> tuple[dict[str, DataFrame], float]:
    """`rake` for any number of classes: (_d, _factor_d) of each dimension and the largest weight."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    wanted = {d: store(_target_shares(cells, d, (targets or {}).get(d)), "targets") for d in DIMENSIONS}
    factors = {d: t.select(f"_{d}", F.lit(1.0).alias(f"_factor_{d}")) for d, t in wanted.items()}
    for _ in range(SWEEPS if sweeps is None else sweeps):
        for d in DIMENSIONS:
            now = _with_factors(cells, factors).groupBy(f"_{d}").agg(F.sum(F.col("tokens") * F.col("_weight")).alias("now"))
            step = F.when(F.col("now") > 0, F.col("target") * F.lit(total) / F.col("now")).otherwise(F.lit(1.0))
            fitted = factors[d].join(wanted[d], f"_{d}").join(now, f"_{d}")
            factors[d] = store(
                fitted.select(f"_{d}", (F.col(f"_factor_{d}") * step).alias(f"_factor_{d}")), f"factors_{d}"
            )
    largest = _with_factors(cells.filter("tokens > 0"), factors).agg(F.max("_weight")).first()[0]
    return factors, float(largest or 1.0)


def _lookup(d: str, names: list[str], factor: np.ndarray) -> Column:
    """The factor of a row's class: a map of at most MOST + 1 entries."""
    pairs = [x for n, f in zip(names, factor.tolist()) if n != REST for x in (F.lit(n), F.lit(f))]
    rest = F.lit(float(factor[names.index(REST)]) if REST in names else 1.0)
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(f"_{d}")), rest) if pairs else rest


def weighted(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """`docs` with `_source`, `_lang`, `_topic`, `_tokens`, `_weight`, `_probability`, `_sampled`.

    `targets` may give the shares of the classes of a dimension; classes it does not name
    share what is left in natural proportion, and shares that exceed 1 are scaled. Without targets the natural shares are
    tempered by POWERS. A probability is the weight over the largest weight of any cell, so the
    expected tokens of the sample have the target marginals exactly. A row is sampled if
    `uniform(doc_id)` is below it: rows that repeat a doc_id in one class share their fate.
    """
    rows = features(docs)
    cells = store(rows.groupBy(*(f"_{d}" for d in DIMENSIONS)).agg(F.sum("_tokens").alias("tokens")), "cells")
    most = max(cells.agg(*(F.count_distinct(f"_{d}") for d in DIMENSIONS)).first())
    weight, largest = (_weigh if most <= MOST else _weigh_tables)(rows, cells, targets)
    rows = weight.withColumn("_probability", F.least(F.lit(1.0), F.col("_weight") / F.lit(largest)))
    return rows.withColumn("_sampled", uniform(F.col("doc_id")) < F.col("_probability"))


def _weigh_tables(rows: DataFrame, cells: DataFrame, targets) -> tuple[DataFrame, float]:
    """`rows` with `_weight`, and the largest weight; the factors stay tables."""
    columns = rows.columns
    factors, largest = rake_tables(cells, targets)
    few = {d: F.broadcast(f) if f.count() <= BROADCAST_ROWS else f for d, f in factors.items()}
    return _with_factors(rows, few).select(*columns, "_weight"), largest


def _weigh(rows: DataFrame, cells: DataFrame, targets) -> tuple[DataFrame, float]:
    """The same by a cube of at most MOST x MOST x 4 sums on the driver."""
    names, tokens = cell_table(cells.withColumnRenamed("tokens", "_tokens"))
    wanted = []
    for axis, d in enumerate(DIMENSIONS):
        natural = tempered(tokens, axis, 1.0 if targets and d in targets else POWERS[d])
        if targets and d in targets:
            given = np.array([targets[d].get(n, np.nan) for n in names[axis]])
            open_ = np.isnan(given)
            left = max(0.0, 1 - np.nansum(given))
            share = natural * open_
            natural = np.where(open_, share / max(share.sum(), 1e-300) * left, given)
            natural = natural / max(natural.sum(), 1e-300)
        wanted.append(natural)
    factors = rake(tokens, wanted, SWEEPS)
    cube = np.einsum("i,j,k->ijk", *factors) if tokens.size else np.ones((1, 1, 1))
    largest = float(cube[tokens > 0].max()) if (tokens > 0).any() else 1.0
    weight = F.lit(1.0)
    for d, n, f in zip(DIMENSIONS, names, factors):
        weight = weight * _lookup(d, n, f)
    return rows.withColumn("_weight", weight), largest


def mixture(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, probability, sampled) of each row.

    Null source and lang are classes of their own; a null text is prose without tokens.
    """
    rows = weighted(docs.select("doc_id", "text", "source", "lang"), targets)
    return rows.select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.round("_weight", 6).alias("weight"), F.round("_probability", 6).alias("probability"),
        F.col("_sampled").alias("sampled"),
    )


def sample(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """The sampled rows with all their columns, whatever those are called.

    An empty table stays empty; null and empty texts have no tokens and the weight of their cell.
    """
    docs, named = apart(docs, ("doc_id", "text", "source", "lang"))
    return named(weighted(docs, targets).filter("_sampled"))


def oracle(sweeps: int = SWEEPS) -> str:
    """The same in SQL: one window sum for each step of the raking."""
    topics = " ".join(
        f"WHEN regexp_matches(text, '{p.removeprefix('(?i)')}', '{'i' if p.startswith('(?i)') else 'c'}') THEN '{t}'"
        for t, p in TOPICS.items()
    )
    steps, last = [], "start"
    for sweep in range(sweeps):
        for d in DIMENSIONS:
            name = f"s{sweep}_{d}"
            steps.append(
                f"{name} AS (SELECT source, lang, topic, tokens, w * t_{d} * total / "
                f"sum(w * tokens) OVER (PARTITION BY {d}) AS w, t_source, t_lang, t_topic, total FROM {last})"
            )
            last = name
    marginals = ", ".join(
        f"m_{d} AS (SELECT {d}, pow(sum(tokens) / (SELECT sum(tokens) FROM cells), {POWERS[d]}) AS p "
        f"FROM cells GROUP BY {d}), g_{d} AS (SELECT {d}, p / sum(p) OVER () AS t_{d} FROM m_{d})"
        for d in DIMENSIONS
    )
    return f"""
WITH rows AS (
  SELECT doc_id, source, lang, CASE {topics} ELSE 'prose' END AS topic,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_tokens
  FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL),
{marginals},
start AS (
  SELECT source, lang, topic, tokens, 1.0::DOUBLE AS w, t_source, t_lang, t_topic, sum(tokens) OVER () AS total
  FROM cells JOIN g_source USING (source) JOIN g_lang USING (lang) JOIN g_topic USING (topic)),
{", ".join(steps)},
fitted AS MATERIALIZED (SELECT source, lang, topic, w, w / max(w) OVER () AS p FROM {last})
SELECT doc_id, source, lang, topic, n_tokens::BIGINT AS n_tokens, round(w, 6) AS weight,
       round(least(1.0, p), 6) AS probability,
       ('0x' || substr(md5(doc_id::VARCHAR || ':{SEED}'), 1, 13))::BIGINT / {float(_UNIT)} < p AS sampled
FROM rows JOIN fitted USING (source, lang, topic)
"""
