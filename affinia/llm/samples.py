"""Bounded samples of labelled texts for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.session import store

SCALE = 1 << 30
MAX_CHARS = 1 << 15  # longer texts are scored like all others, but not learned from
MAX_ROWS = 200_000  # of all classes together


def remainder(doc_id: str, parts: int) -> Column:
    """crc32(doc_id as text) mod parts; null without doc_id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def labelled_sample(rows: DataFrame, label: str, per_class: int, most: int = MAX_ROWS) -> list[tuple]:
    """At most `per_class` (label, text, hash) of each label, in an order fixed by the rows.

    `rows` has (label, text). Rows without label or text, and texts over MAX_CHARS, are left
    out. With more than `most` / `per_class` labels each of them gives fewer rows, so no label is left
    out up to `most` of them. A count per label sets the share of rows whose hash is small enough, so no class
    is sorted or gathered; the rows that reach the driver are bounded by the parameters.
    """
    fit = rows.select(F.col(label).alias("label"), "text").filter(
        F.col("label").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= MAX_CHARS)
    )
    counts = store(fit.groupBy("label").agg(F.count("*").alias("n")), "label_counts")
    classes = counts.count()
    if not classes:
        return []
    each = max(1, min(per_class, most // classes))
    draw = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(SCALE))
    # Twice the wanted share, and some more of small classes, so that hardly one falls short.
    share = F.least(F.lit(1.0), F.lit(2.0 * each + 20) / F.col("n"))
    limits = counts.select("label", (share * SCALE).cast("long").alias("limit"))
    limits = F.broadcast(limits) if classes <= most else limits
    drawn = fit.withColumn("draw", draw).join(limits, "label").filter("draw < limit").drop("limit").distinct()
    drawn = drawn.orderBy("draw", "label", "text").limit((2 * each + 40) * classes + 1000 if classes <= most else most)
    taken: dict = {}
    sample = []
    for row in drawn.toLocalIterator():
        taken[row.label] = taken.get(row.label, 0) + 1
        if taken[row.label] <= each:
            sample.append((row.label, row.text, row.draw))
    return sample
