"""Spans of a text that has many copies are gathered once."""

import random

from pyspark.sql import functions as F

from affinia.llm import suffixes


def test_spans_of_copies_are_distinct(spark):
    rng = random.Random(6)
    text = " ".join(f"w{rng.randrange(900)}" for _ in range(300))
    docs = spark.createDataFrame([(text,)] * 60, "text string").repartition(3)
    rows = docs.select(suffixes.text_key(F.col("text")).alias("text_key"), F.encode("text", "utf-8").alias("text"))
    (row,) = suffixes.covered(rows).collect()
    spans = [tuple(s) for s in row.spans]
    assert spans and len(spans) == len(set(spans))
