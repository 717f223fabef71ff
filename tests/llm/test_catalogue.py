"""The operators and the pipeline are registered, under their numbers."""

import __spark_entry__ as entry
from affinia.llm import catalogue


def test_each_number_has_one_query():
    names = catalogue.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(catalogue.oracles()) <= set(names) and catalogue.oracles().items() <= entry.oracle_sql().items()


def test_queries_at_the_smallest_scale(spark):
    sf = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf}/documents.parquet").count()
    for number in (2, 4, 5, 6, 8, 9, 10, 12, 13):
        name = next(n for n in catalogue.queries() if n.startswith(f"op{number}_"))
        rows = catalogue.queries()[name](spark, sf)
        assert rows.count() == documents, name
