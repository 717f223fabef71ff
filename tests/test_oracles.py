"""Every registered query on the smallest tables, against its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


#: Queries of the training-data operators are compared in tests/llm.
OWN = {name for name in QUERIES if not name.startswith("op") and name != "pipeline"}


@pytest.mark.parametrize("name", sorted(OWN & set(ORACLES)))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SF, QUERIES[name], ORACLES[name]) > 0


@pytest.mark.parametrize("name", sorted(OWN - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "recs"]


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
