"""More classes than the driver rakes: each has a target of its own, as in the SQL."""

import pytest

from affinia.llm import mixing
from tests import oracle

SCHEMA = "doc_id long, text string, lang string, source string"


def test_more_than_512_sources_equal_the_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "SWEEPS", 3)
    monkeypatch.setattr(oracle, "TABLES", ("documents",))
    rows = [(i, "w " * (i % 7 + 1), "xyz"[i % 3], f"s{i % 700 if i < 2100 else i % 5}") for i in range(2800)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    query = lambda s, d: mixing.mixture(s.read.parquet(f"{d}/documents.parquet"))
    assert oracle.compare(spark, str(tmp_path), query, mixing.oracle(3)) > 0


def test_tables_equal_the_cube(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SWEEPS", 2)
    rows = [(i, "w " * (i % 7), "xy"[i % 5 == 0], f"s{min(i % 9, 4)}") for i in range(400)]
    docs, given = spark.createDataFrame(rows, SCHEMA), {"source": {"s0": 0.4, "s1": 0.3}}
    few = {r.doc_id: r.probability for r in mixing.mixture(docs, given).collect()}
    monkeypatch.setattr(mixing, "MOST", 1)
    many = {r.doc_id: r.probability for r in mixing.mixture(docs, given).collect()}
    assert many == pytest.approx(few)
