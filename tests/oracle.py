"""Run a registered query and its SQL side by side and compare all rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=_key)


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = database(sf_dir).execute(sql)
    columns = [d[0] for d in cursor.description]
    want_columns, want = rows_of(columns, cursor.fetchall())
    assert got_columns == want_columns
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    mine = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    assert mine == theirs, {c: (t, theirs[c]) for c, t in mine.items() if t != theirs[c]}
    assert len(got) == len(want), f"{len(got)} rows, oracle has {len(want)}"
    for mine, theirs in zip(got, want):
        assert mine == theirs, f"{mine} != {theirs}"
    return len(got)
