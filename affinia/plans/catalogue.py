"""All registered queries with their SQL oracles, by area."""

from __future__ import annotations

from affinia.plans import baskets, chunked, clusters, formats, graph, recommend, study, trees

AREAS = [graph, baskets, clusters, chunked, recommend, study, trees, formats]


def queries() -> dict:
    return {name: query for area in AREAS for name, query in area.QUERIES.items()}


def oracles() -> dict:
    return {name: sql for area in AREAS for name, sql in area.ORACLES.items()}
