"""Operators that return the columns of their input, whatever those are called."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame


def apart(docs: DataFrame, used: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with all columns but `used` under neutral names, and the function that undoes it.

    Columns of an operator's own then never meet columns of the input with the same name.
    """
    names = [c if c in used else f"_other_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda out: out.select(*names).toDF(*docs.columns)
