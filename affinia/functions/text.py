"""Text formatting of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: str | Column, digits: int) -> Column:
    """A double with a fixed number of decimals as C and Python print it: ties of
    the number's decimal form go to the even digit and a negative value that rounds to
    zero keeps its sign."""
    value = F.col(value) if isinstance(value, str) else value
    rounded = F.bround(value, digits)
    text = F.format_string(f"%.{digits}f", rounded)
    return F.when((value < 0) & (rounded == 0), F.concat(F.lit("-"), F.ltrim(text, F.lit("-")))).otherwise(text)
