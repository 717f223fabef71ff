"""The batches that Spark hands to Python: their size, and memory given back after them."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST = 4 << 20


def bounded(df: DataFrame) -> DataFrame:
    """`df`, in a session whose Arrow batches hold about 4 MB at most.

    The default bounds the rows of a batch only, and 10,000 whole texts take much
    memory on both sides. A smaller setting of the session stays.
    """
    conf = df.sparkSession.conf
    now = conf.get(BATCH_BYTES, None)
    if now is None or not now.isdigit() or int(now) > MOST:
        conf.set(BATCH_BYTES, str(MOST))
    return df


def give_back() -> None:
    """Returns freed memory to the machine. Python workers live on between tasks and stages, and
    else keep what their largest task needed."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function over batches, that gives memory back when its task ends."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
