"""Arrow batches of bounded size, and memory given back after a task."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterator
from functools import cache, wraps

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_BYTES = 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@cache
def _trim() -> Callable[[int], int] | None:
    name = ctypes.util.find_library("c")
    return getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function of batches; at its end freed memory goes back to the system, as Python workers
    live on from task to task and would keep the most that any of their tasks has needed."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := _trim():
            trim(0)

    return wrapped


def small_batches(df: DataFrame) -> DataFrame:
    """The same frame, in a session that hands Python no batch of much more than BATCH_BYTES.

    Batches are counted in rows otherwise, whatever the length of the texts. A smaller limit that the
    session already has is kept.
    """
    spark = df.sparkSession
    limit = spark.conf.get(_LIMIT).strip().lower().removesuffix("b")
    if not limit.isdigit() or int(limit) > BATCH_BYTES or int(limit) == 0:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))
    return df
