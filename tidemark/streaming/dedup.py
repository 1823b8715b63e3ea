"""Deduplication of unbounded input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.dedup import EVENT_ORDER, POSITION
from tidemark.schemas import LATE_DELAY

BUCKETS = 16


def with_watermark(
    df: DataFrame, column: str = "event_timestamp", delay: str = LATE_DELAY
) -> DataFrame:
    """Rows at least up to `delay` behind the newest event time of earlier batches are kept."""
    return df.withWatermark(column, delay)


def dedup_stream(
    df: DataFrame,
    id_column: str = "event_id",
    bounded: bool = True,
    position: Sequence[str] = POSITION,
    spread: Sequence[str] = EVENT_ORDER,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per id; rows without an id are told apart by their position.

    `bounded` forgets an id once the watermark has passed it by the delay, so state stays small
    and a copy that comes later still is emitted again; it needs a watermark. Otherwise ids are
    kept for ever.

    Streams have no partial step before the shuffle. So ids are first made unique inside
    `buckets` slices of each id, which spreads a hot id over that many tasks, and then over
    all. The slice follows from the `spread` columns, which differ between copies. `buckets=1`
    leaves the first step, and its state, out where no id is hot.
    """

    def unique(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.dropDuplicatesWithinWatermark(keys) if bounded else rows.dropDuplicates(keys)

    missing = F.when(F.col(id_column).isNull(), F.struct(*position))
    rows = df.withColumn("_position", missing)
    if buckets > 1:
        slice_of = F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int")
        rows = unique(rows.withColumn("_slice", slice_of), [id_column, "_position", "_slice"])
        rows = rows.drop("_slice")
    return unique(rows, [id_column, "_position"]).drop("_position")
