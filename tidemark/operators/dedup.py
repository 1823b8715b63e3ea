"""One row per key: the newest, or the first delivered."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Offsets order rows inside one partition only, so ingest time and partition break ties.
PARTNER_ORDER = ("kafka_offset", "kafka_ingest_timestamp", "kafka_partition")
# For tables that live on while a topic gets more partitions: a key that moves to a new partition
# starts there with small offsets, so the time of ingest decides first.
LIVING_ORDER = ("kafka_ingest_timestamp", "kafka_partition", "kafka_offset")
EVENT_ORDER = ("kafka_offset", "kafka_timestamp", "kafka_partition")
POSITION = ("kafka_partition", "kafka_offset")
PARTNER_KEYS = ("sap_client", "bp_number", "event_type")


def _columns(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(item) if isinstance(item, str) else item for item in items]


def latest_by(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    how: str = "window",
    newest: bool = True,
) -> DataFrame:
    """One row per key, the one ranked highest (or lowest) by `order`.

    `window` keeps rank 1 of a row number; Spark cuts every input partition down to its own best
    row per key before the shuffle, so a hot key sends one row per task. `agg` keeps the row with
    the greatest order value in a partial and a final aggregate, and also runs on streams.
    """
    ranked = _columns(order)
    if how == "agg":
        best = F.max_by if newest else F.min_by
        rows = df.groupBy(*_columns(keys)).agg(best(F.struct("*"), F.struct(*ranked)).alias("_row"))
        return rows.select("_row.*")
    if how != "window":
        raise ValueError(f"how must be 'window' or 'agg', not {how!r}")
    directed = [c.desc() if newest else c.asc() for c in ranked]
    number = F.row_number().over(Window.partitionBy(*_columns(keys)).orderBy(*directed))
    return df.withColumn("_number", number).where("_number = 1").drop("_number")


def whole_keys(
    keys: Sequence[str | Column], position: Sequence[str | Column] = POSITION
) -> list[Column]:
    """The key columns, and the message position where one of them is NULL.

    What a NULL in a key means is decided here for all operators: a row with an incomplete key is
    no copy or update of any other message, only of itself when it is read again. So no such row
    is lost, and they do not pile up in one group.
    """
    columns = _columns(keys)
    missing = reduce(lambda a, b: a | b, [c.isNull() for c in columns])
    return [*columns, F.when(missing, F.struct(*position))]


def identity_keys(
    id_column: str = "event_id", position: Sequence[str] = POSITION
) -> list[Column]:
    """Key columns that equal the id, or the message position where the id is NULL."""
    return whole_keys([id_column], position)


def dedup_events(
    df: DataFrame,
    id_column: str = "event_id",
    order: Sequence[str | Column] = EVENT_ORDER,
    position: Sequence[str] = POSITION,
    how: str = "window",
) -> DataFrame:
    """Events without redelivered copies: the first delivery of each id survives."""
    return latest_by(df, identity_keys(id_column, position), order, how=how, newest=False)
