"""Places of rows in an order within groups of any size, without one task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import written


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until the frame has no column that is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def placed(rows: DataFrame, group: str, order: Sequence[str], folder: str) -> DataFrame:
    """`rows` with `place` (0, 1, … by `order` within the group) and `size` (rows of the group) added.

    The rows are dealt by ranges of (group, order) and written in order, with their number in the range.
    One row for each group and range then says where the range begins within the group. Equal rows are told apart by
    where they came from, so a run of them can be cut between tasks too.
    """
    ranged = (
        rows.withColumn("_from", F.monotonically_increasing_id())
        .repartitionByRange(*(F.col(c).asc_nulls_first() for c in (group, *order, "_from")))
        .sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in (group, *order, "_from"))).drop("_from")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    ranged = written(ranged, f"{folder}/ranged").withColumn("_range", F.shiftright("_at", 33))
    parts = ranged.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    own = Window.partitionBy("_group")
    parts = written(parts.select(
        "_group", "_part", "_first", F.sum("_rows").over(own).alias("size"),
        (F.sum("_rows").over(own.orderBy("_part")) - F.col("_rows")).alias("_before"),
    ), f"{folder}/parts")
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_part"))
    return (
        ranged.join(parts, same).withColumn("place", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_at", "_range", "_group", "_part", "_first", "_before")
    )


def _pairs(number: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Pairs of signed numbers as bytes that sort as they do."""
    both = np.stack((number, tie), axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(both.astype(">u8")).view("S16").ravel()


def borders(keys: DataFrame, number: Column, tie: Column, parts: int) -> np.ndarray:
    """The borders of about `parts` near equal ranges of (number, tie), two longs, for `range_of`.

    They come from a sample of at most about 100 keys a range. Any borders give right results; the
    sample only decides how even the ranges are. Unlike Spark's own ranges they don't cost a second run of
    what is computed between the keys and the exchange.
    """
    keys = keys.select(number.alias("number"), tie.alias("tie"))
    share = 100 * parts / max(keys.count(), 1)
    taken = (keys.sample(share, seed=11) if share < 1 else keys).toArrow()
    found = np.sort(_pairs(*(taken.column(c).to_numpy() for c in ("number", "tie"))))
    return np.unique(found[:: max(len(found) // parts, 1)][1:])


def range_of(borders: np.ndarray, number: pa.Array, tie: pa.Array) -> np.ndarray:
    """The range that each (number, tie) lies in: a plain function, for the Python task that makes what is
    exchanged, as a function of columns beside it would need a second worker for every task."""
    own = _pairs(number.to_numpy(zero_copy_only=False), tie.to_numpy(zero_copy_only=False))
    return np.searchsorted(borders, own, "right").astype(np.int32)
