"""Late rows kept beside the table they are too late for, and the windows they belong to repaired.

A stream with a watermark only counts what it drops. Here every micro-batch records how far event time has come, which
decides in the batches after it what is late. Late rows go to a table of their own, so none is lost, and
gold is brought up to date by recomputing only the windows that they fall into.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schemas import METRIC_WINDOW
from tidemark.streaming import versions
from tidemark.streaming.jobs import AVAILABLE_NOW, batch_folder, batch_ids, start_stream

REACHED = "reached"
BUCKETS = 64


def keep_late(
    rows: DataFrame, path: str, checkpoint: str, delay: str, time: str = "event_timestamp",
    trigger: str = AVAILABLE_NOW, transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Split a stream into `path`/kept and `path`/late, folders per micro-batch.

    A row is late if its time lies more than `delay` before the latest time of all batches before its own. Rows without a
    time are kept. A repeated batch looks at the same batches before it, so it splits its rows the same way
    and writes its folders again.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        if transform is not None:
            batch = transform(batch)
        mark = reached(spark, path, batch_id)
        late = F.lit(False)
        if mark is not None:
            late = F.coalesce(F.col(time) < F.lit(mark) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        batch = batch.persist()
        try:
            batch.where(~late).write.mode("overwrite").parquet(batch_folder(f"{path}/kept", batch_id))
            batch.where(late).write.mode("overwrite").parquet(batch_folder(f"{path}/late", batch_id))
            latest = batch.agg(F.max(time).alias(REACHED))
            latest.write.mode("overwrite").parquet(batch_folder(f"{path}/{REACHED}", batch_id))
        finally:
            batch.unpersist()

    return start_stream(rows, checkpoint, write, trigger=trigger)


def reached(spark: SparkSession, path: str, before: int):
    """The latest event time of the batches before one; None if there was none."""
    folders = [batch_folder(f"{path}/{REACHED}", b) for b in batch_ids(spark, f"{path}/{REACHED}") if b < before]
    return spark.read.parquet(*folders).agg(F.max(REACHED)).first()[0] if folders else None


def _windows(rows: DataFrame, time: str, window: str) -> DataFrame:
    return rows.withColumn("_window", F.window(time, window).start)


def _both(spark: SparkSession, path: str, batches: list[int] | None = None) -> DataFrame:
    """Kept and late rows, of all batches or of some."""
    sides = [
        spark.read.parquet(*([side] if batches is None else [batch_folder(side, b) for b in batches]))
        for side in (f"{path}/kept", f"{path}/late")
    ]
    return sides[0].drop("batch_id").unionByName(sides[1].drop("batch_id"))


def refresh_windows(
    spark: SparkSession, path: str, gold: str, metrics: Callable[[DataFrame], DataFrame], since: int = -1,
    time: str = "event_timestamp", window: str = METRIC_WINDOW, start: str = "window_start",
) -> versions.Version | None:
    """Recompute the windows that the batches after number `since`, or those after the last refresh, have rows in.

    `metrics` gives a row or more for each window of the rows it gets, with the window's begin as `start`. The other
    windows stay as they are: gold lies in buckets of days, of which only those of touched windows are
    read and written. Late rows count like all others.
    """
    base = versions.version(spark, gold)
    done = base.note["batch"] if base else since
    new = [b for b in batch_ids(spark, f"{path}/kept") if b > done]
    if not new:
        return None
    fresh = _windows(_both(spark, path, new), time, window)
    bucket = lambda c: F.pmod(F.xxhash64(F.to_date(c)), F.lit(BUCKETS)).cast("int")
    # Used four times; kept, they are found in one scan, and the joins know how few they are.
    windows = fresh.where("_window IS NOT NULL").select("_window").distinct().persist()
    try:
        found = windows.select(F.to_date("_window").alias("day"), bucket("_window").alias("bucket")).distinct().collect()
        days, touched = [r.day for r in found], sorted({r.bucket for r in found})  # as many as the days touched
        rows = _both(spark, path)
        if days:
            # Time bounds that reach the scan; the exact windows follow by the join.
            rows = rows.where((F.col(time) >= F.lit(min(days))) & (F.col(time) < F.date_add(F.lit(max(days)), 2)))
        again = _windows(rows, time, window).join(windows, "_window", "left_semi").drop("_window")
        made = metrics(again).withColumn("bucket", bucket(start))
        kept = versions.read(spark, gold, base, touched, made.schema).join(
            windows.select(F.col("_window").alias(start)), start, "left_anti")
        at = versions.commit(kept.select(*made.columns).unionByName(made), gold, base, BUCKETS, touched, {"batch": new[-1]})
    finally:
        windows.unpersist()
    versions.vacuum(spark, gold)
    return at
