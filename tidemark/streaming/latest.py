"""Newest row per key from a stream of changes.

Streams refuse row numbers, so each micro-batch is cut to its newest row per key and written as
one folder of the table, overwritten if the batch is run again. A batch costs as much as its own
rows, never the whole table; the newest row over all folders is picked on reading. `fold` keeps
that reading from growing with the history: it writes the newest rows from the fold before and the
batches since. `merge_batches` costs less still: its table lies in hash buckets, and only those
that the new batches touch are read and written, as a new version that comes into force at once. Tables
whose format supports MERGE are upserted in place instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import merge_into, pair_changes
from tidemark.operators.dedup import latest_by, whole_keys
from tidemark.session import folders, remove
from tidemark.streaming import versions
from tidemark.streaming.jobs import AVAILABLE_NOW, batch_folder, batch_ids, start_stream

SEED = -1


def _told_apart(keys: Sequence[str | Column], order: Sequence[str | Column]) -> list[Column]:
    return whole_keys(keys, order) if all(isinstance(key, str) for key in keys) else list(keys)


def seed(rows: DataFrame, path: str) -> None:
    """Existing rows as the start of a table, older than every batch."""
    rows.write.mode("overwrite").parquet(batch_folder(path, SEED))


def latest_stream(
    changes: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    path: str,
    checkpoint: str,
    trigger: str = AVAILABLE_NOW,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Keep a table of the newest row per key up to date from a stream of changes.

    Rows with a NULL in their key are told apart by the order columns, as in `changes.upsert`.
    `prepare` derives columns on the rows that are left after the cut.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_by(batch, _told_apart(keys, order), order)
        if prepare is not None:
            newest = prepare(newest)
        newest.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return start_stream(changes, checkpoint, write, trigger=trigger)


def read_latest(
    spark: SparkSession,
    path: str,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
) -> DataFrame:
    """The table: one row per key, the newest by `order` over seed and batches."""
    rows = spark.read.parquet(path)
    return latest_by(rows, _told_apart(keys, order), order).drop("batch_id")


def fold(
    spark: SparkSession,
    path: str,
    out: str,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    previous: str | None = None,
    running: bool = True,
) -> DataFrame:
    """Write the table at `path` to `out` as one row per key, and give it.

    With the folder of a `previous` fold only the batches since are read. While the stream is `running` the
    newest batch may still be in the writing, so it is read again by the next fold; those before it are
    complete. After a triggered run has ended all are, and each is read by one fold only.
    """
    ids = batch_ids(spark, path)
    if not ids:
        raise ValueError(f"no micro-batch has been written to {path}")
    batches = spark.read.parquet(path)
    rows = batches.drop("batch_id")
    done = folders(spark, previous) if previous is not None else []
    if done:
        folded = spark.read.parquet(previous)
        rows = folded.drop("folded_to").unionByName(
            batches.where(F.col("batch_id") > int(done[-1].partition("=")[2])).drop("batch_id")
        )
    newest = latest_by(rows, _told_apart(keys, order), order).withColumn("folded_to", F.lit(ids[-1] - int(running)))
    newest.write.mode("overwrite").partitionBy("folded_to").parquet(out)
    return spark.read.schema(newest.schema).parquet(out).drop("folded_to")


def merge_batches(
    spark: SparkSession,
    path: str,
    out: str,
    keys: Sequence[str],
    order: Sequence[str],
    bucket_by: Sequence[str],
    buckets: int = 64,
    keep: int = 2,
    compare: Sequence[str] | None = None,
) -> tuple[versions.Version, list[int]] | None:
    """Merge the micro-batches since the last call into the table at `out`, which has one row per
    key in hash buckets; gives its new version and the buckets written, None if there was nothing.

    Only touched buckets are read and written, and the rows that have changed are written beside them (see
    `versions.changes_between`; `compare` leaves out columns such as maps). Rows, changes, and how far the batches
    are merged come into force together. The number of buckets can't be changed. The newest batch
    may still be in the writing, so it is merged again next time. Merged batches but the newest
    `keep` are deleted, and so are versions but the newest `keep`.
    """
    base = versions.version(spark, out)
    if base and base.buckets != buckets:
        raise ValueError(f"the table has {base.buckets} buckets, not {buckets}")
    ids = batch_ids(spark, path)
    new = [b for b in ids if base is None or b > base.note["batch"]]
    if not new:
        return None
    changes = spark.read.parquet(*[batch_folder(path, b) for b in new]).withColumn(
        "bucket", versions.bucket_of(bucket_by, buckets)
    )
    touched = sorted(r.bucket for r in changes.select("bucket").distinct().collect())  # no more than buckets
    stored = versions.read(spark, out, base, touched, changes.schema)
    merged, fed = _merge(stored, changes, keys, order, buckets, compare)
    merged = merged.persist()
    try:
        at = versions.commit(
            merged.select(*stored.columns), out, base, buckets, touched, {"batch": ids[-1] - 1}, fed=fed(merged), dealt=True)
    finally:
        merged.unpersist()
    versions.vacuum(spark, out, keep)
    for batch in ids[: len(ids) - keep]:
        if batch < ids[-1]:
            remove(spark, batch_folder(path, batch))
    return at, touched


def _merge(
    stored: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int,
    compare: Sequence[str] | None,
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The newest row of each key with the stored row it replaces, and how change rows are read off them.

    One shuffle finds the newest rows, puts each bucket into few files and brings a row together with the one
    it replaces; only a row that isn't stored can be a change.
    """
    told = _told_apart(keys, order)
    others = [c for c in stored.columns if c not in (*keys, "bucket")]
    row = F.struct(*keys, *others)
    rows = stored.withColumn("_fresh", F.lit(False)).unionByName(changes.withColumn("_fresh", F.lit(True)))
    group = Window.partitionBy("bucket", versions.SLICE, *told).orderBy(*[F.col(c).desc() for c in order])
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.first(F.when(~F.col("_fresh"), row), ignorenulls=True).over(whole)
    numbered = versions.deal(rows, told, buckets).withColumns({"_number": F.row_number().over(group), "_old": before})
    merged = numbered.where("_number = 1").withColumn("_old", F.when(F.col("_fresh"), F.col("_old")))

    def fed(newest: DataFrame) -> DataFrame:
        return pair_changes(newest.where("_fresh").select("_old", row.alias("_new")), compare or others)

    return merged.drop("_number", versions.SLICE), fed


def upsert_stream(
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    trigger: str = AVAILABLE_NOW,
) -> StreamingQuery:
    """Upsert a stream into the table at `path` (see `seed`, `read_latest`), or by MERGE into a
    named `table` whose format supports it."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    if path is not None:
        return latest_stream(updates, keys, order, path, checkpoint, trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_into(table, batch, keys, order)

    return start_stream(updates, checkpoint, merge, trigger=trigger)
