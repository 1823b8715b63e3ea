"""Gold tables kept up by deltas: each micro-batch adds its states, and nothing older is read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import rollup
from tidemark.session import remove
from tidemark.streaming import versions
from tidemark.streaming.jobs import AVAILABLE_NOW, batch_folder, batch_ids, start_stream

PANES, ENTITIES = "panes", "entities"
NUMBERS, BITMAPS = "numbers", "bitmaps"


def keep_states(
    trusted: DataFrame, path: str, checkpoint: str, trigger: str = AVAILABLE_NOW, exact: bool = False,
) -> StreamingQuery:
    """Write the states of every micro-batch of trusted rows, in folders that a repeated batch writes again.

    Panes hold what hours, sliding windows and days are made of, entities what their days are. With `exact` the values of the
    counted columns are numbered, and which occur in an hour is kept as bitmaps, for distinct counts without error.
    """
    spark = trusted.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rollup.pane_states(batch).write.mode("overwrite").parquet(batch_folder(f"{path}/{PANES}", batch_id))
            rollup.entity_states(batch).write.mode("overwrite").parquet(batch_folder(f"{path}/{ENTITIES}", batch_id))
            for column in rollup.COUNTED.values() if exact else ():
                _number(spark, batch, column, path, batch_id)
        finally:
            batch.unpersist()

    return start_stream(trusted, checkpoint, write, trigger=trigger)


def _number(spark: SparkSession, batch: DataFrame, column: str, path: str, batch_id: int) -> None:
    numbers, bitmaps = f"{path}/{NUMBERS}/{column}", f"{path}/{BITMAPS}/{column}"
    before = [b for b in batch_ids(spark, numbers) if b < batch_id]  # a repeated batch numbers its values anew
    known = spark.read.parquet(*[batch_folder(numbers, b) for b in before]) if before else None
    values = batch.select(F.col(column).cast("string").alias("value"))
    fresh = rollup.new_numbers(values, known, rollup.next_number(known) if before else 0)
    fresh.write.mode("overwrite").parquet(batch_folder(numbers, batch_id))
    added = spark.read.schema(fresh.schema).parquet(batch_folder(numbers, batch_id))
    states = rollup.bitmap_states(batch, added if known is None else known.unionByName(added), column)
    states.write.mode("overwrite").parquet(batch_folder(bitmaps, batch_id))


def read_states(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The states of all micro-batches, folded ones included: those of a group are still to be merged."""
    folded, folder = versions.version(spark, f"{path}/{kind}.folded"), f"{path}/{kind}"
    done = folded.note["batch"] if folded else -1
    later = [batch_folder(folder, b) for b in batch_ids(spark, folder) if b > done]
    rows = spark.read.parquet(*later) if later else None
    if folded:
        merged = versions.read(spark, f"{path}/{kind}.folded", folded).drop("bucket")
        rows = merged if rows is None else merged.unionByName(rows)
    if rows is None:
        raise ValueError(f"no state has been written to {folder}")
    return rows


DAYS = {PANES: "pane", ENTITIES: "event_date"}
BUCKETS = 64


def fold_states(spark: SparkSession, path: str, kind: str, keep: int = 2) -> None:
    """Merge the states of all micro-batches but the newest `keep`, so that reading doesn't grow with their number.

    The merged states are a versioned table beside them, bucketed by day: only the days that the batches
    touch are read and written, and readers see either those states or the batches.
    """
    folder, out = f"{path}/{kind}", f"{path}/{kind}.folded"
    base = versions.version(spark, out)
    done = base.note["batch"] if base else -1
    ids = batch_ids(spark, folder)
    old = [b for b in ids[: len(ids) - keep] if b > done]
    if not old:
        return
    day = F.pmod(F.xxhash64(F.to_date(DAYS[kind])), F.lit(BUCKETS)).cast("int")
    rows = spark.read.parquet(*[batch_folder(folder, b) for b in old]).withColumn("bucket", day)
    touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # no more than BUCKETS
    rows = rows.unionByName(versions.read(spark, out, base, touched, rows.schema)).drop("bucket")
    merged = rollup.merge_panes(rows) if kind == PANES else rollup.merge_entities(rows)
    versions.commit(merged.withColumn("bucket", day), out, base, BUCKETS, touched, {"batch": old[-1]})
    versions.vacuum(spark, out, keep=2)
    for batch in ids:
        if batch <= done:  # merged by the fold before: readers are done with it
            remove(spark, batch_folder(folder, batch))


def exact_counts(spark: SparkSession, path: str, seconds: int = 3600) -> DataFrame:
    """Exact distinct counts per window, type, source and entity type, for windows of whole hours."""
    out = None
    for name, column in rollup.COUNTED.items():
        counted = rollup.bitmap_counts(spark.read.parquet(f"{path}/{BITMAPS}/{column}"), name, seconds)
        if out is None:
            out = counted
            continue
        keys = ["window_start", *rollup.DIMENSIONS]
        other = counted.select(*[F.col(k).alias(f"_{k}") for k in keys], name)
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        out = out.join(other, same, "full_outer").select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], *out.columns[len(keys):], name)
    return out.fillna(0, list(rollup.COUNTED))
