"""Running streams: triggers, checkpoints, idempotent output, refresh and layer tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import exists, folders, remove, rename, write_text

AVAILABLE_NOW = "available_now"
QUALITY = {"raw": "bronze", "trusted": "silver", "gold": "gold"}


def trigger_options(trigger: str) -> dict[str, object]:
    """`available_now` works off what is there and ends; an interval such as `30 seconds` runs on."""
    if trigger == AVAILABLE_NOW:
        return {"availableNow": True}
    return {"processingTime": trigger}


def start_stream(
    df: DataFrame,
    checkpoint: str,
    each_batch: Callable[[DataFrame, int], None],
    mode: str = "append",
    trigger: str = AVAILABLE_NOW,
) -> StreamingQuery:
    """A stream that hands every micro-batch to `each_batch`; waits if it is a triggered run."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    query = writer.foreachBatch(each_batch).trigger(**trigger_options(trigger)).start()
    if trigger == AVAILABLE_NOW:
        query.awaitTermination()
    return query


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """The micro-batches of a table, from a listing of its folders alone."""
    names = (name.partition("=") for name in folders(spark, path))
    return sorted(int(value) for key, _, value in names if key == "batch_id")


def run_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    trigger: str = AVAILABLE_NOW,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Write a stream to files; a restart on the same checkpoint repeats no row.

    Append output goes to Spark's file sink, which commits each micro-batch once. Complete and
    update output is one folder per micro-batch, overwritten when the batch is run again; read it
    with `read_snapshot` or `read_updates`. Of complete output the newest two folders are kept.
    """
    if mode == "append":
        writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        query = writer.trigger(**trigger_options(trigger)).start(path)
        if trigger == AVAILABLE_NOW:
            query.awaitTermination()
        return query

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))
        if mode == "complete":
            for old in batch_ids(df.sparkSession, path):
                if old < batch_id - 1:
                    remove(df.sparkSession, batch_folder(path, old))

    return start_stream(df, checkpoint, write, mode, trigger)


def read_snapshot(spark: SparkSession, path: str, running: bool = False) -> DataFrame:
    """The newest complete result: the rows of the last micro-batch, or of the one before while
    the stream is `running` and the last may still be in the writing."""
    batches = batch_ids(spark, path)
    if not batches:
        raise ValueError(f"no micro-batch has been written to {path}")
    settled = batches[-2] if running and len(batches) > 1 else batches[-1]
    return spark.read.parquet(batch_folder(path, settled))


def compact(
    spark: SparkSession,
    path: str,
    keep: int = 2,
    partition_by: Sequence[str] = (),
) -> int:
    """Merge all micro-batches but the newest `keep` into one folder; gives the folders left.

    The merged folder takes the place of the newest batch in it, so a stream that appends goes on
    as before. It is written whole beside the table first; a run that ended while the folders were
    switched is finished by the next call. Run it between reads: while they are switched a reader
    may miss one.
    """
    _finish_compaction(spark, path)
    batches = batch_ids(spark, path)
    old = batches[: len(batches) - keep] if keep else batches
    if len(old) < 2:
        return len(batches)
    rows = spark.read.option("basePath", path).parquet(*[batch_folder(path, b) for b in old])
    rows = rows.drop("batch_id").hint("rebalance", *partition_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{_MERGED}{old[-1]}")
    _finish_compaction(spark, path)
    return len(batches) - len(old) + 1


_MERGED = "_merged-"


def _finish_compaction(spark: SparkSession, path: str) -> None:
    """Put a merged folder that is whole in the place of its batches; one that isn't is deleted."""
    for name in folders(spark, path):
        if not name.startswith(_MERGED):
            continue
        merged, newest = f"{path}/{name}", int(name.removeprefix(_MERGED))
        if not exists(spark, f"{merged}/_SUCCESS"):
            remove(spark, merged)
            continue
        for batch in batch_ids(spark, path):
            if batch <= newest:
                remove(spark, batch_folder(path, batch))
        rename(spark, merged, batch_folder(path, newest))


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest result of each key out of update output."""
    from tidemark.operators.dedup import latest_by

    return latest_by(spark.read.parquet(path), keys, ["batch_id"]).drop("batch_id")


def stream_stats(query: StreamingQuery) -> dict[str, int]:
    """Input rows, state changes and rows dropped as late, over the retained progress reports."""
    reports = query.recentProgress
    stateful = [s for report in reports for s in report["stateOperators"]]
    return {
        "batches": len(reports),
        "input_rows": sum(report["numInputRows"] for report in reports),
        "state_rows_updated": sum(s["numRowsUpdated"] for s in stateful),
        "state_rows_removed": sum(s["numRowsRemoved"] for s in stateful),
        "late_rows_dropped": sum(s["numRowsDroppedByWatermark"] for s in stateful),
    }


def refresh(
    spark: SparkSession,
    run: Callable[[], StreamingQuery],
    folders: Sequence[str],
    mode: str = "incremental",
) -> StreamingQuery:
    """Run a stream: `incremental` goes on from its checkpoint, `full` reads the source from the start.

    For that its `folders`, the checkpoint and the tables, are put aside first. They are deleted
    once a triggered run has ended well, and put back if it fails. If the driver was killed meanwhile, the
    next call of either mode puts back what still lies aside before it runs.
    """
    if mode not in ("incremental", "full"):
        raise ValueError(f"mode must be 'incremental' or 'full', not {mode!r}")
    done = f"{folders[0]}.refreshed"
    if exists(spark, done):  # it had ended well, and only the copies are left
        for folder in folders:
            remove(spark, f"{folder}.before")
        remove(spark, done)
    _put_back(spark, folders)
    if mode == "incremental":
        return run()
    try:
        for folder in folders:
            rename(spark, folder, f"{folder}.before")
        query = run()
    except Exception:
        _put_back(spark, folders)
        raise
    write_text(spark, done, "")
    for folder in folders:
        remove(spark, f"{folder}.before")
    remove(spark, done)
    return query


def _put_back(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        if exists(spark, f"{folder}.before"):
            remove(spark, folder)
            rename(spark, f"{folder}.before", folder)


def write_layer(
    df: DataFrame,
    path: str,
    layer: str,
    table: str | None = None,
    comment: str | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    only_partitions: bool = False,
) -> None:
    """Materialize a raw, trusted or gold table, tagged with its quality when it has a name.

    Partitioned tables are rebalanced on the partition columns first: few files per partition,
    and a partition holding much of the data is still written by many tasks. `only_partitions`
    overwrites the partitions that occur in the rows and leaves the others as they are.
    """
    quality = QUALITY[layer]
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format("parquet").partitionBy(*partition_by)
    if only_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if table is None:
        writer.save(path)
        return
    writer.option("path", path).saveAsTable(table)
    tag_table(df.sparkSession, table, quality, comment)


def write_layer_stream(
    df: DataFrame,
    path: str,
    layer: str,
    table: str,
    checkpoint: str,
    comment: str | None = None,
    trigger: str = AVAILABLE_NOW,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """The same for a stream of new rows, which goes on from its checkpoint."""
    quality = QUALITY[layer]
    writer = df.writeStream.option("checkpointLocation", checkpoint).option("path", path)
    writer = writer.trigger(**trigger_options(trigger))
    query = writer.toTable(table, format="parquet", partitionBy=list(partition_by) or None)
    tag_table(df.sparkSession, table, quality, comment)
    if trigger == AVAILABLE_NOW:
        query.awaitTermination()
    return query


def name_table(
    spark: SparkSession, table: str, path: str, layer: str, comment: str | None = None
) -> None:
    """Give the files of a layer a name in the catalog, tagged with their quality. Naming a table
    again finds the partitions that came since."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path, source="parquet")
        tag_table(spark, table, QUALITY[layer], comment)
    if any("=" in name for name in folders(spark, path)):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def tag_table(spark: SparkSession, table: str, quality: str, comment: str | None = None) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('quality' = '{quality}')")
    if comment:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")
