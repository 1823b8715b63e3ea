"""Expectation counts of a stream, appended to the quality log."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import Rules, observe_rules, observed_counts
from tidemark.streaming.jobs import AVAILABLE_NOW, batch_folder, start_stream


def log_details(flow: str, expectations, output_rows, input_rows, status: str = "COMPLETED"):
    """The `details` text of one progress row."""
    flow_progress = F.struct(
        F.lit(flow).alias("name"),
        F.lit(status).alias("status"),
        F.struct(
            output_rows.alias("num_output_rows"), input_rows.alias("num_input_rows")
        ).alias("metrics"),
        F.struct(expectations.alias("expectations")).alias("data_quality"),
    )
    return F.to_json(F.struct(flow_progress.alias("flow_progress")))


def _log_row(spark: SparkSession, flow: str, counts: list[tuple[str, int, int]], rows: int):
    expectations = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.lit(passed).alias("passed_records"),
            F.lit(failed).alias("failed_records"),
        )
        for name, passed, failed in counts
    ])
    return spark.range(1).select(
        F.current_timestamp().alias("timestamp"),
        F.lit("flow_progress").alias("event_type"),
        log_details(flow, expectations, F.lit(rows), F.lit(rows)).alias("details"),
    )


def measure_stream(
    df: DataFrame,
    rules: Rules,
    flow: str,
    path: str,
    log_path: str,
    checkpoint: str,
    trigger: str = AVAILABLE_NOW,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Write every row of the stream and one log row per micro-batch.

    The counts are gathered while the batch is written, so the rows are read once. Table and log
    are folders per batch, both overwritten if the batch is run again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        if partition_by:  # few files per folder, and a full one written by many tasks
            rows = rows.hint("rebalance", *partition_by)
        observation = Observation(f"{flow}-{batch_id}")
        observed = observe_rules(rows, rules, observation)
        writer = observed.write.mode("overwrite").partitionBy(*partition_by)
        writer.parquet(batch_folder(path, batch_id))
        counts = observed_counts(observation, rules)
        entry = _log_row(df.sparkSession, flow, counts, observation.get["_rows"])
        entry.write.mode("overwrite").parquet(batch_folder(log_path, batch_id))

    return start_stream(df, checkpoint, write, trigger=trigger)
