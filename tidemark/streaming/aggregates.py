"""Windowed aggregates of unbounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.events import DIMENSIONS, window_bounds
from tidemark.schemas import METRIC_WINDOW


def hourly_metrics_stream(
    trusted: DataFrame, window: str = METRIC_WINDOW, slide: str | None = None
) -> DataFrame:
    """Tumbling, or with `slide` sliding, metrics of a stream that carries a watermark.

    Distinct counts are estimated, as streams allow no exact ones; the batch metrics are exact.
    Tumbling windows also carry the date and hour they begin in, as those of the batch do.
    In append mode a window comes out once the watermark has passed its end, so the newest
    window is held back; complete and update mode give open windows too.
    """
    spans = F.window("event_timestamp", window, slide).alias("_window")
    metrics = trusted.groupBy(spans, *DIMENSIONS).agg(
        F.count("*").alias("event_count"),
        F.approx_count_distinct("event_id").alias("unique_events"),
        F.approx_count_distinct("entity_id").alias("unique_entities"),
        F.approx_count_distinct("session_id").alias("unique_sessions"),
        F.sum("amount_usd").alias("total_amount_usd"),
        F.avg("amount_usd").alias("avg_amount_usd"),
        F.min("event_timestamp").alias("first_event_at"),
        F.max("event_timestamp").alias("last_event_at"),
    )
    bounded = window_bounds(metrics)
    if slide:
        return bounded
    start = F.col("window_start")
    return bounded.withColumns({"event_date": F.to_date(start), "event_hour": F.hour(start)})
