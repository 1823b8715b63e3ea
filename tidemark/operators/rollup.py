"""Metrics that add up: partial states of events, merged into hours, sliding windows and days.

A state row holds what a set of events contributes to a metric in a form that merges: sums, counts, extremes,
sketches of distinct values, or bitmaps of their numbers. States of new rows stand beside those of earlier
ones and are merged when read, so earlier rows aren't read again, and each grain is a merge of the same states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import Moment, moment
from tidemark.operators.events import DIMENSIONS

PANE_SECONDS = 900
# Sketches of 2**12 registers: estimates lie within 5 % of the truth in 99.7 of 100 cases.
LG_K = 12
SKETCHED = {"unique_events": "event_id", "unique_entities": "entity_id", "unique_sessions": "session_id"}


def _pane(seconds: int) -> Column:
    return F.window("event_timestamp", f"{seconds} seconds").start


def pane_states(trusted: DataFrame, seconds: int = PANE_SECONDS, lg_k: int = LG_K) -> DataFrame:
    """One state per pane (a stretch of time that all windows are made of), type, source and entity type.

    Rows without a time are in no window and left out. One shuffle of partial states, whatever the number of
    distinct counts, as sketches replace the copy of the rows that each exact one costs.
    """
    return trusted.groupBy(_pane(seconds).alias("pane"), *DIMENSIONS).agg(
        F.count("*").alias("event_count"),
        F.sum("amount_usd").alias("amount"),
        F.count("amount_usd").alias("amounts"),
        F.min("event_timestamp").alias("first_event_at"),
        F.max("event_timestamp").alias("last_event_at"),
        *[F.hll_sketch_agg(column, lg_k).alias(name) for name, column in SKETCHED.items()],
    )


def merge_panes(states: DataFrame, by: Sequence[str | Column] = ("pane", *DIMENSIONS)) -> DataFrame:
    """States of the same group as one, of which there may be one from each micro-batch."""
    return states.groupBy(*by).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("amount").alias("amount"),
        F.sum("amounts").alias("amounts"),
        F.min("first_event_at").alias("first_event_at"),
        F.max("last_event_at").alias("last_event_at"),
        *[F.hll_union_agg(name, False).alias(name) for name in SKETCHED],
    )


def _windows(states: DataFrame, seconds: int, slide: int, pane: int) -> DataFrame:
    if seconds % slide or slide % pane:
        raise ValueError(f"windows of {seconds} s every {slide} s don't consist of panes of {pane} s")
    if seconds == slide:
        return states.withColumn("window_start", F.window("pane", f"{seconds} seconds").start)
    last = F.window("pane", f"{slide} seconds").start  # the latest window that holds the pane
    back, step = (F.expr(f"INTERVAL {n} SECONDS") for n in (seconds - slide, slide))
    return states.withColumn("window_start", F.explode(F.sequence(last - back, last, step)))


def metrics(
    states: DataFrame, seconds: int = 3600, slide: int | None = None, now: Moment = None, pane: int = PANE_SECONDS,
) -> DataFrame:
    """The columns of `events.hourly_metrics` for windows of any length that consists of panes, out of states.

    Distinct counts are estimates. Sliding windows copy a pane's state, never its events. Windows of an hour also carry their
    date and hour.
    """
    windows = _windows(states, seconds, slide or seconds, pane)
    merged = merge_panes(windows, ("window_start", *DIMENSIONS))
    calendar = {}
    if seconds == 3600 and slide is None:
        calendar = {"event_date": F.to_date("window_start"), "event_hour": F.hour("window_start")}
    return merged.select(
        "window_start", (F.col("window_start") + F.expr(f"INTERVAL {seconds} SECONDS")).alias("window_end"),
        *DIMENSIONS, *[c.alias(n) for n, c in calendar.items()], "event_count",
        *[F.hll_sketch_estimate(name).alias(name) for name in SKETCHED],
        F.col("amount").alias("total_amount_usd"),
        (F.col("amount") / F.nullif(F.col("amounts"), F.lit(0))).alias("avg_amount_usd"),
        "first_event_at", "last_event_at", moment(now).alias("gold_processed_at"),
    )


# --- days of entities -----------------------------------------------------------------------

ENTITY_DAY = ("entity_id", "entity_type", "event_date", "source_system")


def entity_states(trusted: DataFrame) -> DataFrame:
    """One state per entity, day and source."""
    return trusted.groupBy(*ENTITY_DAY).agg(
        F.count("*").alias("total_events"),
        F.collect_set("event_type").alias("event_types_seen"),
        F.sum("amount_usd").alias("daily_amount_usd"),
        F.min("event_timestamp").alias("first_activity"),
        F.max("event_timestamp").alias("last_activity"),
    )


def merge_entities(states: DataFrame) -> DataFrame:
    types = F.array_distinct(F.flatten(F.collect_set("event_types_seen")))
    return states.groupBy(*ENTITY_DAY).agg(
        F.sum("total_events").alias("total_events"),
        types.alias("event_types_seen"),
        F.sum("daily_amount_usd").alias("daily_amount_usd"),
        F.min("first_activity").alias("first_activity"),
        F.max("last_activity").alias("last_activity"),
    )


def entity_daily(states: DataFrame, now: Moment = None) -> DataFrame:
    """The rows of `events.entity_daily`, out of states; all of it is exact."""
    merged = merge_entities(states)
    return merged.withColumns({"event_types_seen": F.array_sort("event_types_seen"), "summary_created_at": moment(now)})


# --- exact distinct counts ------------------------------------------------------------------

COUNTED = {"unique_entities": "entity_id", "unique_sessions": "session_id"}


def new_numbers(values: DataFrame, known: DataFrame | None, first: int = 0) -> DataFrame:
    """(value, number) for the distinct values that `known` doesn't have yet, from `first` on.

    Numbers are dense within a task's share of the values, so a bitmap of 2**15 of them is well filled; the shares
    are far apart, so they needn't be counted first. Write the result before it is used: numbers are given anew each
    time it is computed.
    """
    fresh = values.where("value IS NOT NULL").distinct()
    if known is not None:
        fresh = fresh.join(known.select("value"), "value", "left_anti")
    return fresh.select("value", (F.lit(first).cast("long") + F.monotonically_increasing_id()).alias("number"))


def next_number(known: DataFrame) -> int:
    """Where the numbers of new values begin, behind all that are given."""
    most = known.agg(F.max("number")).first()[0]
    return 0 if most is None else ((most >> 33) + 1) << 33


def bitmap_states(
    trusted: DataFrame, numbers: DataFrame, column: str, seconds: int = 3600,
) -> DataFrame:
    """(pane, dimensions, part, bitmap): which of the numbered values of a column occur; 2**15 numbers a part."""
    rows = trusted.where(F.col(column).isNotNull()).select(
        _pane(seconds).alias("pane"), *DIMENSIONS, F.col(column).cast("string").alias("value"))
    numbered = rows.where("pane IS NOT NULL").join(numbers, "value")
    return numbered.groupBy("pane", *DIMENSIONS, F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def bitmap_counts(states: DataFrame, name: str, seconds: int, by: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Exact distinct counts of windows of whole panes: bitmaps of the same part are merged, then counted."""
    start = F.window("pane", f"{seconds} seconds").start.alias("window_start")
    merged = states.groupBy(start, *by, "part").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("window_start", *by).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
