"""Whole flows from raw rows to the trusted layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.functions.columns import Moment, moment
from tidemark.operators.dedup import (
    PARTNER_KEYS, PARTNER_ORDER, dedup_events, latest_by, whole_keys,
)
from tidemark.operators.envelope import EVENT_KEEP, PARTNER_KEEP, parse_payload
from tidemark.operators.events import add_event_columns
from tidemark.operators.partners import add_bp_columns
from tidemark.operators.quality import observe_rules
from tidemark.schemas import (
    EVENT_PAYLOAD, EVENT_RULES, LATE_DELAY, PARTNER_PAYLOAD, PARTNER_RULES,
)
from tidemark.streaming.dedup import dedup_stream, with_watermark

# Rows of several source tables share partner and event type; without the source table in the
# key they would evict each other.
TRUSTED_KEYS = (*PARTNER_KEYS, "source_table")


def parsed_partners(raw: DataFrame) -> DataFrame:
    return parse_payload(raw, PARTNER_PAYLOAD, PARTNER_KEEP)


def parsed_events(raw: DataFrame) -> DataFrame:
    return parse_payload(raw, EVENT_PAYLOAD, EVENT_KEEP)


def trusted_partners(
    parsed: DataFrame,
    now: Moment = None,
    keys: Sequence[str] = TRUSTED_KEYS,
    how: str = "window",
    order: Sequence[str] = PARTNER_ORDER,
) -> DataFrame:
    """The newest parsed row per key, with derived columns. Unreadable messages, and others with
    an incomplete key, stay one by one, so the rules count each."""
    return add_bp_columns(latest_by(parsed, whole_keys(keys), order, how=how), now)


def bp_trusted(
    raw: DataFrame,
    now: Moment = None,
    keys: Sequence[str] = TRUSTED_KEYS,
    how: str = "window",
    observation: Observation | None = None,
) -> DataFrame:
    """Parse, keep the newest row per key, derive, measure; in batch and inside `foreachBatch`.

    With an observation the rules are counted by the action that writes the rows.
    """
    trusted = trusted_partners(parsed_partners(raw), now, keys, how)
    return observe_rules(trusted, PARTNER_RULES, observation) if observation else trusted


def trusted_events(
    raw: DataFrame,
    now: Moment = None,
    rates=None,
    delay: str = LATE_DELAY,
    observation: Observation | None = None,
) -> DataFrame:
    """Parse, drop redelivered copies, derive, measure; on a stream the copies are those within
    `delay`, and `measure_stream` does the measuring."""
    parsed = parsed_events(raw)
    if parsed.isStreaming:
        unique = dedup_stream(with_watermark(parsed, "event_timestamp", delay))
    else:
        unique = dedup_events(parsed)
    trusted = add_event_columns(unique, now, rates)
    return observe_rules(trusted, EVENT_RULES, observation) if observation else trusted


def trusted_events_basic(parsed: DataFrame, now: Moment = None) -> DataFrame:
    """`parse_messages` rows without copies, with processing time and date; no watermark."""
    position, order = ("partition", "offset"), ("offset", "kafka_timestamp", "partition")
    if parsed.isStreaming:
        unique = dedup_stream(parsed, bounded=False, position=position, spread=order)
    else:
        unique = dedup_events(parsed, order=order, position=position)
    return unique.withColumns({
        "processing_timestamp": moment(now),
        "event_date": F.to_date("event_timestamp"),
    })
