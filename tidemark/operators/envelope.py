"""Raw layer: the message envelope and its payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import Moment, moment

PARTNER_KEEP = (
    "kafka_offset", "kafka_partition", "kafka_ingest_timestamp", "pipeline_ingested_at",
)
EVENT_KEEP = ("kafka_offset", "kafka_partition", "kafka_timestamp", "ingested_at")


def bp_envelope(messages: DataFrame, now: Moment = None) -> DataFrame:
    """Business-partner messages as raw rows: the payload stays text, the envelope is typed."""
    return messages.selectExpr(
        "CAST(offset AS BIGINT) AS kafka_offset",
        "CAST(partition AS INT) AS kafka_partition",
        "timestamp AS kafka_ingest_timestamp",
        "topic AS kafka_topic",
        "CAST(value AS STRING) AS raw_payload",
        "CAST(key AS STRING) AS message_key",
    ).withColumn("pipeline_ingested_at", moment(now))


def event_envelope(messages: DataFrame, now: Moment = None) -> DataFrame:
    """Event messages as raw rows."""
    return messages.selectExpr(
        "offset AS kafka_offset",
        "timestamp AS kafka_timestamp",
        "partition AS kafka_partition",
        "CAST(value AS STRING) AS raw_payload",
    ).withColumn("ingested_at", moment(now))


def parse_payload(
    raw: DataFrame, schema: str, keep: Sequence[str] = (), payload: str = "raw_payload"
) -> DataFrame:
    """The JSON payload as typed columns after the kept ones.

    The text is parsed once per row: conditions on its columns stay above the generator, where as
    conditions on a struct they would move below it and parse the text again, each for itself.
    Malformed text gives a row of NULLs, which stays in the data and is counted by the rules.
    """
    return raw.select(*keep, F.inline(F.array(F.from_json(payload, schema))))


def parse_messages(messages: DataFrame, schema: str) -> DataFrame:
    """Envelope and payload in one step, straight from the source; the text is not kept."""
    envelope = messages.select(
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        "partition",
        F.col("value").cast("string").alias("raw_payload"),
    )
    return parse_payload(envelope, schema, ("offset", "kafka_timestamp", "partition"))
