from pyspark.sql import functions as F

from tidemark.operators.envelope import (
    EVENT_KEEP, bp_envelope, event_envelope, parse_messages, parse_payload,
)
from tidemark.plans import flows
from tidemark.schemas import ENVELOPE, EVENT_PAYLOAD

NOW = "2024-02-01 00:00:00"


def messages(spark, *texts):
    rows = [("k", text, "t", 1, 10 + i) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, p int, o bigint")
    return df.select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), "topic",
        F.col("p").alias("partition"), F.col("o").alias("offset"),
        F.lit("2024-01-01 10:00:00").cast("timestamp").alias("timestamp"),
    )


def test_envelope_columns_and_types(spark):
    df = messages(spark, "{}")
    assert spark.createDataFrame([], ENVELOPE).schema.names == df.schema.names
    partner = bp_envelope(df, NOW)
    assert [(f.name, f.dataType.simpleString()) for f in partner.schema] == [
        ("kafka_offset", "bigint"), ("kafka_partition", "int"),
        ("kafka_ingest_timestamp", "timestamp"), ("kafka_topic", "string"),
        ("raw_payload", "string"), ("message_key", "string"),
        ("pipeline_ingested_at", "timestamp"),
    ]
    assert event_envelope(df, NOW).columns == [
        "kafka_offset", "kafka_timestamp", "kafka_partition", "raw_payload", "ingested_at",
    ]


def test_malformed_and_missing_payloads_stay_as_rows_of_nulls(spark):
    good = '{"event_id":"e1","event_timestamp":"2024-01-01T10:30:00Z","amount":1.5,' \
           '"properties":{"k":69}}'
    raw = event_envelope(messages(spark, good, "{broken", None), NOW)
    rows = parse_payload(raw, EVENT_PAYLOAD, EVENT_KEEP).orderBy("kafka_offset").collect()
    assert [r.event_id for r in rows] == ["e1", None, None]
    assert rows[0].properties == {"k": "69"}
    assert rows[0].amount == 1.5
    assert len(flows.trusted_events(raw, NOW).collect()) == 3


def test_parsing_at_the_source_drops_the_text(spark):
    parsed = parse_messages(messages(spark, '{"event_id":"e1"}'), EVENT_PAYLOAD)
    assert parsed.columns[:4] == ["offset", "kafka_timestamp", "partition", "event_id"]
    assert "raw_payload" not in parsed.columns


def test_payload_is_parsed_once(spark, plan):
    parsed = flows.parsed_events(event_envelope(messages(spark, "{}"), NOW))
    assert plan(parsed).count("from_json") == 1
