"""Declared schemas, expectation rule sets and the outbound contract."""

from __future__ import annotations

import json

from pyspark.sql.types import StructType

# ---------------------------------------------------------------------------------------------
# The field names, types, rules, topics and source tables that messages, log
# readers and consumers agree on. `from_json` does not enforce NOT NULL; the rules below count it.
# ---------------------------------------------------------------------------------------------

PARTNER_TOPIC = "sap.masterdata.business_partner.raw"
EVENT_TOPIC = "platform.events.v1"

ENVELOPE = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

PARTNER_RAW = (
    "kafka_offset BIGINT, kafka_partition INT, kafka_ingest_timestamp TIMESTAMP, "
    "kafka_topic STRING, raw_payload STRING, message_key STRING, pipeline_ingested_at TIMESTAMP"
)

EVENT_RAW = (
    "kafka_offset BIGINT, kafka_timestamp TIMESTAMP, kafka_partition INT, raw_payload STRING, "
    "ingested_at TIMESTAMP"
)

PARTNER_PAYLOAD = (
    "bp_number STRING, bp_category STRING, full_name STRING, first_name STRING, last_name STRING, "
    "country_code STRING, region STRING, tax_number STRING, created_date STRING, "
    "changed_date STRING, is_active BOOLEAN, source_table STRING, sap_client STRING, "
    "event_type STRING"
)

EVENT_PAYLOAD = (
    "event_id STRING, event_type STRING, entity_id STRING, entity_type STRING, "
    "source_system STRING, event_timestamp TIMESTAMP, session_id STRING, amount DOUBLE, "
    "currency STRING, properties MAP<STRING, STRING>"
)

LOG_DETAILS = (
    "flow_progress STRUCT<name: STRING, status: STRING, "
    "metrics: STRUCT<num_output_rows: BIGINT, num_input_rows: BIGINT>, "
    "data_quality: STRUCT<expectations: ARRAY<STRUCT<name: STRING, passed_records: BIGINT, "
    "failed_records: BIGINT>>>>"
)

PARTNER_RULES = {
    "bp_number_not_null": "bp_number IS NOT NULL",
    "bp_category_valid": "bp_category IN ('1', '2', '3') OR bp_category IS NULL",
    "country_code_length": "country_code IS NULL OR LENGTH(country_code) = 2",
    "event_type_valid": "event_type IN ('INSERT', 'UPDATE', 'DELETE')",
    "sap_client_not_null": "sap_client IS NOT NULL",
}

PARTNER_RULES_STRICT = {
    "bp_number_not_null": "bp_number IS NOT NULL",
    "valid_bp_category": "bp_category IN ('1', '2', '3')",
    "country_code_valid": "LENGTH(country_code) = 2",
    "created_date_not_null": "created_date IS NOT NULL",
}

EVENT_RULES = {
    "event_id_not_null": "event_id IS NOT NULL",
    "event_type_not_null": "event_type IS NOT NULL",
    "timestamp_not_null": "event_timestamp IS NOT NULL",
    "amount_non_negative": "amount IS NULL OR amount >= 0",
    "entity_id_not_null": "entity_id IS NOT NULL",
}

EVENT_RULES_CHANGE_TYPES = {
    "valid_event_id": "event_id IS NOT NULL",
    "valid_timestamp": "event_timestamp IS NOT NULL",
    "valid_event_type": "event_type IN ('CREATE', 'UPDATE', 'DELETE')",
}

BASE_SOURCE = "BUT000"
BASE_FIELDS = (
    "bp_category", "first_name", "last_name", "is_active",
    "created_date_parsed", "changed_date_parsed", "trusted_processed_at",
)
SOURCE_FIELDS = {
    "KNA1": {
        "customer_name": "full_name",
        "customer_country": "country_code",
        "customer_region": "region",
    },
    "LFA1": {"vendor_name": "full_name", "vendor_tax_id": "tax_number"},
}

ALERT_THRESHOLD = 95.0
TREND_HOURS = 24
THROUGHPUT_ROWS = 100
LATE_DELAY = "5 minutes"
METRIC_WINDOW = "1 hour"
COMPACT_DATE = "yyyyMMdd"

CONTRACT_NAME = "BusinessPartner"
CONTRACT_NAMESPACE = "com.platform.masterdata.v1"
PARTNER_CONTRACT = (
    StructType()
    .add("sap_client", "string", nullable=False)
    .add("bp_number", "string", nullable=False)
    .add("bp_category", "string")
    .add("unified_name", "string")
    .add("customer_country", "string")
    .add("customer_region", "string")
    .add("vendor_tax_id", "string")
    .add("is_active", "boolean")
    .add("created_date_parsed", "string")
    .add("changed_date_parsed", "string")
    .add("gold_processed_at", "timestamp", nullable=False)
)

# ---------------------------------------------------------------------------------------------

AVRO_TYPES = {
    "string": "string",
    "boolean": "boolean",
    "int": "int",
    "bigint": "long",
    "double": "double",
    "timestamp": {"type": "long", "logicalType": "timestamp-millis"},
}


def avro_schema(
    contract: StructType = PARTNER_CONTRACT,
    name: str = CONTRACT_NAME,
    namespace: str = CONTRACT_NAMESPACE,
) -> str:
    """Avro record text of a contract: nullable fields become unions with a null default."""
    fields = []
    for field in contract:
        avro_type = AVRO_TYPES[field.dataType.simpleString()]
        if field.nullable:
            fields.append({"name": field.name, "type": ["null", avro_type], "default": None})
        else:
            fields.append({"name": field.name, "type": avro_type})
    return json.dumps({"type": "record", "name": name, "namespace": namespace, "fields": fields})
