"""Plain SQL that states what each catalog query must return on the same tables."""

from __future__ import annotations

from collections.abc import Mapping

from tidemark.plans.catalog import LATE_AFTER, LOG_AS_OF, NOW, PARTNER_SPLIT, RATES, REPLAY, REPLAY_TO
from tidemark.sources.feeds import EVENT_PARTS, PARTNER_PARTS
from tidemark.schemas import (
    ALERT_THRESHOLD, EVENT_RULES, EVENT_RULES_CHANGE_TYPES, PARTNER_RULES, PARTNER_RULES_STRICT,
    THROUGHPUT_ROWS, TREND_HOURS,
)

STAMP = f"TIMESTAMP '{NOW}'"

# Deliveries: 0 the event, 1 a copy, 2 a copy ten minutes later, 3 an unreadable message.
EVENTS = """
ev AS (
  SELECT e.event_id * 4 + o.k AS kafka_offset,
         CAST(e.user_id % 4 AS INTEGER) AS kafka_partition,
         e.ts AS kafka_timestamp, o.k AS delivery,
         CASE WHEN k < 3 THEN e.event_id % 53 = 9 AND e.ts < TIMESTAMP '2024-01-11' ELSE false END AS late,
         CASE WHEN k < 3 AND e.event_id % 101 <> 7 THEN 'e' || CAST(e.event_id AS VARCHAR) END AS event_id,
         CASE WHEN k = 3 THEN NULL WHEN e.event_type = 'view' THEN 'PAGE_VIEW'
              ELSE upper(e.event_type) END AS event_type,
         CASE WHEN k < 3 AND e.event_id % 89 <> 0 THEN 'u' || CAST(e.user_id AS VARCHAR) END AS entity_id,
         CASE WHEN k < 3 THEN 'USER' END AS entity_type,
         CASE WHEN k = 3 THEN NULL WHEN e.event_id % 2 = 0 THEN 'web' ELSE 'app' END AS source_system,
         CASE k WHEN 3 THEN NULL WHEN 2 THEN e.ts + INTERVAL 10 MINUTE ELSE e.ts END AS event_timestamp,
         CASE WHEN k < 3 THEN 's' || CAST(e.user_id AS VARCHAR) || '-'
              || CAST(CAST(e.ts AS DATE) AS VARCHAR) END AS session_id,
         CASE WHEN k = 3 OR e.event_type <> 'purchase' THEN NULL
              WHEN e.event_id % 97 = 0 THEN -e.value ELSE e.value END AS amount,
         CASE WHEN k = 3 THEN NULL WHEN e.event_id % 3 = 0 THEN 'USD'
              WHEN e.event_id % 3 = 1 THEN 'EUR' END AS currency,
         CASE WHEN k < 3 THEN '{"k":"' || json_extract_string(e.props, '$.k') || '"}' END AS properties,
         e.event_id % 101 = 7 AS nameless
  FROM events e JOIN (VALUES (0), (1), (2), (3)) AS o(k)
    ON o.k = 0 OR (o.k = 1 AND e.event_id % 10 = 0) OR (o.k = 3 AND e.event_id % 103 = 5)
    OR (o.k = 2 AND e.event_id % 7 = 0 AND e.event_id % 53 <> 9 AND e.event_id % 101 <> 7
        AND minute(e.ts) < 50 AND hour(e.ts) <> 23 AND e.ts < TIMESTAMP '2024-01-21')
)"""

EVENT_COLUMNS = (
    "event_id, event_type, entity_id, entity_type, source_system, event_timestamp, session_id, "
    "amount, currency, properties"
)
EVENT_POSITION = f"kafka_offset, kafka_partition, kafka_timestamp, {STAMP} AS ingested_at"

def _unique(where: str = "true") -> str:
    return f"""{EVENTS},
uniq AS (
  SELECT *, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date,
         CAST(hour(event_timestamp) AS INTEGER) AS event_hour, amount AS amount_usd
  FROM ev WHERE {where} QUALIFY row_number() OVER (
    PARTITION BY event_id, CASE WHEN event_id IS NULL THEN kafka_offset END ORDER BY kafka_offset) = 1
)"""


UNIQUE_EVENTS = _unique()
# What a stream with a watermark takes: events two parts late are dropped.
STREAM_EVENTS = _unique("NOT late")
# Without one the late events are taken as well.

EVENT_TEXT = """CASE WHEN delivery = 3 THEN
  CASE WHEN nameless THEN '{"event_type' ELSE '{"event_id":' END ELSE '{'
  || coalesce('"event_id":"' || event_id || '",', '') || '"event_type":"' || event_type || '"'
  || coalesce(',"entity_id":"' || entity_id || '"', '')
  || ',"entity_type":"USER","source_system":"' || source_system
  || '","event_timestamp":"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
  || '","session_id":"' || session_id || '"'
  || coalesce(',"amount":' || CAST(amount AS VARCHAR), '')
  || coalesce(',"currency":"' || currency || '"', '')
  || ',"properties":' || properties || '}' END"""

# Messages: 0 to 2 of the source tables, 3 unreadable, 4 a customer row again on another partition.
PARTNERS = f"""
bp AS (
  SELECT CASE WHEN k = 3 OR k = 0 AND o.o_orderkey % 211 = 3 THEN NULL ELSE '100' END AS sap_client,
         CASE WHEN k <> 3 THEN lpad(CAST(o.o_custkey AS VARCHAR), 10, '0') END AS bp_number,
         CASE WHEN k = 3 THEN NULL WHEN o.o_orderstatus = 'O' THEN 'INSERT'
              WHEN o.o_orderstatus = 'F' THEN 'UPDATE' ELSE 'DELETE' END AS event_type,
         CASE WHEN k <> 3 THEN t.st END AS source_table, t.k AS message,
         o.o_orderkey * 4 + CASE k WHEN 4 THEN 1 ELSE k END AS kafka_offset,
         CAST((o.o_custkey + CASE k WHEN 4 THEN 1 ELSE 0 END) % 4 AS INTEGER) AS kafka_partition,
         o.o_orderdate + CASE k WHEN 4 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS kafka_ingest_timestamp,
         {STAMP} AS pipeline_ingested_at, lpad(CAST(o.o_custkey AS VARCHAR), 10, '0') AS message_key,
         CASE WHEN k = 3 THEN NULL WHEN o.o_custkey % 5 < 4
              THEN CAST(o.o_custkey % 5 + 1 AS VARCHAR) END AS bp_category,
         CASE WHEN k = 1 AND o.o_custkey % 11 <> 0 THEN c.c_name
              WHEN k = 4 AND o.o_custkey % 11 <> 0 THEN c.c_name || ' II'
              WHEN k = 2 THEN s.s_name END AS full_name,
         CASE WHEN k = 0 AND o.o_custkey % 7 <> 0
              THEN 'First' || CAST(o.o_custkey AS VARCHAR) END AS first_name,
         CASE WHEN k = 0 AND o.o_custkey % 7 <> 0
              THEN 'Last' || CAST(o.o_custkey AS VARCHAR) END AS last_name,
         CASE WHEN k = 3 THEN NULL
              WHEN c.c_nationkey % 10 = 0 THEN 'N' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0')
              WHEN c.c_nationkey % 10 = 1 THEN NULL
              ELSE lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') END AS country_code,
         CASE WHEN k <> 3 THEN r.r_name END AS region,
         CASE WHEN k = 2 THEN 'T' || CAST(s.s_suppkey AS VARCHAR) END AS tax_number,
         CASE WHEN k = 3 THEN NULL WHEN o.o_orderkey % 50 = 0 THEN '00000000'
              ELSE strftime(o.o_orderdate, '%Y%m%d') END AS created_date,
         CASE WHEN k <> 3 THEN strftime(o.o_orderdate, '%Y%m%d') END AS changed_date,
         CASE WHEN k <> 3 THEN o.o_orderstatus <> 'P' END AS is_active
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN supplier s ON s.s_suppkey = o.o_custkey
  JOIN (VALUES ('BUT000', 0), ('KNA1', 1), ('LFA1', 2), ('BUT000', 3), ('KNA1', 4)) AS t(st, k)
    ON k < 2 OR (k = 2 AND s.s_suppkey IS NOT NULL) OR (k = 3 AND o.o_orderkey % 107 = 11)
    OR (k = 4 AND o.o_orderkey % 97 = 5)
)"""

PARTNER_TEXT = """CASE WHEN message = 3 THEN '{"bp_number"' ELSE '{"bp_number":"' || bp_number || '"'
  || coalesce(',"bp_category":"' || bp_category || '"', '')
  || coalesce(',"full_name":"' || full_name || '"', '')
  || coalesce(',"first_name":"' || first_name || '"', '')
  || coalesce(',"last_name":"' || last_name || '"', '')
  || coalesce(',"country_code":"' || country_code || '"', '')
  || ',"region":"' || region || '"'
  || coalesce(',"tax_number":"' || tax_number || '"', '')
  || ',"created_date":"' || created_date || '","changed_date":"' || changed_date
  || '","is_active":' || CAST(is_active AS VARCHAR) || ',"source_table":"' || source_table
  || '"' || coalesce(',"sap_client":"' || sap_client || '"', '')
  || ',"event_type":"' || event_type || '"}' END"""


OFFSETS = "kafka_offset DESC, kafka_ingest_timestamp DESC, kafka_partition DESC"
TIMES = "kafka_ingest_timestamp DESC, kafka_partition DESC, kafka_offset DESC"
# Rows with a NULL in their key are told apart by their place in the topic.
PLACE = "kafka_partition * 1e15 + kafka_offset"


def _newest(
    keys: str, source: str = "bp", where: str = "true", order: str = OFFSETS, apart: bool = False
) -> str:
    place = ""
    if apart:
        missing = " OR ".join(f"{key.strip()} IS NULL" for key in keys.split(","))
        place = f", CASE WHEN {missing} THEN {PLACE} END"
    return (
        f"SELECT * FROM {source} WHERE {where} QUALIFY row_number() OVER "
        f"(PARTITION BY {keys}{place} ORDER BY {order}) = 1"
    )


KEYS = "sap_client, bp_number, event_type"
SOURCE_KEYS = "sap_client, bp_number, source_table"


def _trusted(name: str, where: str = "true", order: str = OFFSETS) -> str:
    return f"""{name} AS (
  SELECT *, {STAMP} AS trusted_processed_at,
         CAST(CAST(try_strptime(created_date, '%Y%m%d') AS DATE) AS VARCHAR) AS created_date_parsed,
         CAST(CAST(try_strptime(changed_date, '%Y%m%d') AS DATE) AS VARCHAR) AS changed_date_parsed
  FROM ({_newest(KEYS + ', source_table', where=where, order=order, apart=True)})
)"""


def _unified(name: str, trusted: str, active_only: bool = False, order: str = OFFSETS) -> str:
    keep = "WHERE NOT coalesce(b.event_type = 'DELETE', false)" if active_only else ""
    return f"""{name} AS (
  WITH newest AS ({_newest(SOURCE_KEYS, trusted, order=order)})
  SELECT b.sap_client, b.bp_number, b.bp_category, b.first_name, b.last_name, b.is_active,
         b.created_date_parsed, b.changed_date_parsed, b.trusted_processed_at,
         c.full_name AS customer_name, c.country_code AS customer_country,
         c.region AS customer_region, v.full_name AS vendor_name, v.tax_number AS vendor_tax_id,
         coalesce(c.full_name, v.full_name,
                  nullif(concat_ws(' ', b.first_name, b.last_name), '')) AS unified_name,
         {STAMP} AS gold_processed_at
  FROM (SELECT * FROM newest WHERE source_table = 'BUT000') b
  LEFT JOIN (SELECT * FROM newest WHERE source_table = 'KNA1') c USING (sap_client, bp_number)
  LEFT JOIN (SELECT * FROM newest WHERE source_table = 'LFA1') v USING (sap_client, bp_number)
  {keep}
)"""


TRUSTED = f"{PARTNERS},\n{_trusted('trusted')}"
UNIFIED = f"{TRUSTED},\n{_unified('unified', 'trusted')}"


def _entity_text(stamp: str) -> str:
    return f"""'{{' || coalesce('"sap_client":"' || sap_client || '",', '') || '"bp_number":"' || bp_number || '"'
  || coalesce(',"bp_category":"' || bp_category || '"', '')
  || coalesce(',"unified_name":"' || unified_name || '"', '')
  || coalesce(',"customer_country":"' || customer_country || '"', '')
  || coalesce(',"customer_region":"' || customer_region || '"', '')
  || coalesce(',"vendor_tax_id":"' || vendor_tax_id || '"', '')
  || coalesce(',"is_active":' || CAST(is_active AS VARCHAR), '')
  || coalesce(',"created_date_parsed":"' || created_date_parsed || '"', '')
  || coalesce(',"changed_date_parsed":"' || changed_date_parsed || '"', '')
  || ',"gold_processed_at":{stamp}}}'"""


ISO_STAMP = '"' + NOW.replace(" ", "T") + '.000Z"'
MILLIS_STAMP = "' || CAST(epoch_ms(" + STAMP + ") AS VARCHAR) || '"


def _measured(rules: Mapping[str, str], source: str, by: str = "") -> str:
    """Counts of each rule, one SELECT per rule; a NULL outcome counts as failed."""
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{name}' AS name, "
        f"CAST(count(*) FILTER (WHERE ({rule}) IS TRUE) AS BIGINT) AS passed_records, "
        f"CAST(count(*) FILTER (WHERE ({rule}) IS NOT TRUE) AS BIGINT) AS failed_records "
        f"FROM {source}{group}"
        for name, rule in rules.items()
    )


def _summary(measured: str) -> str:
    return f"""SELECT name AS expectation_name,
  CAST(sum(passed_records) AS BIGINT) AS passed_records,
  CAST(sum(failed_records) AS BIGINT) AS failed_records,
  CAST(sum(passed_records) + sum(failed_records) AS BIGINT) AS total_records,
  CAST(round(sum(passed_records) * 100.0 / nullif(sum(passed_records) + sum(failed_records), 0), 2)
       AS DOUBLE) AS pass_rate_pct
FROM ({measured}) GROUP BY name"""


def _metrics(span: str, calendar: str, source: str) -> str:
    keys = f"window_start, event_type, source_system, entity_type{calendar}"
    return f"""SELECT event_type, source_system, entity_type{calendar},
  count(*) AS event_count, count(DISTINCT event_id) AS unique_events,
  count(DISTINCT entity_id) AS unique_entities, count(DISTINCT session_id) AS unique_sessions,
  round(sum(amount_usd), 4) AS total_amount_usd, round(avg(amount_usd), 6) AS avg_amount_usd,
  min(event_timestamp) AS first_event_at, max(event_timestamp) AS last_event_at,
  window_start, window_start + INTERVAL 1 HOUR AS window_end, {STAMP} AS gold_processed_at
FROM (SELECT *, {span} AS window_start FROM {source}) WHERE event_timestamp IS NOT NULL
GROUP BY {keys}"""


def _estimated(metrics: str) -> str:
    """Distinct counts that are only compared as lying near the exact ones."""
    near = ", ".join(f"true AS {name}" for name in ("unique_events", "unique_entities", "unique_sessions"))
    return f"SELECT * REPLACE ({near}) FROM ({metrics})"


def _stream_metrics(span: str, calendar: str, source: str) -> str:
    metrics = _metrics(span, calendar, source)
    return f"SELECT * EXCLUDE (gold_processed_at) FROM ({_estimated(metrics)})"


def _entity_daily(source: str) -> str:
    return f"""WITH {source}
SELECT entity_id, entity_type, event_date, source_system, count(*) AS total_events,
  coalesce(string_agg(DISTINCT event_type, ',' ORDER BY event_type), '') AS event_types_seen,
  round(sum(amount_usd), 4) AS daily_amount_usd, min(event_timestamp) AS first_activity,
  max(event_timestamp) AS last_activity, {STAMP} AS summary_created_at
FROM uniq GROUP BY entity_id, entity_type, event_date, source_system"""


def _exact(grain: str, span: str) -> str:
    """Groups with neither an entity nor a session have no bitmap and no row."""
    return f"""SELECT '{grain}' AS grain, {span} AS window_start, event_type, source_system, entity_type,
  count(DISTINCT entity_id) AS unique_entities, count(DISTINCT session_id) AS unique_sessions
FROM uniq WHERE event_timestamp IS NOT NULL GROUP BY ALL HAVING count(entity_id) + count(session_id) > 0"""


DAY = "date_trunc('day', event_timestamp)"
HOUR = "date_trunc('hour', event_timestamp)"
CALENDAR = ", event_date, event_hour"
# Four windows of an hour, a quarter apart, cover each event.
QUARTERS = "CROSS JOIN (VALUES (0), (15), (30), (45)) AS q(minutes)"
SLIDING = f"(SELECT * FROM uniq {QUARTERS})"
# Windows of 50 minutes: four may begin early enough, the last event of the first decides.
SHORT = f"(SELECT * FROM uniq {QUARTERS} WHERE event_timestamp < time_bucket(INTERVAL 15 MINUTES, event_timestamp) - to_minutes(minutes) + INTERVAL 50 MINUTE)"
SLIDE = "time_bucket(INTERVAL 15 MINUTES, event_timestamp) - to_minutes(minutes)"

LOG = f"""{EVENTS},{PARTNERS},
evlog AS (SELECT *, {HOUR} + INTERVAL 59 MINUTE AS logged_at FROM ev),
bplog AS (SELECT *, date_trunc('day', kafka_ingest_timestamp) + INTERVAL 23 HOUR AS logged_at FROM bp),
logged AS (
  {_measured(EVENT_RULES, 'evlog', 'logged_at')} UNION ALL {_measured(PARTNER_RULES, 'bplog', 'logged_at')}
)"""

_OLD = f"kafka_ingest_timestamp < TIMESTAMP '{PARTNER_SPLIT}'"
_REPLAYED = " OR ".join(
    " AND ".join(
        [f"kafka_partition = {part}"]
        + ([f"kafka_offset >= {first}"] if first is not None else [])
        + ([f"kafka_offset <= {last}"] if last is not None else [])
    )
    for part, first, last in REPLAY
)
_RATE = " ".join(f"WHEN '{code}' THEN {rate!r}" for code, rate in RATES.items())
_BP_PAYLOAD = (
    "bp_number, bp_category, full_name, first_name, last_name, country_code, region, tax_number, "
    "created_date, changed_date, is_active, source_table, sap_client, event_type"
)
_BP_COLUMNS = (
    f"kafka_offset, kafka_partition, kafka_ingest_timestamp, pipeline_ingested_at, {_BP_PAYLOAD}"
)
_SNAPSHOT = f"SELECT {SOURCE_KEYS}, event_type, full_name, changed_date, is_active FROM"

_CHANGES = f"""WITH {PARTNERS},
a AS ({_SNAPSHOT} ({_newest(SOURCE_KEYS, where=_OLD)}) WHERE event_type <> 'DELETE'),
b AS ({_SNAPSHOT} ({_newest(SOURCE_KEYS)}) WHERE event_type <> 'DELETE'),
gone AS (SELECT * FROM a EXCEPT SELECT * FROM b),
came AS (SELECT * FROM b EXCEPT SELECT * FROM a)
SELECT CASE WHEN EXISTS (SELECT 1 FROM b WHERE b.source_table IS NOT DISTINCT FROM gone.source_table
                         AND b.bp_number IS NOT DISTINCT FROM gone.bp_number
                         AND b.sap_client IS NOT DISTINCT FROM gone.sap_client)
            THEN 'update_pre' ELSE 'delete' END AS change_type, * FROM gone
UNION ALL
SELECT CASE WHEN EXISTS (SELECT 1 FROM a WHERE a.source_table IS NOT DISTINCT FROM came.source_table
                         AND a.bp_number IS NOT DISTINCT FROM came.bp_number
                         AND a.sap_client IS NOT DISTINCT FROM came.sap_client)
            THEN 'update_post' ELSE 'insert' END AS change_type, * FROM came"""

_FED = f"SELECT {KEYS}, source_table, kafka_partition, kafka_offset, full_name, changed_date FROM"
_FIRST = f"kafka_ingest_timestamp < TIMESTAMP '{PARTNER_PARTS[0]}'"
_FED_KEYS = f"{KEYS}, source_table".split(", ")
# Rows with a NULL in their key are never an update of one another.
_PLACED = f"CASE WHEN {' OR '.join(f'{key} IS NULL' for key in _FED_KEYS)} THEN {PLACE} END"
_SAME = " AND ".join(f"a.{key} IS NOT DISTINCT FROM b.{key}" for key in (*_FED_KEYS, "place"))
_DIFFERS = "a.kafka_offset <> b.kafka_offset OR a.kafka_partition <> b.kafka_partition"
_CHANGES_VERSIONS = f"""WITH {PARTNERS},
a AS (SELECT *, {_PLACED} AS place FROM ({_FED} ({_newest(", ".join(_FED_KEYS), where=_FIRST, order=TIMES, apart=True)}))),
b AS (SELECT *, {_PLACED} AS place FROM ({_FED} ({_newest(", ".join(_FED_KEYS), order=TIMES, apart=True)})))
SELECT CASE WHEN b.kafka_offset IS NULL THEN 'delete' ELSE 'update_pre' END AS change_type, a.* EXCLUDE (place)
FROM a LEFT JOIN b ON {_SAME} WHERE b.kafka_offset IS NULL OR {_DIFFERS}
UNION ALL
SELECT CASE WHEN a.kafka_offset IS NULL THEN 'insert' ELSE 'update_post' END, b.* EXCLUDE (place)
FROM b LEFT JOIN a ON {_SAME} WHERE a.kafka_offset IS NULL OR {_DIFFERS}"""

_WATCHED = "unified_name, is_active, created_date_parsed, changed_date_parsed"

_TRUSTED_EVENTS = (
    f"{EVENT_COLUMNS}, event_date, event_hour, {STAMP} AS trusted_at, amount_usd FROM uniq"
)
_DERIVED = f"""{EVENTS},
derived AS (SELECT *, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date,
  CAST(hour(event_timestamp) AS INTEGER) AS event_hour, amount AS amount_usd FROM ev)"""
_HOURLY = f"WITH {UNIQUE_EVENTS} {_metrics(HOUR, CALENDAR, 'uniq')}"
_BP_LATEST = f"WITH {PARTNERS} SELECT {_BP_COLUMNS} FROM ({_newest(KEYS)})"
_BP_TRUSTED = (
    f"WITH {TRUSTED} SELECT {_BP_COLUMNS}, trusted_processed_at, created_date_parsed, "
    "changed_date_parsed FROM trusted"
)
_EVENTS_UPSERT = f"""WITH {EVENTS} SELECT {EVENT_POSITION}, {EVENT_COLUMNS} FROM ev
QUALIFY row_number() OVER (PARTITION BY event_id, CASE WHEN event_id IS NULL THEN kafka_offset END
                           ORDER BY kafka_offset DESC) = 1"""
_BP_UPSERT = f"WITH {PARTNERS} SELECT {_BP_COLUMNS} FROM ({_newest(SOURCE_KEYS, apart=True)})"


def oracle_sql() -> dict[str, str]:
    return {
        "raw_events_stream": f"""WITH {EVENTS}
SELECT {EVENT_POSITION}, {EVENT_TEXT} AS raw_payload FROM ev""",
        "raw_replay": f"""WITH {EVENTS}
SELECT {EVENT_POSITION}, {EVENT_TEXT} AS raw_payload FROM ev WHERE {_REPLAYED}""",
        "raw_replay_clustered": f"""WITH {EVENTS}
SELECT {EVENT_POSITION}, {EVENT_TEXT} AS raw_payload FROM ev WHERE {_REPLAYED}""",
        "raw_replay_table": f"""WITH {EVENTS}
SELECT {EVENT_POSITION}, {EVENT_TEXT} AS raw_payload FROM ev
WHERE ({_REPLAYED}) AND kafka_timestamp < DATE '{REPLAY_TO}' + INTERVAL 1 DAY""",
        "raw_parse_flat": f"""WITH {EVENTS}
SELECT kafka_offset AS "offset", kafka_timestamp, kafka_partition AS "partition", {EVENT_COLUMNS}
FROM ev""",
        "events_parsed": f"WITH {EVENTS} SELECT {EVENT_POSITION}, {EVENT_COLUMNS} FROM ev",
        "bp_raw_envelope": f"""WITH {PARTNERS}
SELECT kafka_offset, kafka_partition, kafka_ingest_timestamp,
  'sap.masterdata.business_partner.raw' AS kafka_topic, {PARTNER_TEXT} AS raw_payload,
  message_key, pipeline_ingested_at FROM bp""",
        "bp_parsed": f"WITH {PARTNERS} SELECT {_BP_COLUMNS} FROM bp",
        "events_dedup": f"WITH {UNIQUE_EVENTS} SELECT {EVENT_POSITION}, {EVENT_COLUMNS} FROM uniq",
        "trusted_events": f"WITH {UNIQUE_EVENTS} SELECT {EVENT_POSITION}, {_TRUSTED_EVENTS}",
        "trusted_events_basic": f"""WITH {UNIQUE_EVENTS}
SELECT kafka_offset AS "offset", kafka_timestamp, kafka_partition AS "partition", {EVENT_COLUMNS},
  {STAMP} AS processing_timestamp, event_date FROM uniq""",
        "amount_fx": f"""WITH {UNIQUE_EVENTS}
SELECT event_id, currency, amount,
  round(amount * CASE currency {_RATE} ELSE 1.0 END, 6) AS amount_usd FROM uniq""",
        "amount_fx_table": f"""WITH {UNIQUE_EVENTS},
rates AS (SELECT currency, round(avg(amount) / 100, 2) AS rate FROM ev
          WHERE amount > 0 AND currency IS NOT NULL GROUP BY currency)
SELECT event_id, uniq.currency, amount,
  round(amount * coalesce(rate, 1.0), 6) AS amount_usd
FROM uniq LEFT JOIN rates ON uniq.currency = rates.currency""",
        "events_dedup_stream": f"WITH {STREAM_EVENTS} SELECT {EVENT_COLUMNS} FROM uniq",
        "events_dedup_unbounded_stream": f"""WITH {UNIQUE_EVENTS}
SELECT {EVENT_COLUMNS}, {STAMP} AS processing_timestamp, event_date FROM uniq""",
        "trusted_events_stream": f"WITH {STREAM_EVENTS} SELECT {_TRUSTED_EVENTS}",
        "hourly_event_metrics": _HOURLY,
        "hourly_event_metrics_general": f"WITH {_DERIVED} {_metrics(HOUR, CALENDAR, 'derived')}",
        "sliding_event_metrics": f"WITH {UNIQUE_EVENTS} {_metrics(SLIDE, '', SLIDING)}",
        "sliding_event_metrics_general": f"""WITH {_DERIVED}
{_metrics(SLIDE, '', f'(SELECT * FROM derived {QUARTERS})')}""",
        "sliding_event_metrics_window": f"""WITH {UNIQUE_EVENTS}
SELECT * REPLACE (window_start + INTERVAL 50 MINUTE AS window_end) FROM ({_metrics(SLIDE, '', SHORT)})""",
        "hourly_event_metrics_approx": f"WITH {UNIQUE_EVENTS} {_estimated(_metrics(HOUR, CALENDAR, 'uniq'))}",
        "event_gold_refresh": f"WITH {STREAM_EVENTS} {_metrics(HOUR, CALENDAR, 'uniq')}",
        "hourly_metrics_basic": f"""WITH {UNIQUE_EVENTS}
SELECT event_type, source_system, count(*) AS event_count,
  count(DISTINCT entity_id) AS unique_entities, min(event_timestamp) AS window_start,
  max(event_timestamp) AS window_end, {HOUR} AS hour_start
FROM uniq WHERE event_timestamp IS NOT NULL GROUP BY {HOUR}, event_type, source_system""",
        "type_source_metrics": f"""WITH {UNIQUE_EVENTS}
SELECT event_type, source_system, count(*) AS event_count,
  count(DISTINCT entity_id) AS unique_entities, round(sum(amount_usd), 4) AS total_amount_usd
FROM uniq GROUP BY event_type, source_system""",
        "entity_daily_summary": _entity_daily(UNIQUE_EVENTS),
        "hourly_counts_stream": f"WITH {STREAM_EVENTS} {_stream_metrics(HOUR, CALENDAR, 'uniq')}",
        "sliding_counts_stream": f"WITH {STREAM_EVENTS} {_stream_metrics(SLIDE, '', SLIDING)}",
        "hourly_gold_deltas": f"WITH {STREAM_EVENTS} {_estimated(_metrics(HOUR, CALENDAR, 'uniq'))}",
        "sliding_gold_deltas": f"WITH {STREAM_EVENTS} {_estimated(_metrics(SLIDE, '', SLIDING))}",
        "entity_gold_deltas": _entity_daily(STREAM_EVENTS),
        "metrics_by_grain": f"""WITH {UNIQUE_EVENTS} SELECT * EXCLUDE (avg_amount_usd) FROM (
SELECT * REPLACE (window_start + INTERVAL 1 DAY AS window_end), 'day' AS grain FROM ({_estimated(_metrics(DAY, '', 'uniq'))})
UNION ALL SELECT *, 'hour' FROM ({_estimated(_metrics(HOUR, '', 'uniq'))})
UNION ALL SELECT *, 'sliding' FROM ({_estimated(_metrics(SLIDE, '', SLIDING))}))""",
        "exact_distinct_rollup": f"WITH {STREAM_EVENTS} {_exact('hour', HOUR)} UNION ALL {_exact('day', DAY)}",
        "late_rows_kept": f"""WITH {EVENTS}, parts AS (
  SELECT *, CASE WHEN late THEN 2 ELSE (kafka_timestamp >= DATE '{EVENT_PARTS[0]}')::INT + (kafka_timestamp >= DATE '{EVENT_PARTS[1]}')::INT
         + (delivery = 2)::INT END AS part FROM ev
), marks AS (SELECT p AS part, max(event_timestamp) AS mark FROM range(3) AS r(p) JOIN parts ON parts.part < p GROUP BY p)
SELECT kafka_offset, event_id, event_timestamp, coalesce(event_timestamp < mark - INTERVAL {LATE_AFTER}, false) AS is_late
FROM parts LEFT JOIN marks USING (part)""",
        "late_windows_repaired": f"WITH {_DERIVED} {_metrics(HOUR, CALENDAR, 'derived')}",
        "raw_payload_paths": f"""WITH {EVENTS}, raw AS (SELECT kafka_partition, {EVENT_TEXT} AS raw_payload FROM ev),
nodes AS (
  SELECT kafka_partition, regexp_replace(replace(t.fullkey, '"', ''), '\\[[0-9]+\\]', '[*]', 'g') AS path, t.type FROM raw, json_tree(raw_payload) AS t WHERE json_valid(raw_payload)
  UNION ALL SELECT kafka_partition, '$', 'UNREADABLE' FROM raw WHERE NOT json_valid(raw_payload)
)
SELECT kafka_partition, path, CASE WHEN type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'NUMBER' WHEN type = 'VARCHAR' THEN 'STRING' ELSE type END AS kind, count(*) AS n
FROM nodes GROUP BY ALL""",
        "bp_latest": _BP_LATEST,
        "bp_latest_agg": _BP_LATEST,
        "bp_latest_string_offset": f"""WITH latest AS ({_BP_LATEST})
SELECT * REPLACE (CAST(kafka_offset AS VARCHAR) AS kafka_offset) FROM latest""",
        "bp_trusted": _BP_TRUSTED,
        "bp_latest_stream": _BP_TRUSTED,
        "bp_latest_folded": _BP_TRUSTED,
        "bp_gold_incremental": f"""WITH {PARTNERS}, {_trusted('trusted', order=TIMES)},
{_unified('unified', 'trusted', order=TIMES)} SELECT * FROM unified""",
        "bp_unified": f"WITH {UNIFIED} SELECT * FROM unified",
        "bp_unified_pivot": f"WITH {UNIFIED} SELECT * FROM unified",
        "bp_unified_buckets": f"WITH {UNIFIED} SELECT * FROM unified",
        "bp_unified_active": f"""WITH {TRUSTED}, {_unified('unified', 'trusted', True)}
SELECT * FROM unified""",
        "bp_entity_json": f"""WITH {UNIFIED}
SELECT sap_client, bp_number, {_entity_text(ISO_STAMP)} AS entity_json FROM unified""",
        "publish_messages": f"""WITH {UNIFIED}
SELECT bp_number AS key, {_entity_text(MILLIS_STAMP)} AS value FROM unified WHERE sap_client IS NOT NULL""",
        "publish_contract_versions": f"""WITH {UNIFIED}
SELECT sap_client, bp_number, bp_category, unified_name AS display_name, customer_country, customer_region, is_active,
  created_date_parsed, changed_date_parsed, gold_processed_at,
  CASE WHEN bp_number::BIGINT % 2 = 1 THEN bp_category::INT END AS risk_class,
  CASE WHEN bp_number::BIGINT % 2 = 1 THEN 'crm' ELSE 'sap' END AS origin
FROM unified WHERE sap_client IS NOT NULL""",
        "publish_breaches": f"""WITH {UNIFIED}
SELECT sap_client, bp_number, 'sap_client' AS missing_fields FROM unified WHERE sap_client IS NULL""",
        "publish_changed_messages": f"""WITH {TRUSTED}, {_unified('unified', 'trusted', True)},
{_trusted('early', _OLD)}, {_unified('before', 'early', True)},
changed AS (SELECT sap_client, bp_number, {_WATCHED} FROM unified
            EXCEPT SELECT sap_client, bp_number, {_WATCHED} FROM before)
SELECT bp_number AS key, {_entity_text(MILLIS_STAMP)} AS value
FROM unified SEMI JOIN changed USING (sap_client, bp_number)
UNION ALL
SELECT DISTINCT bp_number, NULL FROM before
WHERE bp_number NOT IN (SELECT bp_number FROM unified)""",
        "events_upsert": _EVENTS_UPSERT,
        "events_upsert_stream": _EVENTS_UPSERT,
        "bp_upsert": _BP_UPSERT,
        "bp_upsert_touched": _BP_UPSERT,
        "bp_upsert_buckets": _BP_UPSERT,
        "bp_upsert_clustered": _BP_UPSERT,
        "bp_change_feed": _CHANGES,
        "bp_changes_versions": _CHANGES_VERSIONS,
        "dq_bp_counts": f"WITH {PARTNERS} {_measured(PARTNER_RULES, 'bp')}",
        "dq_bp_counts_strict": f"WITH {PARTNERS} {_measured(PARTNER_RULES_STRICT, 'bp')}",
        "dq_bp_trusted_counts": f"WITH {TRUSTED} {_measured(PARTNER_RULES, 'trusted')}",
        "dq_event_counts": f"WITH {EVENTS} {_measured(EVENT_RULES, 'ev')}",
        "dq_event_counts_change_types": f"WITH {EVENTS} {_measured(EVENT_RULES_CHANGE_TYPES, 'ev')}",
        "dq_event_trusted_counts": f"WITH {UNIQUE_EVENTS} {_measured(EVENT_RULES, 'uniq')}",
        "dq_event_daily_counts": f"""WITH {UNIQUE_EVENTS}
{_measured(EVENT_RULES, 'uniq', 'event_date, source_system')}""",
        "dq_tagged_rows": f"""WITH {PARTNERS}
SELECT kafka_offset, bp_number, source_table, concat_ws(',',
{', '.join(f"CASE WHEN ({rule}) IS NOT TRUE THEN '{name}' END" for name, rule in PARTNER_RULES.items())}
) AS failed_rules FROM bp""",
        "dq_valid_country": f"""WITH {PARTNERS}
SELECT kafka_offset, bp_number, country_code FROM bp WHERE {PARTNER_RULES['country_code_length']}""",
        "dq_valid_category": f"""WITH {PARTNERS}
SELECT kafka_offset, bp_number, bp_category FROM bp WHERE {PARTNER_RULES['bp_category_valid']}""",
        "dq_event_counts_stream": f"WITH {EVENTS} {_summary(_measured(EVENT_RULES, 'ev'))}",
        "dq_summary": f"WITH {LOG} {_summary('SELECT * FROM logged')}",
        "dq_failure_trend": f"""WITH {LOG}
SELECT date_trunc('hour', logged_at) AS hour_bucket, name AS expectation_name,
  CAST(sum(failed_records) AS BIGINT) AS failed_records
FROM logged
WHERE failed_records > 0 AND logged_at >= TIMESTAMP '{LOG_AS_OF}' - INTERVAL {TREND_HOURS} HOUR
GROUP BY 1, 2""",
        "flow_throughput": f"""WITH {LOG}
SELECT logged_at AS "timestamp", 'trusted_events' AS flow_name,
  count(DISTINCT event_id) AS output_rows, count(*) AS input_rows, 'COMPLETED' AS status
FROM evlog GROUP BY logged_at
UNION ALL
SELECT logged_at, 'bp_trusted', count(*), count(*), 'COMPLETED' FROM bplog GROUP BY logged_at
ORDER BY 1 DESC, 2 LIMIT {THROUGHPUT_ROWS}""",
        "dq_alerts": f"""WITH {LOG}
SELECT * FROM ({_summary('SELECT * FROM logged')})
WHERE pass_rate_pct < {ALERT_THRESHOLD} OR pass_rate_pct IS NULL""",
    }
