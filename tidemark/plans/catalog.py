"""Named queries over the test tables; each takes (spark, folder) and gives a DataFrame.

Results are put in a form that plain SQL can be compared with: times without a zone, dates and
maps as text, sums with fixed digits, and a fixed processing time. The operators keep real types.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, TimestampType

from tidemark.operators import (
    changes, contracts, dedup, envelope, events, layout, monitor, partners, publish, quality, rollup, shapes,
)
from tidemark.plans import flows, pipelines
from tidemark.schemas import (
    EVENT_PAYLOAD, EVENT_RULES, EVENT_RULES_CHANGE_TYPES, PARTNER_RULES, PARTNER_RULES_STRICT,
    avro_schema,
)
from tidemark.session import configure, run_dir
from tidemark.sources import feeds
from tidemark.sources.readers import read_table_stream, replay
from tidemark.streaming import aggregates, jobs, late, latest, rollup as deltas, versions
from tidemark.streaming.dedup import dedup_stream, with_watermark
from tidemark.streaming.quality import measure_stream

Query = Callable[[SparkSession, str], DataFrame]

NOW = "2024-02-01 00:00:00"
LOG_AS_OF = "2024-01-31 00:00:00"
EVENT_SPLIT = "2024-01-25 00:00:00"
PARTNER_SPLIT = "1999-01-01 00:00:00"
RATES = {"USD": 1.0, "EUR": 1.09, "BRL": 0.2}
REPLAY = [(0, None, 9999), (1, 4000, 15000), (2, 10000, None), (3, None, None)]

REPLAY_TO = "2024-01-15"

METRIC_KEYS = ("window_start", "event_type", "source_system", "entity_type")
SOURCE_KEYS = ("sap_client", "bp_number", "source_table")
ENTITY_COLUMNS = (
    "sap_client", "bp_number", "bp_category", "first_name", "last_name", "is_active",
    "created_date_parsed", "changed_date_parsed", "trusted_processed_at", "customer_name",
    "customer_country", "customer_region", "vendor_name", "vendor_tax_id", "unified_name",
    "gold_processed_at",
)


# --- shared inputs --------------------------------------------------------------------------

def _events_raw(spark, sf_dir):
    return envelope.event_envelope(feeds.event_feed(spark, sf_dir), NOW)


def _events_parsed(spark, sf_dir):
    return flows.parsed_events(_events_raw(spark, sf_dir))


def _events_trusted(spark, sf_dir):
    return flows.trusted_events(_events_raw(spark, sf_dir), NOW)


def _partners_raw(spark, sf_dir):
    return envelope.bp_envelope(feeds.partner_feed(spark, sf_dir), NOW)


def _deliver_events(spark, sf_dir, out, step):
    """The event feed part by part; `step` gets all raw rows so far as a stream."""
    feeds.deliver(
        feeds.event_feed_parts(spark, sf_dir), f"{out}/inbox",
        lambda messages: step(envelope.event_envelope(messages, NOW)),
    )


def _deliver_partners(spark, sf_dir, out, step):
    feeds.deliver(
        feeds.partner_feed_parts(spark, sf_dir), f"{out}/inbox",
        lambda messages: step(envelope.bp_envelope(messages, NOW)),
    )


def _partners_parsed(spark, sf_dir):
    return flows.parsed_partners(_partners_raw(spark, sf_dir))


def _partners_trusted(spark, sf_dir):
    return flows.bp_trusted(_partners_raw(spark, sf_dir), NOW)


def _log(spark, sf_dir):
    return feeds.quality_log(_events_parsed(spark, sf_dir), _partners_parsed(spark, sf_dir))


def _table_name(folder: str) -> str:
    """A name in the catalog for a table of one run."""
    return folder.rsplit("/", 1)[-1].replace("-", "_")


# --- result forms ---------------------------------------------------------------------------

def _plain(df: DataFrame) -> DataFrame:
    """Times without a zone, dates as text."""
    casts = {}
    for field in df.schema:
        if isinstance(field.dataType, TimestampType):
            casts[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif isinstance(field.dataType, DateType):
            casts[field.name] = F.col(field.name).cast("string")
    return df.withColumns(casts)


def _flat(df: DataFrame) -> DataFrame:
    """Maps as JSON text too."""
    if "properties" in df.columns:
        df = df.withColumn("properties", F.to_json("properties"))
    return _plain(df)


def _payload(df: DataFrame) -> DataFrame:
    """Payload columns only: which copy of an event a stream keeps depends on arrival."""
    position = ("kafka_offset", "kafka_partition", "kafka_timestamp", "ingested_at",
                "offset", "partition")
    return _flat(df.drop(*position))


def _rounded(df: DataFrame) -> DataFrame:
    digits = {"total_amount_usd": 4, "daily_amount_usd": 4, "avg_amount_usd": 6}
    present = {c: F.round(c, n) for c, n in digits.items() if c in df.columns}
    return _plain(df.withColumns(present))


# --- raw layer ------------------------------------------------------------------------------

def raw_events_stream(spark, sf_dir):
    out = run_dir(spark, "raw_events")
    _deliver_events(spark, sf_dir, out, lambda raw: jobs.run_stream(
        raw, f"{out}/table", f"{out}/checkpoint"))
    return _plain(spark.read.parquet(f"{out}/table"))


def raw_replay(spark, sf_dir):
    return _plain(replay(_events_raw(spark, sf_dir), REPLAY))


def raw_replay_table(spark, sf_dir):
    """The same ranges as a table, on a raw layer in folders by day; only the first days are read."""
    layers = pipelines.Layers(run_dir(spark, "raw_replay"))
    feeds.deliver(
        feeds.event_feed_parts(spark, sf_dir), f"{layers.root}/inbox",
        lambda messages: pipelines.ingest_events(messages, layers),
    )
    ranges = spark.createDataFrame(REPLAY, "p int, a bigint, b bigint")
    raw = replay(spark.read.parquet(layers.raw), ranges, days=(None, REPLAY_TO), block=4096)
    return _plain(raw.drop("ingest_date").withColumn("ingested_at", F.lit(NOW).cast("timestamp")))


def raw_replay_clustered(spark, sf_dir):
    """The same ranges on a raw layer in files by partition and offset, of which few are opened."""
    path = f"{run_dir(spark, 'raw_clustered')}/raw"
    layout.write_clustered(_events_raw(spark, sf_dir), path, dedup.POSITION, files=64)
    ranges = spark.createDataFrame(REPLAY, "p int, a bigint, b bigint")
    return _plain(replay(layout.read_clustered(spark, path, layout.replay_ranges(ranges)), ranges, block=4096))


def raw_parse_flat(spark, sf_dir):
    return _flat(envelope.parse_messages(feeds.event_feed(spark, sf_dir), EVENT_PAYLOAD))


def raw_payload_paths(spark, sf_dir):
    """Paths and kinds of values in the payloads as they came, unreadable ones included."""
    raw = _events_raw(spark, sf_dir)
    return shapes.paths(raw, "raw_payload", ["kafka_partition"])


def events_parsed(spark, sf_dir):
    return _flat(_events_parsed(spark, sf_dir))


def bp_raw_envelope(spark, sf_dir):
    return _plain(_partners_raw(spark, sf_dir))


def bp_parsed(spark, sf_dir):
    return _plain(_partners_parsed(spark, sf_dir))


# --- trusted events -------------------------------------------------------------------------

def events_dedup(spark, sf_dir):
    return _flat(dedup.dedup_events(_events_parsed(spark, sf_dir)))


def trusted_events(spark, sf_dir):
    return _flat(_events_trusted(spark, sf_dir))


def trusted_events_basic(spark, sf_dir):
    parsed = envelope.parse_messages(feeds.event_feed(spark, sf_dir), EVENT_PAYLOAD)
    return _flat(flows.trusted_events_basic(parsed, NOW))


def amount_fx(spark, sf_dir):
    trusted = flows.trusted_events(_events_raw(spark, sf_dir), NOW, rates=RATES)
    columns = ["event_id", "currency", "amount", F.round("amount_usd", 6).alias("amount_usd")]
    return trusted.select(*columns)


def amount_fx_table(spark, sf_dir):
    """Rates as a table: a rate per currency out of the purchases themselves.

    The rates are written first, so that the join is planned on the table's true size.
    """
    parsed = _events_parsed(spark, sf_dir)
    rates = parsed.where("amount > 0 AND currency IS NOT NULL").groupBy("currency").agg(
        F.round(F.avg("amount") / 100, 2).alias("rate")
    )
    # Every currency has an older rate too, which must not count an event twice.
    rates = rates.withColumn("day", F.lit("2024-01-31"))
    older = rates.select("currency", F.col("rate") * 2, F.lit("2024-01-30").alias("day"))
    path = run_dir(spark, "rates")
    rates.unionByName(older.toDF("currency", "rate", "day")).write.parquet(path)
    fx = events.convert_amount(
        dedup.dedup_events(parsed), spark.read.parquet(path), order=["day"]
    )
    return fx.select("event_id", "currency", "amount", F.round("amount_usd", 6).alias("amount_usd"))


def _trusted_table(spark, sf_dir):
    """The trusted layer as a stream writes it; gives the folder of the run."""
    out = run_dir(spark, "trusted_events")
    _deliver_events(spark, sf_dir, out, lambda raw: jobs.run_stream(
        flows.trusted_events(raw, NOW), f"{out}/table", f"{out}/checkpoint"))
    return out


def events_dedup_stream(spark, sf_dir):
    out = run_dir(spark, "events_dedup")
    _deliver_events(spark, sf_dir, out, lambda raw: jobs.run_stream(
        dedup_stream(with_watermark(flows.parsed_events(raw))), f"{out}/table", f"{out}/checkpoint"))
    return _payload(spark.read.parquet(f"{out}/table"))


def events_dedup_unbounded_stream(spark, sf_dir):
    out = run_dir(spark, "events_dedup_unbounded")

    def step(messages):
        parsed = envelope.parse_messages(messages, EVENT_PAYLOAD)
        basic = flows.trusted_events_basic(parsed, NOW)
        jobs.run_stream(basic, f"{out}/table", f"{out}/checkpoint")

    feeds.deliver(feeds.event_feed_parts(spark, sf_dir), f"{out}/inbox", step)
    return _payload(spark.read.parquet(f"{out}/table"))


def trusted_events_stream(spark, sf_dir):
    out = _trusted_table(spark, sf_dir)
    return _payload(spark.read.parquet(f"{out}/table"))


# --- event aggregates -----------------------------------------------------------------------

def hourly_event_metrics(spark, sf_dir):
    trusted = _events_trusted(spark, sf_dir)
    return _rounded(events.hourly_metrics(trusted, now=NOW, unique_ids=True))


def hourly_event_metrics_general(spark, sf_dir):
    """On rows that still hold copies, so that ids must be counted distinct."""
    derived = events.add_event_columns(_events_parsed(spark, sf_dir), NOW)
    return _rounded(events.hourly_metrics(derived, now=NOW))


def sliding_event_metrics(spark, sf_dir):
    trusted = _events_trusted(spark, sf_dir)
    return _rounded(events.hourly_metrics(
        trusted, "1 hour", slide="15 minutes", now=NOW, unique_ids=True
    ))


def sliding_event_metrics_general(spark, sf_dir):
    derived = events.add_event_columns(_events_parsed(spark, sf_dir), NOW)
    return _rounded(events.hourly_metrics(derived, "1 hour", slide="15 minutes", now=NOW))


def sliding_event_metrics_window(spark, sf_dir):
    """Windows that are no multiple of their slide."""
    trusted = _events_trusted(spark, sf_dir)
    return _rounded(events.hourly_metrics(trusted, "50 minutes", slide="15 minutes", now=NOW))


def _estimates_near(estimated, exact, keys):
    """Estimated distinct counts as whether they lie within a tenth of the exact ones."""
    names = ("unique_events", "unique_entities", "unique_sessions")
    truth = exact.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(n).alias(f"_{n}") for n in names])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    near = {n: F.abs(F.col(n) - F.col(f"_{n}")) <= 0.1 * F.col(f"_{n}") + 1 for n in names}
    joined = estimated.join(truth, same).withColumns(near)
    return joined.select(*estimated.columns)


def hourly_event_metrics_approx(spark, sf_dir):
    trusted = _events_trusted(spark, sf_dir)
    estimated = events.hourly_metrics(trusted, now=NOW, approx=True)
    exact = events.hourly_metrics(trusted, now=NOW, unique_ids=True)
    return _rounded(_estimates_near(estimated, exact, METRIC_KEYS))


def event_gold_refresh(spark, sf_dir):
    """The hourly gold table as the pipeline leaves it after three runs."""
    layers = pipelines.Layers(run_dir(spark, "event_gold"))

    def step(messages):
        pipelines.ingest_events(messages, layers)
        pipelines.trust_events(spark, layers, now=NOW)
        pipelines.refresh_event_gold(spark, layers, now=NOW)

    feeds.deliver(feeds.event_feed_parts(spark, sf_dir), f"{layers.root}/inbox", step)
    return _rounded(spark.read.parquet(layers.gold("event_metrics")))


def hourly_metrics_basic(spark, sf_dir):
    parsed = envelope.parse_messages(feeds.event_feed(spark, sf_dir), EVENT_PAYLOAD)
    metrics = events.hourly_metrics_basic(flows.trusted_events_basic(parsed, NOW))
    return _plain(metrics.withColumn("hour_start", F.col("window.start")).drop("window"))


def type_source_metrics(spark, sf_dir):
    return _rounded(events.type_source_metrics(_events_trusted(spark, sf_dir)))


def entity_daily_summary(spark, sf_dir):
    daily = events.entity_daily(_events_trusted(spark, sf_dir), NOW)
    types = F.array_join("event_types_seen", ",")
    return _rounded(daily.withColumn("event_types_seen", types))


def _counts_stream(spark, sf_dir, slide=None):
    """Metrics of the trusted table while it grows: each run goes on from the state of the one
    before, and writes the windows that changed."""
    out = run_dir(spark, "counts")

    def step(raw):
        trusted = flows.trusted_events(raw, NOW)
        jobs.run_stream(trusted, f"{out}/table", f"{out}/checkpoint")
        rows = with_watermark(read_table_stream(spark, f"{out}/table"))
        metrics = aggregates.hourly_metrics_stream(rows, slide=slide)
        jobs.run_stream(metrics, f"{out}/metrics", f"{out}/metrics_checkpoint", mode="update")

    _deliver_events(spark, sf_dir, out, step)
    newest = jobs.read_updates(spark, f"{out}/metrics", METRIC_KEYS)
    exact = events.hourly_metrics(spark.read.parquet(f"{out}/table"), slide=slide)
    return _rounded(_estimates_near(newest, exact, METRIC_KEYS))


def hourly_counts_stream(spark, sf_dir):
    return _counts_stream(spark, sf_dir)


def sliding_counts_stream(spark, sf_dir):
    return _counts_stream(spark, sf_dir, slide="15 minutes")


# --- gold by deltas -------------------------------------------------------------------------

def _kept_states(spark, sf_dir, exact=False, fold=True):
    """The folder of states that three deliveries leave, each of which reads its own trusted rows alone."""
    out = run_dir(spark, "states")

    def step(raw):
        jobs.run_stream(flows.trusted_events(raw, NOW), f"{out}/table", f"{out}/checkpoint")
        rows = read_table_stream(spark, f"{out}/table")
        deltas.keep_states(rows, f"{out}/states", f"{out}/states_checkpoint", exact=exact)
        for kind in (deltas.PANES, deltas.ENTITIES) if fold else ():
            deltas.fold_states(spark, f"{out}/states", kind, keep=1)

    _deliver_events(spark, sf_dir, out, step)
    return out


def _near(estimated, exact):
    return _rounded(_estimates_near(estimated, exact, METRIC_KEYS))


def hourly_gold_deltas(spark, sf_dir):
    out = _kept_states(spark, sf_dir)
    states = deltas.read_states(spark, f"{out}/states", deltas.PANES)
    return _near(rollup.metrics(states, now=NOW), events.hourly_metrics(spark.read.parquet(f"{out}/table")))


def sliding_gold_deltas(spark, sf_dir):
    """Sliding windows out of the same states, not folded."""
    out = _kept_states(spark, sf_dir, fold=False)
    states = deltas.read_states(spark, f"{out}/states", deltas.PANES)
    exact = events.hourly_metrics(spark.read.parquet(f"{out}/table"), slide="15 minutes")
    return _near(rollup.metrics(states, slide=900, now=NOW), exact)


def entity_gold_deltas(spark, sf_dir):
    out = _kept_states(spark, sf_dir)
    daily = rollup.entity_daily(deltas.read_states(spark, f"{out}/states", deltas.ENTITIES), NOW)
    return _rounded(daily.withColumn("event_types_seen", F.array_join("event_types_seen", ",")))


def metrics_by_grain(spark, sf_dir):
    """Hours, sliding windows and days out of one table of states, which is made in one scan of the events."""
    out = run_dir(spark, "grains")
    _events_trusted(spark, sf_dir).write.parquet(f"{out}/trusted")
    trusted = spark.read.parquet(f"{out}/trusted")
    rollup.pane_states(trusted).write.parquet(f"{out}/panes")
    states = spark.read.parquet(f"{out}/panes")
    grains = {"day": (86400, 86400), "hour": (3600, 3600), "sliding": (3600, 900)}
    found = []
    for name, (seconds, slide) in grains.items():
        exact = events.hourly_metrics(trusted, f"{seconds} seconds", f"{slide} seconds", unique_ids=True)
        found.append(_near(rollup.metrics(states, seconds, slide, NOW), exact).withColumn("grain", F.lit(name)))
    return found[0].unionByName(found[1]).unionByName(found[2]).drop("avg_amount_usd")


def exact_distinct_rollup(spark, sf_dir):
    """Exact distinct counts of hours and days out of the same bitmaps."""
    out = _kept_states(spark, sf_dir, exact=True, fold=False)
    hours = deltas.exact_counts(spark, f"{out}/states").withColumn("grain", F.lit("hour"))
    days = deltas.exact_counts(spark, f"{out}/states", 86400).withColumn("grain", F.lit("day"))
    return _plain(hours.unionByName(days))


# --- late rows ------------------------------------------------------------------------------

LATE_AFTER = "1 DAY"


def _split_late(spark, sf_dir):
    """Three deliveries split into rows in time and late ones, and gold refreshed after each."""
    out = run_dir(spark, "late")

    def step(raw):
        late.keep_late(raw, f"{out}/events", f"{out}/checkpoint", LATE_AFTER, transform=lambda batch: (
            events.add_event_columns(flows.parsed_events(batch), NOW)))
        late.refresh_windows(spark, f"{out}/events", f"{out}/gold", lambda rows: events.hourly_metrics(rows, now=NOW))

    _deliver_events(spark, sf_dir, out, step)
    return out


def late_rows_kept(spark, sf_dir):
    out = _split_late(spark, sf_dir)
    sides = [spark.read.parquet(f"{out}/events/{side}").withColumn("is_late", F.lit(side == "late")) for side in ("kept", "late")]
    return sides[0].unionByName(sides[1]).select("kafka_offset", "event_id", F.col("event_timestamp").cast("timestamp_ntz"), "is_late")


def late_windows_repaired(spark, sf_dir):
    gold = f"{_split_late(spark, sf_dir)}/gold"
    return _rounded(versions.read(spark, gold, versions.version(spark, gold)).drop("bucket"))


# --- business partners ----------------------------------------------------------------------

def bp_latest(spark, sf_dir):
    parsed = _partners_parsed(spark, sf_dir)
    return _plain(dedup.latest_by(parsed, dedup.PARTNER_KEYS, dedup.PARTNER_ORDER))


def bp_latest_agg(spark, sf_dir):
    parsed = _partners_parsed(spark, sf_dir)
    return _plain(dedup.latest_by(parsed, dedup.PARTNER_KEYS, dedup.PARTNER_ORDER, how="agg"))


def bp_latest_string_offset(spark, sf_dir):
    text = _partners_parsed(spark, sf_dir).withColumn(
        "kafka_offset", F.col("kafka_offset").cast("string")
    )
    order = [F.col("kafka_offset").try_cast("bigint"), *dedup.PARTNER_ORDER[1:]]
    return _plain(dedup.latest_by(text, dedup.PARTNER_KEYS, order))


def bp_trusted(spark, sf_dir):
    return _plain(_partners_trusted(spark, sf_dir))


def bp_latest_stream(spark, sf_dir):
    out = run_dir(spark, "bp_latest")
    keys, order = flows.TRUSTED_KEYS, dedup.PARTNER_ORDER
    _deliver_partners(spark, sf_dir, out, lambda raw: latest.latest_stream(
        flows.parsed_partners(raw), keys, order, f"{out}/table", f"{out}/checkpoint",
        prepare=lambda rows: partners.add_bp_columns(rows, NOW),
    ))
    return _plain(latest.read_latest(spark, f"{out}/table", keys, order))


def bp_latest_folded(spark, sf_dir):
    """The same table, folded after every part from the fold before."""
    out, folds = run_dir(spark, "bp_folded"), []
    keys, order = flows.TRUSTED_KEYS, dedup.PARTNER_ORDER

    def step(raw):
        latest.latest_stream(
            flows.parsed_partners(raw), keys, order, f"{out}/table", f"{out}/checkpoint",
            prepare=lambda rows: partners.add_bp_columns(rows, NOW),
        )
        folds.append(f"{out}/fold-{len(folds)}")
        latest.fold(spark, f"{out}/table", folds[-1], keys, order, folds[-2] if folds[1:] else None, running=False)

    _deliver_partners(spark, sf_dir, out, step)
    return _plain(spark.read.parquet(folds[-1]).drop("folded_to"))


def bp_unified(spark, sf_dir):
    """By joins: each source is a branch of its own over the trusted table, which is written once."""
    path = f"{run_dir(spark, 'bp_unified')}/trusted"
    _partners_trusted(spark, sf_dir).write.parquet(path)
    unified = partners.unify(spark.read.parquet(path), NOW, how="join")
    return _plain(unified.select(*ENTITY_COLUMNS))


def bp_unified_pivot(spark, sf_dir):
    unified = partners.unify(_partners_trusted(spark, sf_dir), NOW, how="pivot")
    return _plain(unified.select(*ENTITY_COLUMNS))


def bp_unified_active(spark, sf_dir):
    trusted = _partners_trusted(spark, sf_dir)
    unified = partners.unify(trusted, NOW, drop_deleted=True)
    return _plain(unified.select(*ENTITY_COLUMNS))


def bp_gold_incremental(spark, sf_dir):
    """The entities as the pipeline keeps them: three runs, each of which rewrites what it touches."""
    layers = pipelines.Layers(run_dir(spark, "bp_gold"))

    def step(messages):
        pipelines.ingest_partners(messages, layers)
        pipelines.trust_partners(spark, layers, now=NOW)
        pipelines.refresh_partners(spark, layers, NOW, buckets=16)

    feeds.deliver(feeds.partner_feed_parts(spark, sf_dir), f"{layers.root}/inbox", step)
    return _plain(pipelines.read_partners(spark, layers).select(*ENTITY_COLUMNS))


def bp_unified_buckets(spark, sf_dir):
    """The entities out of a trusted table in buckets of the partner, whose branches join as they lie."""
    out = run_dir(spark, "bp_buckets")
    table = _table_name(out)
    layout.write_buckets(
        _partners_trusted(spark, sf_dir), table, f"{out}/trusted", partners.PARTNER, dedup.PARTNER_ORDER, 16, ["source_table"]
    )
    return _plain(layout.unify_buckets(spark, table, NOW).select(*ENTITY_COLUMNS))


def bp_entity_json(spark, sf_dir):
    unified = partners.unify(_partners_trusted(spark, sf_dir), NOW)
    return partners.entity_json(unified).select("sap_client", "bp_number", "entity_json")


def publish_messages(spark, sf_dir):
    unified = partners.unify(_partners_trusted(spark, sf_dir), NOW)
    return publish.to_messages(publish.publishable(unified))


def _renamed(contract: str) -> str:
    """The contract's next version: a name changed, one field less, an optional and a defaulted one more."""
    record = json.loads(contract)
    fields = {f["name"]: f for f in record["fields"]}
    del fields["vendor_tax_id"]
    fields["unified_name"] |= {"name": "display_name", "aliases": ["unified_name"]}
    added = [{"name": "risk_class", "type": ["null", "int"], "default": None}, {"name": "origin", "type": "string", "default": "sap"}]
    return json.dumps(record | {"fields": [*fields.values(), *added]})


def publish_contract_versions(spark, sf_dir):
    """Messages of one feed, half of them of the contract's next version, as a consumer of that one reads them."""
    first = contracts.read_contract(avro_schema())
    text = _renamed(avro_schema())
    second = contracts.read_contract(text)
    entities = publish.publishable(partners.unify(_partners_trusted(spark, sf_dir), NOW))
    even = F.col("bp_number").cast("long") % 2 == 0
    old = publish.to_messages(entities.where(even)).withColumn("version", F.lit(1))
    newer = entities.where(~even).withColumnRenamed("unified_name", "display_name").withColumns({
        "risk_class": F.col("bp_category").cast("int"), "origin": F.lit("crm")})
    new = publish.to_messages(newer, second.fields).withColumn("version", F.lit(2))
    feed = run_dir(spark, "contract_versions")
    old.unionByName(new).write.parquet(feed)
    return _plain(contracts.read_messages(spark.read.parquet(feed), {1: first, 2: second}, second))


def publish_breaches(spark, sf_dir):
    """The records that can't be published, and why."""
    broken = publish.breaches(partners.unify(_partners_trusted(spark, sf_dir), NOW))
    return broken.select("sap_client", "bp_number", F.array_join("missing_fields", ",").alias("missing_fields"))


def publish_changed_messages(spark, sf_dir):
    raw = _partners_raw(spark, sf_dir)
    before = raw.where(F.col("kafka_ingest_timestamp") < F.lit(PARTNER_SPLIT).cast("timestamp"))
    old = partners.unify(flows.bp_trusted(before, NOW), NOW, drop_deleted=True)
    new = partners.unify(flows.bp_trusted(raw, NOW), NOW, drop_deleted=True)
    watched = ("unified_name", "is_active", "created_date_parsed", "changed_date_parsed")
    return publish.changed_messages(
        old, new, partners.PARTNER, watched, tombstones=True, strict=False
    )


# --- upserts and changes --------------------------------------------------------------------

def _event_sides(spark, sf_dir):
    """First deliveries up to a day as the target; copies and later events as updates."""
    parsed = _events_parsed(spark, sf_dir)
    first = (F.col("kafka_offset") % 4 == 0) & (
        F.col("kafka_timestamp") < F.lit(EVENT_SPLIT).cast("timestamp")
    )
    return parsed.where(first), parsed.where(~first)


def _partner_sides(spark, sf_dir):
    parsed = _partners_parsed(spark, sf_dir)
    early = F.col("kafka_ingest_timestamp") < F.lit(PARTNER_SPLIT).cast("timestamp")
    keys = dedup.whole_keys(SOURCE_KEYS, dedup.PARTNER_ORDER)
    stored = dedup.latest_by(parsed.where(early), keys, dedup.PARTNER_ORDER)
    return stored, parsed.where(~early)


def events_upsert(spark, sf_dir):
    target, updates = _event_sides(spark, sf_dir)
    return _flat(changes.upsert(target, updates, ["event_id"], dedup.EVENT_ORDER))


def bp_upsert(spark, sf_dir):
    target, updates = _partner_sides(spark, sf_dir)
    return _plain(changes.upsert(target, updates, SOURCE_KEYS, dedup.PARTNER_ORDER))


def bp_upsert_touched(spark, sf_dir):
    out = run_dir(spark, "bp_upsert")
    stored, updates = _partner_sides(spark, sf_dir)
    stored.write.parquet(f"{out}/target")
    target = spark.read.parquet(f"{out}/target")
    return _plain(changes.upsert_touched(
        target, updates, SOURCE_KEYS, dedup.PARTNER_ORDER, f"{out}/newest"
    ))


def bp_upsert_buckets(spark, sf_dir):
    """The same on a table in buckets of the partner, which the updates are dealt to."""
    out = run_dir(spark, "bp_upsert_buckets")
    stored, updates = _partner_sides(spark, sf_dir)
    table, order = _table_name(out), dedup.PARTNER_ORDER
    layout.write_buckets(stored, table, f"{out}/target", partners.PARTNER, order, 16, SOURCE_KEYS[2:])
    return _plain(layout.upsert_buckets(spark, table, updates, partners.PARTNER, SOURCE_KEYS, order, 16))


def bp_upsert_clustered(spark, sf_dir):
    """The same on a table in files by partner, of which those without an update stay as they are."""
    out = run_dir(spark, "bp_upsert_clustered")
    stored, updates = _partner_sides(spark, sf_dir)
    layout.write_clustered(stored, f"{out}/target", ["bp_number"], 64, SOURCE_KEYS)
    merged, others = layout.upsert_clustered(
        spark, f"{out}/target", updates, ["bp_number"], SOURCE_KEYS, dedup.PARTNER_ORDER
    )
    return _plain(merged.unionByName(others))


def events_upsert_stream(spark, sf_dir):
    out = run_dir(spark, "events_upsert")
    target, _ = _event_sides(spark, sf_dir)
    latest.seed(target, f"{out}/table")
    keys = ["event_id"]
    _deliver_events(spark, sf_dir, out, lambda raw: latest.upsert_stream(
        flows.parsed_events(raw), keys, dedup.EVENT_ORDER, f"{out}/checkpoint", f"{out}/table"))
    return _flat(latest.read_latest(spark, f"{out}/table", keys, dedup.EVENT_ORDER))


def bp_change_feed(spark, sf_dir):
    """Newest rows per partner and source, without deleted ones, at a date and at the end."""
    parsed = _partners_parsed(spark, sf_dir)
    early = F.col("kafka_ingest_timestamp") < F.lit(PARTNER_SPLIT).cast("timestamp")

    def snapshot(rows):
        newest = dedup.latest_by(rows, SOURCE_KEYS, dedup.PARTNER_ORDER)
        return newest.where("event_type <> 'DELETE'").select(
            *SOURCE_KEYS, "event_type", "full_name", "changed_date", "is_active"
        )

    return changes.change_feed(snapshot(parsed.where(early)), snapshot(parsed), SOURCE_KEYS)


def bp_changes_versions(spark, sf_dir):
    """What changed in the trusted partners after the first of three deliveries, out of the change rows that
    the merges of the later ones have written."""
    layers = pipelines.Layers(run_dir(spark, "bp_changes"))
    newest, seen = pipelines.trusted_newest(layers), []

    def step(messages):
        pipelines.ingest_partners(messages, layers)
        pipelines.trust_partners(spark, layers, now=NOW)
        pipelines.refresh_partners(spark, layers, NOW, buckets=16)
        seen.append(versions.version(spark, newest).number)

    feeds.deliver(feeds.partner_feed_parts(spark, sf_dir), f"{layers.root}/inbox", step)
    fed = versions.changes_between(spark, newest, flows.TRUSTED_KEYS, seen[0], place=dedup.LIVING_ORDER)
    return fed.select("change_type", *flows.TRUSTED_KEYS, "kafka_partition", "kafka_offset", "full_name", "changed_date")


# --- data quality ---------------------------------------------------------------------------

def dq_bp_counts(spark, sf_dir):
    return quality.measure(_partners_parsed(spark, sf_dir), PARTNER_RULES)


def dq_bp_counts_strict(spark, sf_dir):
    return quality.measure(_partners_parsed(spark, sf_dir), PARTNER_RULES_STRICT)


def dq_bp_trusted_counts(spark, sf_dir):
    return quality.measure(_partners_trusted(spark, sf_dir), PARTNER_RULES)


def dq_event_counts(spark, sf_dir):
    return quality.measure(_events_parsed(spark, sf_dir), EVENT_RULES)


def dq_event_counts_change_types(spark, sf_dir):
    return quality.measure(_events_parsed(spark, sf_dir), EVENT_RULES_CHANGE_TYPES)


def dq_event_trusted_counts(spark, sf_dir):
    return quality.measure(_events_trusted(spark, sf_dir), EVENT_RULES)


def dq_event_daily_counts(spark, sf_dir):
    trusted = _events_trusted(spark, sf_dir)
    return _plain(quality.measure(trusted, EVENT_RULES, by=["event_date", "source_system"]))


def dq_tagged_rows(spark, sf_dir):
    tagged = quality.tag(_partners_parsed(spark, sf_dir), PARTNER_RULES)
    rules = F.array_join("failed_rules", ",").alias("failed_rules")
    return tagged.select("kafka_offset", "bp_number", "source_table", rules)


def dq_valid_country(spark, sf_dir):
    valid = quality.valid_rows(
        _partners_parsed(spark, sf_dir), PARTNER_RULES["country_code_length"]
    )
    return valid.select("kafka_offset", "bp_number", "country_code")


def dq_valid_category(spark, sf_dir):
    valid = quality.valid_rows(_partners_parsed(spark, sf_dir), PARTNER_RULES["bp_category_valid"])
    return valid.select("kafka_offset", "bp_number", "bp_category")


def dq_event_counts_stream(spark, sf_dir):
    """Rules measured while a stream is written, then reported from the log it left."""
    out = run_dir(spark, "dq_events")
    _deliver_events(spark, sf_dir, out, lambda raw: measure_stream(
        flows.parsed_events(raw), EVENT_RULES, "events_parsed",
        f"{out}/table", f"{out}/log", f"{out}/checkpoint",
    ))
    return monitor.dq_summary(spark.read.parquet(f"{out}/log"))


# --- monitoring -----------------------------------------------------------------------------

def dq_summary(spark, sf_dir):
    return monitor.dq_summary(_log(spark, sf_dir))


def dq_failure_trend(spark, sf_dir):
    return _plain(monitor.dq_failure_trend(_log(spark, sf_dir), LOG_AS_OF))


def flow_throughput(spark, sf_dir):
    return _plain(monitor.flow_throughput(_log(spark, sf_dir)))


def dq_alerts(spark, sf_dir):
    return monitor.alerts(monitor.dq_summary(_log(spark, sf_dir)))


QUERIES = (
    raw_events_stream, raw_replay, raw_replay_table, raw_parse_flat, raw_payload_paths, events_parsed, bp_raw_envelope, bp_parsed,
    events_dedup, trusted_events, trusted_events_basic, amount_fx, amount_fx_table,
    events_dedup_stream, events_dedup_unbounded_stream, trusted_events_stream,
    hourly_event_metrics, hourly_event_metrics_general, sliding_event_metrics,
    sliding_event_metrics_general, sliding_event_metrics_window, hourly_event_metrics_approx,
    event_gold_refresh, hourly_metrics_basic, type_source_metrics,
    entity_daily_summary, hourly_counts_stream, sliding_counts_stream, hourly_gold_deltas,
    sliding_gold_deltas, entity_gold_deltas, metrics_by_grain, exact_distinct_rollup, late_rows_kept,
    late_windows_repaired, bp_latest,
    bp_latest_agg, bp_latest_string_offset, bp_trusted, bp_latest_stream, bp_latest_folded, bp_gold_incremental, bp_unified,
    bp_unified_pivot, bp_unified_active, bp_entity_json, publish_messages,
    publish_contract_versions, publish_breaches, publish_changed_messages, events_upsert, events_upsert_stream, bp_upsert,
    bp_upsert_touched, bp_upsert_buckets, bp_upsert_clustered, bp_unified_buckets, raw_replay_clustered, bp_change_feed, bp_changes_versions, dq_bp_counts, dq_bp_counts_strict, dq_bp_trusted_counts,
    dq_event_counts, dq_event_counts_change_types, dq_event_trusted_counts,
    dq_event_daily_counts, dq_tagged_rows, dq_valid_country, dq_valid_category,
    dq_event_counts_stream, dq_summary, dq_failure_trend, flow_throughput, dq_alerts,
)


def queries() -> dict[str, Query]:
    def bound(query: Query) -> Query:
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    return {query.__name__: bound(query) for query in QUERIES}
