"""The two pipelines end to end, from a stream of messages to gold tables and published entities.

Every step is a plain Spark job over tables below one root folder, and can be run again: streams
go on from their checkpoints, gold tables are overwritten.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import Moment
from tidemark.operators import dedup, envelope, events, partners, publish
from tidemark.plans import flows
from tidemark.schemas import EVENT_RAW, EVENT_RULES, PARTNER_RAW, PARTNER_RULES
from tidemark.session import folders
from tidemark.sources.readers import read_table_stream
from tidemark.streaming import jobs, latest, versions
from tidemark.streaming.quality import measure_stream

# A new time of processing alone is no reason to publish an entity again.
PUBLISHED_WHEN_CHANGED = (
    "bp_category", "unified_name", "customer_country", "customer_region", "vendor_tax_id",
    "is_active", "created_date_parsed", "changed_date_parsed",
)


BUCKETS = 64
INGEST_DAY = "ingest_date"


@dataclass(frozen=True)
class Layers:
    """The folders of one pipeline; with `names`, a prefix such as `lake.events_`, its tables are
    also named, commented and tagged in the catalog."""

    root: str
    names: str | None = None

    def name(self, spark: SparkSession, table: str, path: str, layer: str, comment: str) -> None:
        if self.names is not None and folders(spark, path):
            jobs.name_table(spark, f"{self.names}{table}", path, layer, comment)

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def trusted(self) -> str:
        return f"{self.root}/trusted"

    @property
    def log(self) -> str:
        return f"{self.root}/quality_log"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


# --- business partners: a triggered run -----------------------------------------------------

def ingest_partners(
    messages: DataFrame, layers: Layers, trigger: str = jobs.AVAILABLE_NOW
) -> StreamingQuery:
    """Raw rows as received, in folders by the month they came in, named by its first day."""
    raw = envelope.bp_envelope(messages)
    raw = raw.withColumn(INGEST_DAY, F.trunc("kafka_ingest_timestamp", "month"))
    query = jobs.run_stream(
        raw, layers.raw, layers.checkpoint("raw"), trigger=trigger, partition_by=[INGEST_DAY]
    )
    layers.name(messages.sparkSession, "raw", layers.raw, "raw", "partner messages as received")
    return query


def trust_partners(
    spark: SparkSession,
    layers: Layers,
    trigger: str = jobs.AVAILABLE_NOW,
    now: Moment = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """The newest rows of every micro-batch, and their expectation counts in the log.

    `options` such as `maxFilesPerTrigger` bound a micro-batch.
    """
    schema = f"{PARTNER_RAW}, {INGEST_DAY} DATE"
    raw = read_table_stream(spark, layers.raw, schema, **(options or {}))
    return measure_stream(
        flows.parsed_partners(raw), PARTNER_RULES, "bp_trusted", layers.trusted, layers.log,
        layers.checkpoint("trusted"), trigger,
        transform=lambda batch: flows.trusted_partners(batch, now, order=dedup.LIVING_ORDER),
    )


def unify_partners(
    spark: SparkSession,
    layers: Layers,
    version: str,
    previous: str | None = None,
    now: Moment = None,
    **options,
) -> DataFrame:
    """Build the entity of every partner, kept as one version of the gold table.

    The trusted rows are folded first; given the `previous` version only the changes since are
    read besides it.
    """
    trusted = latest.fold(
        spark, layers.trusted, folded_version(layers, version), flows.TRUSTED_KEYS,
        dedup.LIVING_ORDER, previous and folded_version(layers, previous),
    )
    gold = partners.entity_json(partners.unify(trusted, now, order=dedup.LIVING_ORDER, **options))
    jobs.write_layer(gold, partner_version(layers, version), "gold")
    return spark.read.parquet(partner_version(layers, version))


def refresh_partners(
    spark: SparkSession, layers: Layers, now: Moment = None, buckets: int = BUCKETS, **options
) -> list[int]:
    """Bring the newest trusted rows and the entities up to date, at the cost of what has changed.

    Both tables lie in hash buckets of the partner and have versions. Trusted rows since the last call are
    merged into the buckets they touch; only partners with changed rows are unified again, the others of
    those buckets are copied, and all other buckets stay as they are. The version of the entities notes which
    version of the trusted rows it shows, so a run that ended between the two is caught up with by the
    next one. Gives the buckets written.
    """
    newest, gold = trusted_newest(layers), current_partners(layers)
    latest.merge_batches(
        spark, layers.trusted, newest, flows.TRUSTED_KEYS, dedup.LIVING_ORDER, partners.PARTNER, buckets, keep=3
    )
    trusted, shown = versions.version(spark, newest), versions.version(spark, gold)
    if trusted is None or shown and shown.note["trusted"] == trusted.number:
        return []
    since = shown.note["trusted"] if shown else 0
    before = versions.version(spark, newest, since)
    touched = sorted(b for b in trusted.files if before is None or before.files.get(b) != trusted.files[b])
    stored = versions.read(spark, newest, trusted, touched).drop("bucket")
    changed = versions.read_changes(spark, newest, since, trusted.number)
    keys = changed.select(*[F.col(k).alias(f"_{k}") for k in partners.PARTNER]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in partners.PARTNER]
    unified = partners.unify(stored.join(keys, same, "left_semi"), now, order=dedup.LIVING_ORDER, **options)
    unified = partners.entity_json(unified).withColumn(
        "bucket", versions.bucket_of(partners.PARTNER, buckets)
    )
    others = versions.read(spark, gold, shown, touched, unified.schema).join(keys, same, "left_anti")
    at = versions.commit(others.unionByName(unified), gold, shown, buckets, touched, {"trusted": trusted.number})
    versions.vacuum(spark, gold)
    if layers.names is not None:
        versions.name_version(spark, f"{layers.names}business_partner", gold, at)
    return touched


def trusted_newest(layers: Layers) -> str:
    return f"{layers.root}/trusted_buckets"


def current_partners(layers: Layers) -> str:
    return layers.gold("business_partner_current")


def read_partners(spark: SparkSession, layers: Layers) -> DataFrame:
    """The entities as `refresh_partners` keeps them."""
    at = versions.version(spark, current_partners(layers))
    return versions.read(spark, current_partners(layers), at).drop("bucket")


def folded_version(layers: Layers, version: str) -> str:
    return f"{layers.root}/trusted_newest/{version}"


def partner_version(layers: Layers, version: str) -> str:
    return f"{layers.gold('business_partner')}/{version}"


def publish_partners(
    spark: SparkSession,
    layers: Layers,
    version: str,
    previous: str | None,
    fmt: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    serializer: str = "json",
    tombstones: bool = False,
    most_broken: float = 0.01,
) -> StreamingQuery:
    """Send the entities that are new or changed since the version published before, or all.

    The messages of a version are written to an outbox once, and a checkpointed stream sends what
    is in the outbox: after a failure, or when called again, it goes on where it was, so nothing is
    lost, and nothing sent twice by a sink that is exactly-once. Records that break the contract go
    to a side table with their reasons; a share of them above `most_broken` stops the job first.
    With `tombstones` entities that are gone are sent as a NULL value.
    """
    box = f"{outbox(layers)}/version={version}"
    if f"version={version}" not in folders(spark, f"{outbox(layers)}.done"):
        new = spark.read.parquet(partner_version(layers, version))
        broken = publish.breaches(new)
        share = F.count_if(F.size(publish.missing_fields()) > 0) / F.count(F.lit(1))
        found = new.agg(share).first()[0] or 0.0
        if found > most_broken:
            raise ValueError(f"{found:.1%} of version {version} break the contract")
        jobs.write_layer(broken, f"{layers.gold('business_partner_broken')}/{version}", "gold")
        if previous is None:
            messages = publish.to_messages(publish.publishable(new), serializer=serializer)
        else:
            old = spark.read.parquet(partner_version(layers, previous))
            messages = publish.changed_messages(
                old, new, partners.PARTNER, PUBLISHED_WHEN_CHANGED, serializer=serializer,
                tombstones=tombstones, strict=False,
            )
        messages.write.mode("overwrite").parquet(box)
        spark.range(1).write.mode("overwrite").parquet(f"{outbox(layers)}.done/version={version}")
    schema = spark.read.parquet(box).schema
    waiting = spark.readStream.schema(schema).parquet(f"{outbox(layers)}/version=*")
    query = publish.publish(
        waiting.select("key", "value"), fmt, options, layers.checkpoint("publish"), path
    )
    query.awaitTermination()
    return query


def outbox(layers: Layers) -> str:
    return f"{layers.root}/outbox"


# --- events: always on, or triggered --------------------------------------------------------

def ingest_events(
    messages: DataFrame, layers: Layers, trigger: str = jobs.AVAILABLE_NOW
) -> StreamingQuery:
    """Raw rows as received, in folders by the day they came in."""
    raw = envelope.event_envelope(messages).withColumn(INGEST_DAY, F.to_date("kafka_timestamp"))
    query = jobs.run_stream(
        raw, layers.raw, layers.checkpoint("raw"), trigger=trigger, partition_by=[INGEST_DAY]
    )
    layers.name(messages.sparkSession, "raw", layers.raw, "raw", "event messages as received")
    return query


def trust_events(
    spark: SparkSession,
    layers: Layers,
    trigger: str = jobs.AVAILABLE_NOW,
    now: Moment = None,
    rates=None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Events without copies, in folders per day, and their expectation counts in the log."""
    schema = f"{EVENT_RAW}, {INGEST_DAY} DATE"
    raw = read_table_stream(spark, layers.raw, schema, **(options or {}))
    query = measure_stream(
        flows.trusted_events(raw, now, rates), EVENT_RULES, "trusted_events", layers.trusted,
        layers.log, layers.checkpoint("trusted"), trigger, partition_by=["event_date"],
    )
    layers.name(spark, "trusted", layers.trusted, "trusted", "events without copies")
    return query


def refresh_event_gold(
    spark: SparkSession, layers: Layers, since: str | None = None, now: Moment = None
) -> None:
    """Recompute the hourly and daily tables, or with `since` only the days from that date on.

    Days are partitions of both sides, so a refresh of the latest days reads and replaces only
    those. Rows without a date, from unreadable messages, are one partition more and always read.
    A micro-batch that is being written meanwhile is picked up by the next refresh. Copies that came
    after the stream had forgotten their id are still among the rows, so ids are counted distinct.
    """
    trusted = spark.read.parquet(layers.trusted).drop("batch_id")
    if since is not None:
        day = F.col("event_date")
        trusted = trusted.where(day.isNull() | (day >= F.lit(since).cast("date")))
    tables = {
        "event_metrics": events.hourly_metrics(trusted, now=now),
        "entity_daily": events.entity_daily(trusted, now),
    }
    for name, table in tables.items():
        jobs.write_layer(
            table, layers.gold(name), "gold", partition_by=["event_date"],
            only_partitions=since is not None,
        )
        layers.name(spark, name, layers.gold(name), "gold", f"{name} by day")
