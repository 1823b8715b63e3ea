"""Both pipelines end to end, on files in place of a message broker."""

import glob
import json
import os
import re
from collections import Counter

import pytest
from pyspark.sql import Observation

from tidemark.operators import monitor
from tidemark.operators.quality import observed_counts
from tidemark.plans import flows, pipelines
from tidemark.schemas import EVENT_RAW, EVENT_RULES, PARTNER_RAW, PARTNER_RULES
from tidemark.sources.readers import read_stream, replay
from tidemark.streaming import jobs, versions
from tidemark.streaming.quality import measure_stream

MESSAGE = ("key string, value string, topic string, partition int, offset bigint, "
           "timestamp timestamp")


def message(offset, **payload):
    return {"key": payload.get("bp_number"), "value": json.dumps(payload), "topic": "t",
            "partition": 0, "offset": offset, "timestamp": "2024-01-01T10:00:00Z"}


def partner(offset, number, source="BUT000", event="UPDATE", **payload):
    return message(offset, sap_client="100", bp_number=number, source_table=source,
                   event_type=event, **payload)


def event(offset, event_id, day, hour=10, **payload):
    ts = f"2024-01-{day:02d}T{hour:02d}:00:00Z"
    return message(offset, event_id=event_id, event_type="BUY", event_timestamp=ts,
                   entity_id="u1", entity_type="USER", source_system="web", **payload)


def messages(spark, inbox):
    return read_stream(spark, "json", schema=MESSAGE, path=inbox.path)


MOMENTS = {"v1": "2024-02-01 00:00:00", "v2": "2024-02-02 00:00:00"}


def publish(spark, layers, version, previous, out, **options):
    """What a call sends, and what the same call sends when it is made again."""
    found = []
    for _ in range(2):
        before = len(spark.read.parquet(out).collect()) if os.path.exists(out) else 0
        pipelines.publish_partners(spark, layers, version, previous, "parquet", path=out, **options)
        found.append(len(spark.read.parquet(out).collect()) - before)
    assert found[1] == 0
    return found[0]


def run_partners(spark, inbox, layers, version, previous, out, **options):
    pipelines.ingest_partners(messages(spark, inbox), layers)
    pipelines.trust_partners(spark, layers)
    gold = pipelines.unify_partners(spark, layers, version, previous, MOMENTS[version], **options)
    pipelines.refresh_partners(spark, layers, MOMENTS[version], buckets=8, **options)
    columns = ["sap_client", "bp_number", "unified_name", "customer_country"]
    current = pipelines.read_partners(spark, layers).select(columns)
    assert current.exceptAll(gold.select(columns)).isEmpty() and current.count() == gold.count()
    return {r.bp_number: r.unified_name for r in gold.collect()}


def names(spark, out):
    rows = spark.read.parquet(out).collect()
    return Counter((r.key, r.value and json.loads(r.value).get("unified_name")) for r in rows)


def test_partner_pipeline(spark, inbox, folder):
    layers, out = pipelines.Layers(f"{folder}/bp"), f"{folder}/sent"
    inbox.put(partner(1, "1", first_name="Ann", last_name="Lee"), partner(2, "2"),
              partner(3, "2", "KNA1", full_name="Old Ltd"), partner(4, "3", country_code="USA"))
    gold = run_partners(spark, inbox, layers, "v1", None, out)
    assert gold == {"1": "Ann Lee", "2": "Old Ltd", "3": None}
    assert publish(spark, layers, "v1", None, out) == 3
    first = names(spark, out)
    assert dict(first) == {item: 1 for item in gold.items()}
    inbox.put(partner(7, "2", "KNA1", full_name="New Ltd"), partner(5, "2", "KNA1", full_name="Late"),
              partner(6, "1", first_name="Ann", last_name="Lee"), partner(8, "4"))
    gold = run_partners(spark, inbox, layers, "v2", "v1", out)
    assert gold == {"1": "Ann Lee", "2": "New Ltd", "3": None, "4": None}
    assert publish(spark, layers, "v2", "v1", out) == 2
    assert dict(names(spark, out) - first) == {("2", "New Ltd"): 1, ("4", None): 1}
    log = spark.read.parquet(layers.log)
    assert log.count() == 2
    failed = {r.expectation_name: r.failed_records for r in monitor.dq_summary(log).collect()}
    assert failed["country_code_length"] == 1 and failed["bp_number_not_null"] == 0


def test_broken_and_deleted_partners(spark, inbox, folder):
    layers, out = pipelines.Layers(f"{folder}/bp"), f"{folder}/sent"
    broken = message(3, bp_number="9", source_table="BUT000", event_type="UPDATE")
    unread = {**message(4), "value": "{no json"}, {**message(5), "value": None}
    inbox.put(partner(1, "1"), partner(2, "2"), broken, *unread)
    run_partners(spark, inbox, layers, "v1", None, out, drop_deleted=True)
    trusted = spark.read.parquet(layers.trusted)
    assert trusted.where("bp_number IS NULL").count() == 2
    with pytest.raises(ValueError, match="33.3%"):
        publish(spark, layers, "v1", None, out)
    assert publish(spark, layers, "v1", None, out, most_broken=0.5) == 2
    side = spark.read.parquet(f"{layers.gold('business_partner_broken')}/v1").collect()
    assert [(r.bp_number, r.missing_fields) for r in side] == [("9", ["sap_client"])]
    inbox.put(partner(6, "1", event="DELETE"))
    gold = run_partners(spark, inbox, layers, "v2", "v1", out, drop_deleted=True)
    assert set(gold) == {"2", "9"}
    assert publish(spark, layers, "v2", "v1", out, most_broken=0.5, tombstones=True) == 1
    assert spark.read.parquet(out).where("value IS NULL").first().key == "1"


def test_untouched_buckets_keep_their_files(spark, inbox, folder):
    layers = pipelines.Layers(f"{folder}/bp")

    def step(now):
        pipelines.ingest_partners(messages(spark, inbox), layers)
        pipelines.trust_partners(spark, layers)
        written = pipelines.refresh_partners(spark, layers, now, buckets=8)
        files = {}
        for table in ("trusted_buckets", "gold/business_partner_current"):
            for bucket, number in versions.version(spark, f"{layers.root}/{table}").files.items():
                for path in glob.glob(f"{layers.root}/{table}/data/version={number}/bucket={bucket}/*.parquet"):
                    files.setdefault(bucket, set()).add(path)
        return set(written), files

    inbox.put(*[partner(i, str(i)) for i in range(1, 40)])
    written, before = step("2024-02-01")
    assert written == set(before) and len(written) > 4
    inbox.put(partner(50, "7", "KNA1", full_name="Seven"))
    written, after = step("2024-02-02")
    # The newest batch is merged once more, as it might have been in the writing.
    inbox.put(partner(51, "7", "KNA1", full_name="Sieben"))
    written, last = step("2024-02-03")
    assert len(written) == 1
    kept = set(after) - written
    assert kept and all(after[b] == last[b] for b in kept)
    rows = {r.bp_number: r for r in pipelines.read_partners(spark, layers).collect()}
    assert len(rows) == 39 and rows["7"].unified_name == "Sieben"
    assert len(jobs.batch_ids(spark, layers.trusted)) <= 3
    assert pipelines.refresh_partners(spark, layers, buckets=8) == sorted(written)
    with pytest.raises(ValueError, match="8 buckets"):
        pipelines.refresh_partners(spark, layers)


def test_event_pipeline_refreshes_only_the_days_asked_for(spark, inbox, folder):
    layers = pipelines.Layers(f"{folder}/ev")
    def step():
        pipelines.ingest_events(messages(spark, inbox), layers)
        pipelines.trust_events(spark, layers)

    def totals():
        rows = spark.read.parquet(layers.gold("event_metrics")).collect()
        daily = spark.read.parquet(layers.gold("entity_daily")).collect()
        hourly = {}
        for r in rows:
            hourly[r.event_date.day] = hourly.get(r.event_date.day, 0) + r.event_count
        assert hourly == {r.event_date.day: r.total_events for r in daily}
        return hourly, {r.event_date.day: r.summary_created_at.day for r in daily}

    inbox.put(event(1, "a", 1, amount=1.0), event(2, "a", 1, amount=1.0), event(3, "b", 2, 1),
              event(4, "c", 2, 2, amount=-1.0))
    step()
    pipelines.refresh_event_gold(spark, layers, now="2024-02-01")
    assert totals() == ({1: 1, 2: 2}, {1: 1, 2: 1})
    inbox.put(event(5, "d", 2, 3), event(6, "e", 3))
    step()
    pipelines.refresh_event_gold(spark, layers, since="2024-01-02", now="2024-02-05")
    assert totals() == ({1: 1, 2: 3, 3: 1}, {1: 1, 2: 5, 3: 5})
    inbox.put(message(7, event_id="undated", event_type="BUY"))
    step()
    pipelines.refresh_event_gold(spark, layers, since="2024-01-03")
    undated = spark.read.parquet(layers.gold("entity_daily")).where("event_date IS NULL")
    assert [r.total_events for r in undated.collect()] == [1]
    query = jobs.refresh(
        spark, lambda: pipelines.trust_events(spark, layers),
        [layers.trusted, layers.log, layers.checkpoint("trusted")], mode="full",
    )
    assert jobs.stream_stats(query)["input_rows"] == 7
    failed = {r.expectation_name: (r.passed_records, r.failed_records) for r in
              monitor.dq_summary(spark.read.parquet(layers.log)).collect()}
    assert failed["amount_non_negative"] == (5, 1)
    assert failed["timestamp_not_null"] == (5, 1)


def test_copies_after_a_forgotten_id_count_once(spark, inbox, folder):
    layers = pipelines.Layers(f"{folder}/ev")

    def at(offset, event_id, minute):
        row = event(offset, event_id, 1)
        payload = json.loads(row["value"]) | {"event_timestamp": f"2024-01-01T10:{minute:02d}:00Z"}
        return row | {"value": json.dumps(payload)}

    for rows in ([at(1, "a", 1), at(2, "b", 2)], [at(3, "c", 30)], [at(4, "d", 31)], [at(5, "a", 32)]):
        inbox.put(*rows)
        pipelines.ingest_events(messages(spark, inbox), layers)
        pipelines.trust_events(spark, layers)
    assert spark.read.parquet(layers.trusted).where("event_id = 'a'").count() == 2
    pipelines.refresh_event_gold(spark, layers)
    row = spark.read.parquet(layers.gold("event_metrics")).first()
    assert (row.event_count, row.unique_events) == (5, 4)
    assert jobs.compact(spark, layers.trusted, keep=1, partition_by=["event_date"]) == 2
    assert spark.read.parquet(layers.trusted).count() == 5
    inbox.put(at(6, "e", 33))
    pipelines.ingest_events(messages(spark, inbox), layers)
    pipelines.trust_events(spark, layers)
    assert spark.read.parquet(layers.trusted).count() == 6


def test_named_layers_and_pruned_replay(spark, inbox, folder, plan):
    layers = pipelines.Layers(f"{folder}/ev", names="ev_")
    inbox.put(event(1, "a", 1), event(2, "b", 2) | {"timestamp": "2024-01-02T10:00:00Z"})
    pipelines.ingest_events(messages(spark, inbox), layers)
    pipelines.trust_events(spark, layers)
    pipelines.refresh_event_gold(spark, layers)
    for table, quality in (("raw", "bronze"), ("trusted", "silver"), ("event_metrics", "gold")):
        assert spark.sql(f"SHOW TBLPROPERTIES ev_{table}('quality')").first().value == quality
        assert spark.table(f"ev_{table}").count() == 2
    again = replay(spark.read.parquet(layers.raw), [(0, None, None)], days=("2024-01-02", None))
    assert [r.kafka_offset for r in again.collect()] == [2]
    assert re.search(r"PartitionFilters: \[[^]]*ingest_date", plan(again, "formatted"))


def test_few_files_for_each_batch_and_day(spark, folder):
    days = spark.range(4000).selectExpr(
        "id", "date'2024-01-01' + CAST(id % 20 AS INT) AS event_date").repartition(4)
    days.write.parquet(f"{folder}/in")
    rows = spark.readStream.schema(days.schema).parquet(f"{folder}/in")
    measure_stream(rows, {"id_not_null": "id IS NOT NULL"}, "flow", f"{folder}/out", f"{folder}/log",
                   f"{folder}/c", partition_by=["event_date"])
    assert len(glob.glob(f"{folder}/out/batch_id=0/event_date=*/*.parquet")) == 20


def test_always_on_streams(spark, inbox, folder):
    layers = pipelines.Layers(f"{folder}/on")
    inbox.put(event(1, "a", 1))
    raw = pipelines.ingest_events(messages(spark, inbox), layers, trigger="1 second")
    raw.processAllAvailable()
    trusted = pipelines.trust_events(spark, layers, trigger="1 second")
    try:
        inbox.put(event(2, "a", 1), event(3, "b", 1))
        raw.processAllAvailable()
        trusted.processAllAvailable()
        assert sorted(r.event_id for r in spark.read.parquet(layers.trusted).collect()) == ["a", "b"]
    finally:
        trusted.stop()
        raw.stop()


def test_flows_measure_while_they_are_written(spark, folder):
    rows = [json.loads(partner(i, n)["value"]) for i, n in enumerate(["1", "1", "2"])]
    raw = spark.createDataFrame(
        [(i, 0, None, "t", json.dumps(r), "k", None) for i, r in enumerate(rows)], PARTNER_RAW)
    seen = Observation()
    flows.bp_trusted(raw, observation=seen).write.parquet(f"{folder}/bp")
    assert ("bp_number_not_null", 2, 0) in observed_counts(seen, PARTNER_RULES)
    raw = spark.createDataFrame([(1, None, 0, "{broken", None)], EVENT_RAW)
    seen = Observation()
    flows.trusted_events(raw, observation=seen).write.parquet(f"{folder}/ev")
    assert ("event_id_not_null", 0, 1) in observed_counts(seen, EVENT_RULES)


def test_named_stream_tables(spark, inbox, folder):
    inbox.put(event(1, "a", 1))
    rows = messages(spark, inbox)
    jobs.write_layer_stream(rows, f"{folder}/t", "raw", "raw_messages", f"{folder}/c",
                            comment="as received")
    inbox.put(event(2, "b", 1))
    jobs.write_layer_stream(rows, f"{folder}/t", "raw", "raw_messages", f"{folder}/c")
    assert spark.table("raw_messages").count() == 2
    assert spark.sql("SHOW TBLPROPERTIES raw_messages('quality')").first().value == "bronze"
    from tidemark.sources.readers import read_table_stream
    copy = jobs.run_stream(read_table_stream(spark, table="raw_messages"), f"{folder}/copy",
                           f"{folder}/c2")
    assert jobs.stream_stats(copy)["input_rows"] == 2
