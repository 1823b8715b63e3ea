import json
from collections import Counter

import pytest

from tidemark.operators import monitor, partners
from tidemark.operators.envelope import event_envelope
from tidemark.operators.dedup import latest_by
from tidemark.plans import flows
from tidemark.schemas import EVENT_RULES
from tidemark.sources.readers import read_stream, read_table_stream
from tidemark.streaming import aggregates, jobs, latest
from tidemark.streaming.dedup import dedup_stream, with_watermark
from tidemark.streaming.quality import measure_stream

EVENT = ("event_id string, event_timestamp timestamp, kafka_partition int, kafka_offset bigint, "
         "kafka_timestamp timestamp, event_type string, source_system string, entity_type string, "
         "entity_id string, session_id string, amount_usd double")
CHANGE = "k string, o bigint, v string"


def event(event_id, minute, offset=0, partition=0, **values):
    ts = f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z"
    return {"event_id": event_id, "event_timestamp": ts, "kafka_partition": partition,
            "kafka_offset": offset, "kafka_timestamp": ts, "event_type": "VIEW",
            "source_system": "web", "entity_type": "USER"} | values


def one_file_each(spark, inbox, schema):
    options = {"maxFilesPerTrigger": "1"}
    return read_stream(spark, "json", options, schema, inbox.path)


def ids(spark, folder):
    return Counter(r.event_id for r in spark.read.parquet(f"{folder}/out").collect())


def run(df, folder, **options):
    return jobs.run_stream(df, f"{folder}/out", f"{folder}/checkpoint", **options)


@pytest.mark.parametrize("buckets", [1, 4])
def test_bounded_dedup_forgets_and_unbounded_does_not(spark, inbox, folder, buckets):
    inbox.put(event("a", 0, 1), event("a", 1, 2), event("b", 2, 3), event(None, 2, 4),
              event(None, 2, 5), event(None, 2, 4, partition=1))
    inbox.put(event("c", 60, 6))
    inbox.put(event("d", 90, 7))
    inbox.put(event("a", 91, 8), event("d", 92, 9))
    parsed = one_file_each(spark, inbox, EVENT)
    query = run(dedup_stream(with_watermark(parsed), buckets=buckets), f"{folder}/bounded")
    assert ids(spark, f"{folder}/bounded") == {"a": 2, "b": 1, "c": 1, "d": 1, None: 3}
    assert jobs.stream_stats(query)["state_rows_removed"] > 0
    query = run(dedup_stream(parsed, bounded=False, buckets=buckets), f"{folder}/unbounded")
    assert ids(spark, f"{folder}/unbounded") == {"a": 1, "b": 1, "c": 1, "d": 1, None: 3}
    assert jobs.stream_stats(query)["state_rows_removed"] == 0


def test_a_hot_id_is_spread_and_kept_once(spark, inbox, folder):
    rows = [event("hot" if i % 3 == 0 else f"e{i}", 0, i, i % 4) for i in range(600)]
    inbox.put(*rows[:400])
    inbox.put(*rows[400:])
    run(dedup_stream(with_watermark(one_file_each(spark, inbox, EVENT))), folder)
    found = ids(spark, folder)
    assert len(found) == 401 and set(found.values()) == {1}


def test_late_rows_pass_once_then_are_dropped_and_counted(spark, inbox, folder):
    inbox.put(event("a", 60))
    inbox.put(event("late1", 2))  # the watermark of the first batch applies from the next one
    inbox.put(event("late2", 2), event("in_time", 56))
    query = run(dedup_stream(with_watermark(one_file_each(spark, inbox, EVENT)), buckets=1), folder)
    stats = jobs.stream_stats(query)
    found = ids(spark, folder)
    assert found["a"] == found["in_time"] == 1 and found["late2"] == 0
    assert stats["late_rows_dropped"] == 3 - (len(found) - 1)


def test_restart_repeats_and_loses_nothing(spark, inbox, folder):
    inbox.put(event("a", 0, 1), event("b", 1, 2))
    stream = lambda: dedup_stream(with_watermark(one_file_each(spark, inbox, EVENT)))
    run(stream(), folder)
    run(stream(), folder)
    inbox.put(event("b", 2, 3), event("c", 3, 4))
    run(stream(), folder)
    assert ids(spark, folder) == {"a": 1, "b": 1, "c": 1}


def test_incremental_and_full_refresh(spark, inbox, folder):
    inbox.put(event("a", 0))

    def refreshed(mode="incremental"):
        query = jobs.refresh(
            spark, lambda: run(one_file_each(spark, inbox, EVENT), folder),
            [f"{folder}/out", f"{folder}/checkpoint"], mode,
        )
        return jobs.stream_stats(query)["input_rows"]

    assert (refreshed(), refreshed()) == (1, 0)
    inbox.put(event("b", 1))
    assert refreshed() == 1
    assert refreshed("full") == 2
    assert ids(spark, folder) == {"a": 1, "b": 1}
    with pytest.raises(ValueError):
        refreshed("some")


def test_interval_trigger_keeps_running(spark, inbox, folder):
    inbox.put(event("a", 0))
    query = run(one_file_each(spark, inbox, EVENT), folder, trigger="1 second")
    try:
        assert query.isActive
        query.processAllAvailable()
        inbox.put(event("b", 1))
        query.processAllAvailable()
        assert ids(spark, folder) == {"a": 1, "b": 1}
    finally:
        query.stop()


def metrics_inbox(inbox):
    inbox.put(event("a", 5, entity_id="u1", session_id="s1", amount_usd=2.0),
              event("b", 20, entity_id="u2"))
    inbox.put(event("c", 59, entity_id="u1"), event("d", 61, entity_id="u1", amount_usd=1.0))
    inbox.put(event("e", 130, entity_id="u3"))


def counts(df):
    return {(str(r.window_start)[11:16], str(r.window_end)[11:16]): r.event_count
            for r in df.collect()}


def test_tumbling_stream_in_every_mode(spark, inbox, folder):
    metrics_inbox(inbox)
    stream = lambda: aggregates.hourly_metrics_stream(
        with_watermark(one_file_each(spark, inbox, EVENT)))
    whole = {("00:00", "01:00"): 3, ("01:00", "02:00"): 1, ("02:00", "03:00"): 1}
    run(stream(), f"{folder}/complete", mode="complete")
    complete = jobs.read_snapshot(spark, f"{folder}/complete/out")
    assert counts(complete) == whole
    earlier = jobs.read_snapshot(spark, f"{folder}/complete/out", running=True)
    assert sum(counts(earlier).values()) in (4, 5)  # a last empty batch may repeat the result
    first = complete.orderBy("window_start").first()
    assert (first.unique_entities, first.unique_sessions, first.total_amount_usd) == (2, 1, 2.0)
    run(stream(), f"{folder}/update", mode="update")
    keys = ["window_start", "event_type", "source_system", "entity_type"]
    assert counts(jobs.read_updates(spark, f"{folder}/update/out", keys)) == whole
    run(stream(), f"{folder}/append")
    appended = dict(whole)
    del appended["02:00", "03:00"]  # still open
    assert counts(spark.read.parquet(f"{folder}/append/out")) == appended


def test_sliding_stream(spark, inbox, folder):
    inbox.put(event("a", 65), event("b", 80))
    metrics = aggregates.hourly_metrics_stream(
        with_watermark(one_file_each(spark, inbox, EVENT)), slide="15 minutes")
    run(metrics, folder, mode="complete")
    assert counts(jobs.read_snapshot(spark, f"{folder}/out")) == {
        ("00:15", "01:15"): 1, ("00:30", "01:30"): 2, ("00:45", "01:45"): 2,
        ("01:00", "02:00"): 2, ("01:15", "02:15"): 1,
    }


def test_trusted_layer_feeds_the_next_stream(spark, inbox, folder):
    metrics_inbox(inbox)
    run(one_file_each(spark, inbox, EVENT), folder)
    rows = with_watermark(read_table_stream(spark, f"{folder}/out"))
    run(aggregates.hourly_metrics_stream(rows), f"{folder}/gold", mode="complete")
    assert sum(counts(jobs.read_snapshot(spark, f"{folder}/gold/out")).values()) == 5


def table(spark, folder):
    rows = latest.read_latest(spark, f"{folder}/table", ["k"], ["o"]).collect()
    return {r.k: (r.o, r.v) for r in rows}


def test_newest_row_per_key_across_batches(spark, inbox, folder):
    inbox.put({"k": "a", "o": 1, "v": "x"}, {"k": "a", "o": 5, "v": "y"}, {"k": "b", "o": 2})
    inbox.put({"k": "a", "o": 3, "v": "late"}, {"k": "c", "o": 4, "v": "z"})
    start = lambda: latest.latest_stream(
        one_file_each(spark, inbox, CHANGE), ["k"], ["o"], f"{folder}/table", f"{folder}/c")
    start()
    assert table(spark, folder) == {"a": (5, "y"), "b": (2, None), "c": (4, "z")}
    inbox.put({"k": "b", "o": 9, "v": "new"})
    start()  # on the same checkpoint
    assert table(spark, folder) == {"a": (5, "y"), "b": (9, "new"), "c": (4, "z")}
    stored = spark.read.parquet(f"{folder}/table")
    assert stored.groupBy("batch_id").count().where("count > 2").isEmpty()


def test_newest_row_as_a_streaming_aggregate(spark, inbox, folder):
    inbox.put({"k": "a", "o": 5, "v": "y"}, {"k": "b", "o": 2})
    inbox.put({"k": "a", "o": 3, "v": "late"}, {"k": "b", "o": 4, "v": "z"})
    rows = latest_by(one_file_each(spark, inbox, CHANGE), ["k"], ["o"], how="agg")
    run(rows, folder, mode="complete")
    newest = jobs.read_snapshot(spark, f"{folder}/out").collect()
    assert {r.k: (r.o, r.v) for r in newest} == {"a": (5, "y"), "b": (4, "z")}


def test_a_repeated_batch_replaces_itself(spark, folder):
    rows = spark.createDataFrame([("a", 1, "x")], CHANGE)
    for _ in range(2):
        rows.write.mode("overwrite").parquet(jobs.batch_folder(f"{folder}/table", 0))
    assert spark.read.parquet(f"{folder}/table").count() == 1


def test_stream_upserts_into_a_seeded_table_and_folds(spark, inbox, folder):
    latest.seed(spark.createDataFrame([("a", 5, "old"), ("b", 5, "old")], CHANGE),
                f"{folder}/table")
    inbox.put({"k": "a", "o": 6, "v": "new"}, {"k": "b", "o": 4, "v": "late"},
              {"k": "c", "o": 1, "v": "new"})
    latest.upsert_stream(one_file_each(spark, inbox, CHANGE), ["k"], ["o"],
                         f"{folder}/c", path=f"{folder}/table")
    want = {"a": (6, "new"), "b": (5, "old"), "c": (1, "new")}
    assert table(spark, folder) == want
    latest.seed(latest.read_latest(spark, f"{folder}/table", ["k"], ["o"]), f"{folder}/next/table")
    assert table(spark, f"{folder}/next") == want
    with pytest.raises(ValueError):
        latest.upsert_stream(one_file_each(spark, inbox, CHANGE), ["k"], ["o"], f"{folder}/c2")


def test_folding_reads_only_the_batches_since(spark, inbox, folder, plan):
    def start():
        latest.latest_stream(one_file_each(spark, inbox, CHANGE), ["k"], ["o"],
                             f"{folder}/table", f"{folder}/c")

    def fold(out, previous=None):
        rows = latest.fold(spark, f"{folder}/table", f"{folder}/{out}", ["k"], ["o"],
                           previous and f"{folder}/{previous}")
        return {r.k: (r.o, r.v) for r in rows.collect()}

    inbox.put({"k": "a", "o": 5, "v": "x"}, {"k": "b", "o": 5, "v": "x"})
    inbox.put({"k": "a", "o": 6, "v": "y"})
    start()
    assert fold("one") == table(spark, folder) == {"a": (6, "y"), "b": (5, "x")}
    assert fold("same", "one") == fold("one")
    inbox.put({"k": "a", "o": 1, "v": "late"}, {"k": "c", "o": 1, "v": "z"})
    inbox.put({"k": "b", "o": 7, "v": "y"})
    start()
    want = {"a": (6, "y"), "b": (7, "y"), "c": (1, "z")}
    assert fold("two", "one") == fold("all") == table(spark, folder) == want
    assert fold("two", "one") == want  # a repeated fold replaces itself
    done = spark.read.parquet(f"{folder}/two").first().folded_to
    assert done == 2  # the newest batch, 3, is read again


def test_counts_of_each_batch_reach_the_log(spark, inbox, folder):
    inbox.put(event("a", 0, entity_id="u"), event(None, 1))
    inbox.put(event("b", 2, amount_usd=1.0))
    rows = one_file_each(spark, inbox, EVENT).withColumnRenamed("amount_usd", "amount")
    start = lambda: measure_stream(rows, EVENT_RULES, "flow", f"{folder}/table", f"{folder}/log",
                                   f"{folder}/c")
    start()
    start()
    log = spark.read.parquet(f"{folder}/log")
    assert log.count() == 2
    assert spark.read.parquet(f"{folder}/table").count() == 3
    summary = {r.expectation_name: (r.passed_records, r.failed_records)
               for r in monitor.dq_summary(log).collect()}
    assert summary["event_id_not_null"] == (2, 1)
    assert summary["entity_id_not_null"] == (1, 2)
    assert sum(r.output_rows for r in monitor.flow_throughput(log).collect()) == 3


def test_stream_and_batch_give_the_same_trusted_rows(spark, inbox, folder):
    def message(offset, event_id, minute):
        payload = {"event_id": event_id, "event_timestamp": f"2024-01-01T10:{minute:02d}:00Z",
                   "event_type": "VIEW", "amount": 1.5}
        return {"value": json.dumps(payload), "topic": "t", "partition": 0, "offset": offset,
                "timestamp": "2024-01-01T10:00:00Z"}

    inbox.put(message(1, "a", 1), message(2, "a", 1), message(3, None, 2))
    inbox.put(message(4, "b", 3), message(5, None, 3), message(6, "a", 1))
    schema = "value string, topic string, partition int, offset bigint, timestamp timestamp"
    stream = event_envelope(one_file_each(spark, inbox, schema), "2024-02-01")
    run(flows.trusted_events(stream, "2024-02-01"), folder)
    batch = event_envelope(spark.read.schema(schema).json(inbox.path), "2024-02-01")
    columns = ["event_id", "event_timestamp", "event_date", "event_hour", "amount_usd"]
    got = spark.read.parquet(f"{folder}/out").select(columns)
    want = flows.trusted_events(batch, "2024-02-01").select(columns)
    assert got.count() == want.count() == 4
    assert got.exceptAll(want).isEmpty()


def test_layers_are_tagged_and_partitioned(spark, folder):
    rows = spark.range(100).selectExpr("id", "date'2024-01-01' + CAST(id % 3 AS INT) AS event_date")
    jobs.write_layer(rows, f"{folder}/t", "gold", table="gold_rows", comment="it's gold",
                     partition_by=["event_date"])
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES gold_rows").collect()}
    assert props["quality"] == "gold"
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED gold_rows").collect()}
    assert described["Comment"] == "it's gold"
    assert spark.table("gold_rows").where("event_date = '2024-01-01'").count() == 34
    assert len(spark.read.parquet(f"{folder}/t").inputFiles()) == 3
    jobs.write_layer(rows, f"{folder}/plain", "raw", mode="append")
    assert spark.read.parquet(f"{folder}/plain").count() == 100
    with pytest.raises(KeyError):
        jobs.write_layer(rows, f"{folder}/x", "copper")


def test_partner_stream_prepares_the_rows_it_keeps(spark, inbox, folder):
    inbox.put({"k": "a", "o": 1, "created_date": "20240131"},
              {"k": "a", "o": 2, "created_date": "00000000", "changed_date": "20240201"})
    schema = "k string, o bigint, created_date string, changed_date string"
    latest.latest_stream(one_file_each(spark, inbox, schema), ["k"], ["o"], f"{folder}/table",
                         f"{folder}/c", prepare=lambda df: partners.add_bp_columns(df, "2024-02-01"))
    row = latest.read_latest(spark, f"{folder}/table", ["k"], ["o"]).first()
    assert (row.created_date_parsed, str(row.changed_date_parsed)) == (None, "2024-02-01")
