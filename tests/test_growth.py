"""Work that must not be done twice, or by too few tasks, however large the tables are."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tidemark.operators import envelope, events
from tidemark.plans import catalog
from tidemark.schemas import PARTNER_PAYLOAD
from tidemark.sources import feeds
from tidemark.streaming import jobs, latest, versions

SMALL = driver.SMALL


def test_conditions_on_a_payload_do_not_parse_it_again(spark, plan):
    raw = spark.createDataFrame([(1, '{"bp_number": "7", "source_table": "KNA1"}'), (2, None), (3, "{bad")], "k int, raw_payload string")
    parsed = envelope.parse_payload(raw, PARTNER_PAYLOAD, ("k",))
    some = parsed.where("source_table = 'KNA1' AND bp_number IS NOT NULL AND full_name IS NULL")
    assert plan(some).count("from_json") == 1
    assert [r.k for r in some.collect()] == [1] and parsed.where("bp_number IS NULL").count() == 2


def test_event_messages_are_made_after_the_rows_are_dealt_out(spark, plan):
    text = plan(feeds.event_feed(spark, SMALL))
    assert text.index("StructsToJson") < text.index("REPARTITION_BY_COL") < text.index("Scan parquet")  # the last step comes first


@pytest.mark.parametrize("name", ["bp_unified", "metrics_by_grain"])
def test_branches_read_a_table_that_is_made_once(spark, plan, name):
    assert "from_json" not in plan(catalog.queries()[name](spark, SMALL))


@pytest.mark.parametrize("minutes, slide", [(50, 15), (7, 3), (60, 15), (20, 20), (45, 30)])
def test_windows_of_any_length_are_made_of_panes(spark, plan, minutes, slide):
    rnd = random.Random(minutes)
    rows = [
        (rnd.choice("ab"), rnd.choice(["web", None]), "USER", rnd.choice([None, *"123456"]), rnd.choice([None, "x", "y"]), rnd.choice("stuv"),
         dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(4 * 3600)), rnd.choice([None, 1.5, 2.0]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "event_type string, source_system string, entity_type string, event_id string, entity_id string,"
                               " session_id string, event_timestamp timestamp, amount_usd double")
    got = events.hourly_metrics(df, f"{minutes} minutes", slide=f"{slide} minutes", now="2024-02-01 00:00:00")
    assert "Expand" not in plan(got)  # no copy of a row for each window
    names = ["window_start", "window_end", *events.DIMENSIONS, "event_count", "unique_events", "unique_entities", "unique_sessions",
             "total_amount_usd", "first_event_at", "last_event_at"]
    want = df.groupBy(F.window("event_timestamp", f"{minutes} minutes", f"{slide} minutes").alias("w"), *events.DIMENSIONS).agg(
        F.count("*").alias("event_count"), F.count_distinct("event_id").alias("unique_events"),
        F.count_distinct("entity_id").alias("unique_entities"), F.count_distinct("session_id").alias("unique_sessions"),
        F.sum("amount_usd").alias("total_amount_usd"), F.min("event_timestamp").alias("first_event_at"),
        F.max("event_timestamp").alias("last_event_at"),
    ).withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")})
    assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(map(tuple, want.select(names).collect()), key=str)


def test_a_merge_knows_its_changes_without_comparing_versions(spark, folder, monkeypatch):
    def put(batch, rows):
        spark.createDataFrame(rows, "k int, t int, v string").write.parquet(jobs.batch_folder(f"{folder}/in", batch))

    def merge():
        return latest.merge_batches(spark, f"{folder}/in", f"{folder}/out", ["k"], ["t"], ["k"], buckets=2)

    def compared(*_, **__):
        raise AssertionError("versions were compared")

    monkeypatch.setattr(versions, "change_feed", compared)
    put(0, [(1, 1, "a"), (2, 1, "a"), (3, 5, "a"), (None, 1, "n")])
    merge()
    put(1, [(1, 2, "b"), (2, 1, "a"), (3, 4, "late"), (4, 1, "c"), (None, 1, "n"), (None, 2, "m")])
    merge()
    fed = versions.read_changes(spark, f"{folder}/out", 1).drop(versions.VERSION)
    assert sorted(map(tuple, fed.collect()), key=str) == sorted([
        ("update_pre", 1, 1, "a"), ("update_post", 1, 2, "b"), ("insert", 4, 1, "c"), ("insert", None, 2, "m")], key=str)
    newest = versions.read(spark, f"{folder}/out", versions.version(spark, f"{folder}/out")).drop("bucket")
    assert sorted(map(tuple, newest.collect()), key=str) == sorted([
        (1, 2, "b"), (2, 1, "a"), (3, 5, "a"), (4, 1, "c"), (None, 1, "n"), (None, 2, "m")], key=str)


def test_a_fold_after_an_ended_stream_reads_the_new_batches_alone(spark, folder):
    def put(batch, rows):
        spark.createDataFrame(rows, "k string, o int, v string").write.parquet(jobs.batch_folder(f"{folder}/in", batch))

    def fold(out, previous=None):
        return latest.fold(spark, f"{folder}/in", f"{folder}/{out}", ["k"], ["o"], previous and f"{folder}/{previous}", running=False)

    def found(out, previous=None):
        return sorted(map(tuple, fold(out, previous).collect()), key=str)

    put(0, [("a", 1, "x"), ("b", 5, "x"), (None, 1, "n")])
    assert found("one") == sorted([("a", 1, "x"), ("b", 5, "x"), (None, 1, "n")], key=str)
    put(1, [("a", 2, "y"), ("b", 4, "late"), ("c", 1, "z"), (None, 2, "m")])
    spark.createDataFrame([("a", 9, "read again")], "k string, o int, v string").write.mode("overwrite").parquet(jobs.batch_folder(f"{folder}/in", 0))
    want = sorted([("a", 2, "y"), ("b", 5, "x"), ("c", 1, "z"), (None, 1, "n"), (None, 2, "m")], key=str)
    assert found("two", "one") == want
    assert found("same", "two") == want
