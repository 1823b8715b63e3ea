"""Small cases every implementation of these flows has to meet, each with rows that set a trap."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedup import PARTNER_KEYS, PARTNER_ORDER, latest_by, whole_keys
from tidemark.operators.events import type_source_metrics
from tidemark.operators.quality import valid_rows
from tidemark.schemas import PARTNER_RULES

CHANGE = ("sap_client string, bp_number string, event_type string, kafka_offset string, "
          "full_name string")


def by_text_offset(df, how):
    return latest_by(df, PARTNER_KEYS, [F.col("kafka_offset").try_cast("bigint")], how=how)


@pytest.mark.parametrize("how", ["window", "agg"])
def test_offsets_are_numbers_not_text(spark, how):
    df = spark.createDataFrame([
        ("200", "K7", "UPDATE", "99", "Mira"), ("200", "K7", "UPDATE", "100", "Mira Holt"),
        ("200", "K7", "UPDATE", "9", "M."), ("300", "K7", "UPDATE", "7", "Otto"),
        ("200", "K8", "UPDATE", "not a number", "Pia"),
    ], CHANGE)
    kept = {(r.sap_client, r.bp_number): (r.full_name, r.kafka_offset)
            for r in by_text_offset(df, how).collect()}
    assert kept == {("200", "K7"): ("Mira Holt", "100"), ("300", "K7"): ("Otto", "7"),
                    ("200", "K8"): ("Pia", "not a number")}


@pytest.mark.parametrize("how", ["window", "agg"])
def test_a_deletion_does_not_replace_an_insertion(spark, how):
    df = spark.createDataFrame([
        ("200", "K7", "INSERT", "5", None), ("200", "K7", "DELETE", "6", None),
        ("200", "K7", "DELETE", "8", "last"),
    ], CHANGE)
    kept = {r.event_type: r.kafka_offset for r in by_text_offset(df, how).collect()}
    assert kept == {"INSERT": "5", "DELETE": "8"}


@pytest.mark.parametrize("how", ["window", "agg"])
def test_equal_offsets_of_two_partitions(spark, how):
    df = spark.createDataFrame(
        [("200", "K7", "UPDATE", 40, "2024-03-01 08:00:00", 0, "early"),
         ("200", "K7", "UPDATE", 40, "2024-03-01 09:00:00", 1, "late"),
         ("200", "K7", "UPDATE", 40, "2024-03-01 09:00:00", 0, "late, lower partition")],
        "sap_client string, bp_number string, event_type string, kafka_offset bigint, "
        "kafka_ingest_timestamp string, kafka_partition int, full_name string")
    assert [r.full_name for r in latest_by(df, PARTNER_KEYS, PARTNER_ORDER, how=how).collect()] == ["late"]


def test_messages_without_a_whole_key_stay_apart(spark):
    df = spark.createDataFrame(
        [(None, None, 0, 1), (None, None, 0, 2), (None, "K7", 1, 1), (None, None, 0, 2), ("200", "K7", 0, 3), ("200", "K7", 0, 4)],
        "sap_client string, bp_number string, kafka_partition int, kafka_offset bigint")
    kept = latest_by(df, whole_keys(["sap_client", "bp_number"]), ["kafka_offset"]).collect()
    assert sorted((r.kafka_partition, r.kafka_offset) for r in kept) == [(0, 1), (0, 2), (0, 4), (1, 1)]


def test_sums_per_type_and_source(spark):
    ts = datetime(2023, 7, 4, 23, 59, 59)
    df = spark.createDataFrame(
        [("x1", "SEARCH", "c9", "kiosk", ts, None), ("x2", "SEARCH", "c9", "kiosk", ts, None),
         ("x3", "SEARCH", None, "kiosk", ts, None), ("x4", "REFUND", "c2", "kiosk", ts, -12.5),
         ("x5", "REFUND", "c3", "kiosk", ts, 2.25), ("x6", "REFUND", "c3", "phone", ts, None)],
        "event_id string, event_type string, entity_id string, source_system string, "
        "event_timestamp timestamp, amount_usd double",
    )
    rows = {(r.event_type, r.source_system): (r.event_count, r.unique_entities, r.total_amount_usd)
            for r in type_source_metrics(df).collect()}
    assert rows == {("SEARCH", "kiosk"): (3, 1, None), ("REFUND", "kiosk"): (2, 2, -10.25),
                    ("REFUND", "phone"): (1, 1, None)}


def test_copies_of_an_event_are_dropped(spark):
    df = spark.createDataFrame(
        [("x7", 3), ("x7", 1), ("x7", 2), ("x8", 9), (None, 4), (None, 5)], "event_id string, n int")
    kept = latest_by(df, whole_keys(["event_id"], ["n"]), ["n"], newest=False).collect()
    assert sorted(((r.event_id, r.n) for r in kept), key=str) == sorted([("x7", 1), ("x8", 9), (None, 4), (None, 5)], key=str)


def test_country_codes_have_two_characters(spark):
    df = spark.createDataFrame(
        [(1, "PT"), (2, "P"), (3, ""), (4, None), (5, "PRT"), (6, "Å2")], "n int, country_code string")
    valid = valid_rows(df, PARTNER_RULES["country_code_length"])
    assert sorted(r.n for r in valid.collect()) == [1, 4, 6]


def test_categories_are_known(spark):
    df = spark.createDataFrame(
        [(1, "3"), (2, "03"), (3, None), (4, "0"), (5, " 1"), (6, "2")], "n int, bp_category string")
    valid = valid_rows(df, PARTNER_RULES["bp_category_valid"])
    assert sorted(r.n for r in valid.collect()) == [1, 3, 6]
