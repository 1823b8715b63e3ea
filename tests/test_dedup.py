import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedup import PARTNER_KEYS, PARTNER_ORDER, dedup_events, latest_by

ROWS = "k string, offset bigint, ts string, part int, v string"


def values(df, column="v"):
    return sorted(r[column] for r in df.collect())


@pytest.mark.parametrize("how", ["window", "agg"])
def test_text_offsets_order_as_numbers(spark, how):
    df = spark.createDataFrame([("a", "900", "old"), ("a", "1000", "new")],
                               "k string, offset string, v string")
    assert values(latest_by(df, ["k"], [F.col("offset").try_cast("bigint")], how=how)) == ["new"]


@pytest.mark.parametrize("how", ["window", "agg"])
def test_ties_fall_to_later_ingest_then_higher_partition(spark, how):
    df = spark.createDataFrame(
        [("a", 5, "t1", 3, "early"), ("a", 5, "t2", 0, "late"),
         ("b", 5, "t1", 0, "low"), ("b", 5, "t1", 1, "high")], ROWS)
    assert values(latest_by(df, ["k"], ["offset", "ts", "part"], how=how)) == ["high", "late"]


@pytest.mark.parametrize("how", ["window", "agg"])
def test_null_order_loses_and_null_keys_form_a_group(spark, how):
    df = spark.createDataFrame(
        [("a", None, "t", 0, "x"), ("a", 1, "t", 0, "y"),
         (None, 1, "t", 0, "p"), (None, 2, "t", 0, "q")], ROWS)
    assert values(latest_by(df, ["k"], ["offset"], how=how)) == ["q", "y"]


@pytest.mark.parametrize("how", ["window", "agg"])
def test_first_delivery_survives_and_missing_ids_are_all_kept(spark, how):
    df = spark.createDataFrame(
        [("e1", 7, 0, "again"), ("e1", 3, 0, "first"), (None, 4, 0, "n1"), (None, 5, 0, "n2"),
         (None, 4, 1, "n3")],
        "event_id string, kafka_offset bigint, kafka_partition int, v string",
    ).withColumn("kafka_timestamp", F.lit("2024-01-01").cast("timestamp"))
    assert values(dedup_events(df, how=how)) == ["first", "n1", "n2", "n3"]


def test_hot_key_is_cut_before_the_shuffle(spark, plan):
    rows = spark.range(3000).select(
        F.lit("100").alias("sap_client"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        .alias("bp_number"),
        F.lit("UPDATE").alias("event_type"),
        F.col("id").alias("kafka_offset"),
        F.lit("2024-01-01").cast("timestamp").alias("kafka_ingest_timestamp"),
        F.lit(0).alias("kafka_partition"),
    )
    kept = latest_by(rows, PARTNER_KEYS, PARTNER_ORDER)
    nodes = re.findall(r"WindowGroupLimit .*?(Partial|Final)|(Exchange)", plan(kept))
    assert [a or b for a, b in nodes] == ["Final", "Exchange", "Partial"]
    assert kept.count() == 2001
    assert kept.where("bp_number = 'hot'").first().kafka_offset == 2997
    other = latest_by(rows, PARTNER_KEYS, PARTNER_ORDER, how="agg")
    assert other.exceptAll(kept).isEmpty() and other.count() == 2001


def test_unknown_strategy_is_refused(spark):
    with pytest.raises(ValueError):
        latest_by(spark.range(1), ["id"], ["id"], how="sort")


def test_rows_with_maps_can_be_picked(spark):
    df = spark.createDataFrame([("a", 1, {"k": "1"}), ("a", 2, {"k": "2"})],
                               "k string, o int, m map<string,string>")
    for how in ("window", "agg"):
        assert latest_by(df, ["k"], ["o"], how=how).first().m == {"k": "2"}
