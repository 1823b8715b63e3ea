"""Message feeds derived from the test tables, in the envelope a message source gives.

The tables hold no copies, gaps or faults, so the feeds put them in. Every tenth event is delivered
twice; some are delivered again with a time ten minutes later; some ids, entities and clients are
missing; some amounts are negative, some dates and some whole payloads unreadable; some partner
changes come a second time on another partition with the same offset. Feeds can be delivered in
parts, in order of time; some events come two parts late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.quality import Rules, expectation_counts
from tidemark.schemas import (
    ENVELOPE, EVENT_RULES, EVENT_TOPIC, PARTNER_RULES, PARTNER_TOPIC,
)
from tidemark.streaming.quality import log_details

PARTS = 3
EVENT_PARTS = ("2024-01-11", "2024-01-21")  # the first days of the later parts
PARTNER_PARTS = ("1996-01-01", "1999-01-01")
COPY, RESTAMPED, UNREADABLE = 1, 2, 3

MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _messages(
    df: DataFrame, key: Column, payload: Column, topic: str, broken: Column
) -> DataFrame:
    """Messages with the payload as JSON, cut off where `broken`; `part` tells when they come."""
    text = F.to_json(payload, MICROS)
    return df.select(
        key.cast("binary").alias("key"),
        F.when(broken, F.substring(text, 1, 12)).otherwise(text).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        "partition",
        "offset",
        "timestamp",
        "part",
    )


def _part(column: str, borders: tuple[str, ...]) -> Column:
    """How many of the borders lie at or before a time."""
    return sum(((F.col(column) >= F.lit(b).cast("timestamp")).cast("int") for b in borders), F.lit(0))


def event_messages(events: DataFrame) -> DataFrame:
    """`events` as messages; the copies of an event follow it by one, two and three offsets.

    Restamped copies come a part later, when a stream with a watermark no longer takes them, and so
    do not change what it keeps.
    """
    event = F.col("event_id")
    late = (event % 53 == 9) & (F.col("ts") < F.lit(EVENT_PARTS[0]).cast("timestamp"))
    restamped = (
        (event % 7 == 0) & (event % 53 != 9) & (event % 101 != 7) & (F.minute("ts") < 50)
        & (F.hour("ts") != 23) & (F.col("ts") < F.lit(EVENT_PARTS[-1]).cast("timestamp"))
    )
    deliveries = F.array_compact(F.array(
        F.lit(0), F.when(event % 10 == 0, F.lit(COPY)), F.when(restamped, F.lit(RESTAMPED)),
        F.when(event % 103 == 5, F.lit(UNREADABLE)),
    ))
    delivered = events.withColumn("part", _part("ts", EVENT_PARTS)).withColumn(
        "delivery", F.explode(deliveries)
    )
    # Compressed files hold many events a megabyte in few row groups, so the tasks that read them are too few for
    # the JSON of their events; the narrow rows are dealt out before it is made.
    delivered = delivered.repartition("event_id", "delivery", "ts")
    again = F.col("delivery") == RESTAMPED
    delivered = delivered.withColumns({
        "partition": (F.col("user_id") % 4).cast("int"),
        "offset": event * 4 + F.col("delivery"),
        "timestamp": F.col("ts").cast("timestamp"),
        "part": F.when(late, PARTS - 1).when(again, F.col("part") + 1).otherwise(F.col("part")),
    })
    user = F.col("user_id").cast("string")
    purchase = F.col("event_type") == "purchase"
    stamp = F.col("timestamp") + F.when(again, F.expr("INTERVAL 10 MINUTES")).otherwise(
        F.expr("INTERVAL 0 MINUTES"))
    payload = F.struct(
        F.when(event % 101 != 7, F.concat(F.lit("e"), event.cast("string"))).alias("event_id"),
        F.when(F.col("event_type") == "view", "PAGE_VIEW")
        .otherwise(F.upper("event_type")).alias("event_type"),
        F.when(event % 89 != 0, F.concat(F.lit("u"), user)).alias("entity_id"),
        F.lit("USER").alias("entity_type"),
        F.when(event % 2 == 0, "web").otherwise("app").alias("source_system"),
        stamp.alias("event_timestamp"),
        F.concat(F.lit("s"), user, F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        F.when(purchase & (event % 97 == 0), -F.col("value"))
        .when(purchase, F.col("value")).alias("amount"),
        F.when(event % 3 == 0, "USD").when(event % 3 == 1, "EUR").alias("currency"),
        F.from_json("props", "MAP<STRING, STRING>").alias("properties"),
    )
    return _messages(delivered, user, payload, EVENT_TOPIC, F.col("delivery") == UNREADABLE)


def partner_messages(
    orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame,
    supplier: DataFrame,
) -> DataFrame:
    """Each order as a change of its customer: a base row, a customer row and, where the key is
    also a supplier, a vendor row. Some come with a message that can't be read, and some customer
    rows an hour later again, on the next partition with the offset of the first."""
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    # Both joins share the customer's key, hence one shuffle of the orders. Joining customers to
    # suppliers first would leave their side without a shuffle of its own, and Spark splits a hot
    # key only between two shuffled sides.
    changes = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        supplier, F.col("s_suppkey") == F.col("o_custkey"), "left"
    )

    def source(name: str, number: int) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(number).alias("number"))

    order = F.col("o_orderkey")
    sources = F.array_compact(F.array(
        source("BUT000", 0), source("KNA1", 1),
        F.when(F.col("s_suppkey").isNotNull(), source("LFA1", 2)),
        F.when(order % 107 == 11, source("BUT000", 3)), F.when(order % 97 == 5, source("KNA1", 4)),
    ))
    rows = changes.withColumn("source", F.explode(sources))
    second = F.col("source.number") == 4
    rows = rows.withColumns({
        "partition": ((F.col("o_custkey") + second.cast("int")) % 4).cast("int"),
        "offset": order * 4 + F.when(second, 1).otherwise(F.col("source.number")),
        "timestamp": F.col("o_orderdate").cast("timestamp")
        + F.when(second, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOURS")),
        "part": _part("o_orderdate", PARTNER_PARTS),
    })

    partner = F.col("o_custkey")
    status = F.col("o_orderstatus")
    table_name = F.col("source.name")
    nation_code = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    number = F.lpad(partner.cast("string"), 10, "0")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    named = (table_name == "BUT000") & (partner % 7 != 0)
    payload = F.struct(
        number.alias("bp_number"),
        F.when(partner % 5 < 4, (partner % 5 + 1).cast("string")).alias("bp_category"),
        F.when((table_name == "KNA1") & (partner % 11 != 0),
               F.concat(F.col("c_name"), F.when(second, " II").otherwise("")))
        .when(table_name == "LFA1", F.col("s_name")).alias("full_name"),
        F.when(named, F.concat(F.lit("First"), partner.cast("string"))).alias("first_name"),
        F.when(named, F.concat(F.lit("Last"), partner.cast("string"))).alias("last_name"),
        F.when(F.col("c_nationkey") % 10 == 0, F.concat(F.lit("N"), nation_code))
        .when(F.col("c_nationkey") % 10 != 1, nation_code).alias("country_code"),
        F.col("r_name").alias("region"),
        F.when(table_name == "LFA1", F.concat(F.lit("T"), F.col("s_suppkey").cast("string")))
        .alias("tax_number"),
        F.when(F.col("o_orderkey") % 50 == 0, "00000000").otherwise(day).alias("created_date"),
        day.alias("changed_date"),
        (status != "P").alias("is_active"),
        table_name.alias("source_table"),
        F.when((table_name != "BUT000") | (order % 211 != 3), "100").alias("sap_client"),
        F.when(status == "O", "INSERT").when(status == "F", "UPDATE").otherwise("DELETE")
        .alias("event_type"),
    )
    return _messages(rows, number, payload, PARTNER_TOPIC, F.col("source.number") == 3)


def event_feed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with the part in which each message comes."""
    return event_messages(table(spark, sf_dir, "events"))


def partner_feed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    others = (table(spark, sf_dir, n) for n in ("customer", "nation", "region", "supplier"))
    return partner_messages(table(spark, sf_dir, "orders"), *others)


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_feed_parts(spark, sf_dir).drop("part")


def partner_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partner_feed_parts(spark, sf_dir).drop("part")


def deliver(feed: DataFrame, inbox: str, step: Callable[[DataFrame], object]) -> None:
    """Put the parts of a feed into a folder one after the other, and after each call `step` with
    the folder as a stream: what it starts goes on from its checkpoint with the new part alone."""
    spark = feed.sparkSession
    for part in range(PARTS):
        feed.where(F.col("part") == part).drop("part").write.mode("append").parquet(inbox)
        step(spark.readStream.schema(ENVELOPE).parquet(inbox))


def _progress(rows: DataFrame, flow: str, rules: Rules, at: Column, output: Column) -> DataFrame:
    counted = expectation_counts(rows.withColumn("_at", at), rules, ["_at"], [output.alias("_out")])
    return counted.select(
        F.col("_at").alias("timestamp"),
        F.lit("flow_progress").alias("event_type"),
        log_details(flow, F.col("expectations"), F.col("_out"), F.col("_rows")).alias("details"),
    )


def quality_log(parsed_events: DataFrame, parsed_partners: DataFrame) -> DataFrame:
    """A log of both feeds: one progress row per hour of events and per day of partner changes,
    and two rows that reports must skip."""
    hour_end = F.date_trunc("hour", "event_timestamp") + F.expr("INTERVAL 59 MINUTES")
    day_end = F.date_trunc("day", "kafka_ingest_timestamp") + F.expr("INTERVAL 23 HOURS")
    events = _progress(
        parsed_events, "trusted_events", EVENT_RULES, hour_end, F.count_distinct("event_id")
    )
    partners = _progress(
        parsed_partners, "bp_trusted", PARTNER_RULES, day_end, F.count(F.lit(1))
    )
    skipped = parsed_events.sparkSession.range(2).select(
        F.lit("2024-01-30 12:00:00").cast("timestamp").alias("timestamp"),
        F.when(F.col("id") == 0, "create_update").otherwise("flow_progress").alias("event_type"),
        F.lit('{"flow_progress":{"name":"idle","status":"IDLE"}}').alias("details"),
    )
    return events.unionByName(partners).unionByName(skipped)
