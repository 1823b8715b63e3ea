"""The feeds themselves: envelope, injected faults, and a hot customer."""

from pyspark.sql import functions as F

from tidemark.schemas import ENVELOPE, EVENT_PAYLOAD, PARTNER_PAYLOAD
from tidemark.sources import feeds
from tidemark.streaming import jobs

SMALL = "/root/testdata/sf0.001"


def test_feeds_have_the_message_envelope(spark):
    want = [(f.name, f.dataType) for f in spark.createDataFrame([], ENVELOPE).schema]
    for feed in (feeds.event_feed, feeds.partner_feed):
        assert [(f.name, f.dataType) for f in feed(spark, SMALL).schema] == want


def test_parts_are_delivered_in_turn(spark, folder):
    seen = []

    def step(stream):
        assert stream.isStreaming and stream.columns == spark.createDataFrame([], ENVELOPE).columns
        query = jobs.run_stream(stream, f"{folder}/out", f"{folder}/c")
        seen.append(jobs.stream_stats(query)["input_rows"])

    feeds.deliver(feeds.event_feed_parts(spark, SMALL), f"{folder}/in", step)
    assert len(seen) == feeds.PARTS and sum(seen) == feeds.event_feed(spark, SMALL).count()
    assert all(seen)


def test_event_faults(spark):
    parsed = feeds.event_feed(spark, SMALL).select(
        F.from_json(F.col("value").cast("string"), EVENT_PAYLOAD).alias("p")).select("p.*")
    counted = parsed.select(
        F.count("*"), F.count_distinct("event_id"), F.count_if(F.col("event_id").isNull()),
        F.count_if(F.col("event_type").isNull()), F.count_if(F.col("amount") < 0)).first()
    total, unique, nameless, unreadable, negative = counted
    assert (unique, unreadable, negative) == (990, 10, 1)
    assert nameless > 20 and total > 1150


def test_partner_faults(spark):
    feed = feeds.partner_feed(spark, SMALL)
    places = feed.select("partition", "offset").distinct().count()
    assert feed.count() == places > feed.select("offset").distinct().count()
    parsed = feed.select(F.from_json(F.col("value").cast("string"), PARTNER_PAYLOAD).alias("p")).select("p.*")
    unreadable = parsed.where("bp_number IS NULL AND source_table IS NULL AND event_type IS NULL").count()
    clientless = parsed.where("sap_client IS NULL AND source_table = 'BUT000'").count()
    assert unreadable > 5 and clientless > 5


def test_a_hot_customer_is_split_in_the_join(spark, plan):
    """A third of the orders belong to one customer, and nothing is small enough to broadcast."""
    orders = spark.range(0, 300_000, 1, 8).selectExpr(
        "id AS o_orderkey", "IF(id % 3 = 0, 0, id % 150) AS o_custkey",
        "'O' AS o_orderstatus", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS o_orderdate",
    )
    others = [feeds.table(spark, SMALL, n) for n in ("customer", "nation", "region", "supplier")]
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        feed = feeds.partner_messages(orders, *others)
        counted = feed.groupBy("partition").agg(F.count("*").alias("n"), F.max("value"))
        total = sum(r.n for r in counted.collect())
        # Customers, then suppliers: both joins see the hot key, both are split.
        assert plan(counted).split("Initial Plan")[0].count("SortMergeJoin(skew=true)") == 2
        vendors = orders.where("o_custkey < 10").count()
        more = orders.where("o_orderkey % 107 = 11").count() + orders.where("o_orderkey % 97 = 5").count()
        assert total == 2 * 300_000 + vendors + more
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
