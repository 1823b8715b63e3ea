"""Bucketed layers join without a shuffle; clustered ones are read in part."""

import re

import pytest
from pyspark.sql import Row, functions as F

from test_partners import many_rows, trusted
from tidemark.operators import layout
from tidemark.operators.changes import upsert
from tidemark.operators.dedup import PARTNER_ORDER, latest_by, whole_keys
from tidemark.operators.partners import PARTNER, unify
from tidemark.sources.readers import replay

NOW = "2024-02-01 00:00:00"
KEYS = ("sap_client", "bp_number", "source_table")


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


def exchanges(text):
    return len(re.findall(r"\bExchange hashpartitioning", text))


@pytest.fixture
def big_joins(spark):
    """No side is small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unify_of_buckets_shuffles_nothing_whole(spark, plan, folder, big_joins):
    rows = trusted(spark, many_rows(3))
    layout.write_buckets(rows, "unify_buckets", f"{folder}/t", PARTNER, PARTNER_ORDER, 8, ["source_table"])
    got = layout.unify_buckets(spark, "unify_buckets", NOW)
    assert same(unify(rows, NOW), got)
    assert exchanges(plan(unify(spark.table("unify_buckets"), NOW, "join"))) == 0
    assert exchanges(plan(got)) == 1  # of the rows with an incomplete key
    assert exchanges(plan(unify(rows, NOW, "join"))) > 2
    stored = spark.table("unify_buckets")
    assert stored.groupBy(*PARTNER, "source_table").count().where("count > 1").isEmpty()
    files = stored.select(F.col("_metadata.file_name")).distinct().count()
    assert files <= 8
    assert spark.table("unify_buckets_incomplete").count() == rows.where("bp_number IS NULL OR sap_client IS NULL OR source_table IS NULL").count()


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_into_buckets_leaves_the_table_where_it_is(spark, plan, folder, big_joins, seed):
    rows = trusted(spark, many_rows(seed)).withColumn(
        "source_table", F.when(F.col("kafka_offset") % 7 != 0, F.col("source_table"))
    )
    told = whole_keys(KEYS, PARTNER_ORDER)
    old = latest_by(rows.where("kafka_offset % 3 > 0 AND kafka_offset < 300"), told, PARTNER_ORDER)
    new = rows.where("kafka_offset % 3 = 0 OR kafka_offset > 250")
    name = f"upsert_buckets_{seed}"
    layout.write_buckets(old, name, f"{folder}/t", PARTNER, PARTNER_ORDER, 8, KEYS[2:])
    got = layout.upsert_buckets(spark, name, new, PARTNER, KEYS, PARTNER_ORDER, 8)
    assert same(upsert(old, new, KEYS, PARTNER_ORDER), got)
    above = plan(got).split("FileScan parquet")[0]  # the table's own branch comes first
    assert exchanges(above) == 0 and "WindowGroupLimit" in above
    again = layout.upsert_buckets(spark, name, new.limit(0), PARTNER, KEYS, PARTNER_ORDER, 8)
    assert same(old, again)
    rest = spark.table(f"{name}_incomplete")
    assert not rest.isEmpty() and rest.where("source_table IS NOT NULL AND bp_number IS NOT NULL AND sap_client IS NOT NULL").isEmpty()


def test_buckets_of_an_empty_table(spark, folder):
    rows = trusted(spark, many_rows(3, n=5)).limit(0)
    layout.write_buckets(rows, "no_buckets", f"{folder}/t", PARTNER, PARTNER_ORDER, 4, ["source_table"])
    assert layout.unify_buckets(spark, "no_buckets", NOW).isEmpty()


def rows_scanned(spark, df):
    """Rows that the scan of a frame gave before any filter."""
    run = df._jdf.queryExecution()
    run.executedPlan().executeCollect()
    node = run.executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def messages(spark, n):
    return spark.range(n, numPartitions=4).selectExpr(
        "CAST(pmod(xxhash64(id), 4) AS INT) AS kafka_partition", "id AS kafka_offset", "repeat('x', 50) AS raw_payload"
    )


def test_replay_of_a_clustered_layer_opens_few_files(spark, folder, plan):
    raw = messages(spark, 40_000)
    layout.write_clustered(raw, f"{folder}/raw", ["kafka_partition", "kafka_offset"], 40)
    ranges = spark.createDataFrame([(1, 20_000, 20_500), (2, None, 90), (3, 39_900, None)], "p int, a bigint, b bigint")
    bounds = layout.replay_ranges(ranges)
    some = layout.read_clustered(spark, f"{folder}/raw", bounds)
    assert same(replay(raw, ranges), replay(some, ranges))
    every = spark.read.parquet(f"{folder}/raw").inputFiles()
    assert len(every) >= 30 and 0 < len(some.inputFiles()) <= len(every) / 5
    assert "PushedFilters: [Or" in plan(some, "formatted")
    none = layout.read_clustered(spark, f"{folder}/raw", layout.replay_ranges(ranges.limit(0)))
    assert none.isEmpty() and none.columns == raw.columns


def test_more_ranges_than_intervals_lose_nothing(spark, folder):
    raw = messages(spark, 20_000)
    layout.write_clustered(raw, f"{folder}/raw", ["kafka_partition", "kafka_offset"], 40)
    ranges = spark.range(300).selectExpr("CAST(id % 2 AS INT) AS p", "id * 11 AS a", "id * 11 + 3 AS b")
    some = layout.read_clustered(spark, f"{folder}/raw", layout.replay_ranges(ranges), most=10)
    assert same(replay(raw, ranges, block=64), replay(some, ranges, block=64))
    assert len(some.inputFiles()) < len(spark.read.parquet(f"{folder}/raw").inputFiles()) * 0.6
    assert len(layout.intervals(layout.replay_ranges(ranges), 10)) <= 10


def test_files_without_a_known_range_are_read(spark, folder):
    raw = messages(spark, 4_000)
    layout.write_clustered(raw, f"{folder}/raw", ["kafka_partition", "kafka_offset"], 10)
    late = spark.createDataFrame([(1, 9_999_999, "late")], raw.schema)
    late.write.mode("append").parquet(f"{folder}/raw")
    ranges = spark.createDataFrame([(1, 9_999_999, None)], "p int, a bigint, b bigint")
    assert replay(layout.read_clustered(spark, f"{folder}/raw", layout.replay_ranges(ranges)), ranges).count() == 1


def test_a_hot_key_fills_several_files(spark, folder):
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id")
    layout.write_clustered(rows, f"{folder}/t", ["k"], 12, ["id"])
    sizes = [r["n"] for r in spark.read.parquet(f"{folder}/t/_ranges").collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / 12
    wanted = spark.createDataFrame([("hot",)], "k string").select(F.struct("k").alias("low"), F.struct("k").alias("high"))
    some = layout.read_clustered(spark, f"{folder}/t", wanted)
    assert some.where("k = 'hot'").count() == 10_000 and len(some.inputFiles()) <= 6


def test_bloom_filters_skip_row_groups(spark, folder):
    rows = spark.range(0, 40_000, 2, numPartitions=1).selectExpr("id AS k", "CAST(rand(5) AS STRING) AS v")
    layout.write_clustered(rows, f"{folder}/t", ["k"], 1, distinct=40_000)
    absent = spark.createDataFrame([Row(low=Row(k=20_001), high=Row(k=20_001))], "low struct<k: bigint>, high struct<k: bigint>")
    read = layout.read_clustered(spark, f"{folder}/t", absent)
    assert len(read.inputFiles()) == 1  # within the file's range, but its bloom filter knows better
    assert read.isEmpty()
    assert rows_scanned(spark, read) == 0
    there = absent.select(*[F.struct(F.lit(20_000).cast("long").alias("k")).alias(c) for c in ("low", "high")])
    assert rows_scanned(spark, layout.read_clustered(spark, f"{folder}/t", there)) == 20_000


@pytest.mark.parametrize("seed", [4, 5])
def test_upsert_into_a_clustered_layer(spark, folder, seed):
    rows = trusted(spark, many_rows(seed))
    old = latest_by(rows.where("kafka_offset < 300"), whole_keys(KEYS, PARTNER_ORDER), PARTNER_ORDER)
    new = rows.where("kafka_offset >= 300 AND bp_number IN ('hot', '3', '17')")
    layout.write_clustered(old, f"{folder}/t", ["bp_number"], 20, KEYS)
    merged, others = layout.upsert_clustered(spark, f"{folder}/t", new, ["bp_number"], KEYS, PARTNER_ORDER)
    assert same(upsert(old, new, KEYS, PARTNER_ORDER), merged.unionByName(others))
    stored = len(spark.read.parquet(f"{folder}/t").inputFiles())
    assert len(others.inputFiles()) > stored / 2
    unknown = rows.where("bp_number IS NULL")
    merged, others = layout.upsert_clustered(spark, f"{folder}/t", unknown, ["bp_number"], KEYS, PARTNER_ORDER)
    assert same(upsert(old, unknown, KEYS, PARTNER_ORDER), merged.unionByName(others))
