import pytest
from pyspark.errors import PySparkException

from tidemark.session import shared_dir
from tidemark.sources.readers import kafka_options, read_stream, replay


def test_source_options_lose_nothing_by_default():
    options = kafka_options("host:9092", "topic", "user", 'pa"ss')
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "topic",
        "startingOffsets": "earliest", "failOnDataLoss": "true",
        "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config":
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            'username="user" password="pa\\"ss";',
    }
    loose = kafka_options("h", "t", starting_offsets="latest", fail_on_data_loss=False,
                          max_offsets_per_trigger=500)
    assert (loose["startingOffsets"], loose["failOnDataLoss"]) == ("latest", "false")
    assert loose["maxOffsetsPerTrigger"] == "500"
    assert "kafka.sasl.mechanism" not in loose


def test_sink_options_name_the_topic():
    assert kafka_options("h", "out", sink=True) == {"kafka.bootstrap.servers": "h", "topic": "out"}


def test_message_source_needs_its_package(spark):
    with pytest.raises(PySparkException, match="(?i)kafka"):
        read_stream(spark, "kafka", kafka_options("h:1", "t"))


def test_replay_by_list_and_by_table(spark, plan, folder):
    spark.range(100).selectExpr(
        "CAST(id % 3 AS INT) AS kafka_partition", "id AS kafka_offset", "'x' AS raw_payload"
    ).write.parquet(folder)
    raw = spark.read.parquet(folder)
    ranges = [(0, None, 9), (0, 6, 12), (1, 90, None), (2, 50, 53)]
    listed = replay(raw, ranges)
    want = {0: [0, 3, 6, 9, 12], 1: [91, 94, 97], 2: [50, 53]}
    got = {}
    for r in listed.orderBy("kafka_offset").collect():
        got.setdefault(r.kafka_partition, []).append(r.kafka_offset)
    assert got == want
    table = spark.createDataFrame(ranges, "p int, a bigint, b bigint")
    assert replay(raw, table).exceptAll(listed).isEmpty()
    assert replay(raw, table).count() == listed.count()
    assert "PushedFilters: [Or" in plan(listed, "formatted")
    assert replay(raw, []).isEmpty()


class Session:
    def __init__(self, **conf):
        self.conf = {k.replace("__", "."): v for k, v in conf.items()}


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert shared_dir(Session(spark__checkpoint__dir="hdfs://x/ckpt/")) == "hdfs://x/ckpt"
    alone = Session(spark__master="local[4]")
    assert shared_dir(alone) == shared_dir(alone)
    with pytest.raises(RuntimeError):
        shared_dir(Session(spark__master="yarn"))
