"""Stream, table and replay sources, all giving the same message envelope."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(
    servers: str,
    topic: str,
    username: str | None = None,
    password: str | None = None,
    *,
    sink: bool = False,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
) -> dict[str, str]:
    """Options of a Kafka source or sink; with a user name the client logs in by SASL_SSL/PLAIN.

    A source starts at the earliest offset and fails when offsets have expired, so a first layer
    that promises to lose nothing does not skip data in silence; both can be changed.
    """
    options = {"kafka.bootstrap.servers": servers}
    if sink:
        options["topic"] = topic
    else:
        options["subscribe"] = topic
        options["startingOffsets"] = starting_offsets
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
        if max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if username is not None:
        secret = "" if password is None else password
        quoted = [text.replace("\\", "\\\\").replace('"', '\\"') for text in (username, secret)]
        options["kafka.security.protocol"] = "SASL_SSL"
        options["kafka.sasl.mechanism"] = "PLAIN"
        options["kafka.sasl.jaas.config"] = (
            f'{login_module} required username="{quoted[0]}" password="{quoted[1]}";'
        )
    return options


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema=None,
    path: str | None = None,
) -> DataFrame:
    """An unbounded source: `kafka` with `kafka_options`, or files with a declared schema.

    On files, `maxBytesPerTrigger` or `maxFilesPerTrigger` bound one micro-batch.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_table_stream(
    spark: SparkSession,
    path: str | None = None,
    schema=None,
    table: str | None = None,
    **options: str,
) -> DataFrame:
    """An upstream layer read as a stream, by table name or by folder; without a schema a folder
    must already hold files to take it from."""
    reader = spark.readStream.options(**options)
    if table is not None:
        return reader.table(table)
    if schema is None:
        schema = spark.read.parquet(path).schema
    return reader.schema(schema).parquet(path)


WIDE = 4096  # blocks; a range beyond that is cut to the offsets there are, like an open one


def replay(
    raw: DataFrame,
    ranges: Iterable[tuple[int, int | None, int | None]] | DataFrame,
    partition: str = "kafka_partition",
    offset: str = "kafka_offset",
    days: tuple[str | None, str | None] | None = None,
    day: str = "ingest_date",
    block: int = 1 << 20,
) -> DataFrame:
    """The rows of a raw layer inside (partition, from, to) ranges, both ends included.

    A list becomes one predicate that reaches the file scan, with None for an open end. A
    DataFrame with those three columns is matched by a semi join, so overlaps repeat no row: its
    ranges are cut into blocks of offsets, which with the partition are the key, so the rows of a
    partition are spread over as many tasks as it has blocks. `days` (first, last, either may be
    None) reads only those folders of a layer that is partitioned by `day`.
    """
    if days is not None:
        first, last = days
        if first is not None:
            raw = raw.where(F.col(day) >= F.lit(first).cast("date"))
        if last is not None:
            raw = raw.where(F.col(day) <= F.lit(last).cast("date"))
    if isinstance(ranges, DataFrame):
        r = ranges.toDF("_partition", "_from", "_to")
        closed = F.coalesce(F.col("_to") - F.col("_from") < WIDE * block, F.lit(False))
        known, opened = r.where(closed), r.where(~closed)
        if not opened.isEmpty():  # the ends are looked up for those alone, in the partitions they name
            named = opened.select("_partition").distinct()
            ends = raw.select(F.col(partition).alias("_partition"), F.col(offset).alias("_offset"))
            ends = ends.join(named, "_partition", "left_semi").groupBy("_partition").agg(
                F.min("_offset").alias("_low"), F.max("_offset").alias("_high")
            )
            known = known.unionByName(opened.join(ends, "_partition").select(
                "_partition", F.greatest("_from", "_low").alias("_from"), F.least("_to", "_high").alias("_to")
            ))
        known = known.where("_from <= _to")
        blocks = known.withColumn("_block", F.explode(F.sequence(
            F.floor(F.col("_from") / block), F.floor(F.col("_to") / block)
        )))
        within = (
            (F.col(partition) == F.col("_partition"))
            & (F.floor(F.col(offset) / block) == F.col("_block"))
            & F.col(offset).between(F.col("_from"), F.col("_to"))
        )
        return raw.join(blocks, within, "left_semi")
    clauses = []
    for part, first, last in ranges:
        clause = F.col(partition) == part
        if first is not None:
            clause &= F.col(offset) >= first
        if last is not None:
            clause &= F.col(offset) <= last
        clauses.append(clause)
    return raw.where(reduce(lambda a, b: a | b, clauses, F.lit(False)))
