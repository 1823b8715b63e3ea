"""Layers whose files follow a key: hash buckets that join without a shuffle, key ranges of which few files are read."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import Row, StructType

from tidemark.functions.columns import Moment
from tidemark.operators.changes import upsert
from tidemark.operators.dedup import PARTNER_ORDER, latest_by
from tidemark.operators.partners import PARTNER, unify

INTERVALS = 128  # most key intervals that are looked up; more keys are merged into so many
_REST = "_incomplete"
_RANGES = "_ranges"


# --- hash buckets ---------------------------------------------------------------------------

def _whole(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def write_buckets(
    df: DataFrame,
    table: str,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int,
    per: Sequence[str] = (),
) -> None:
    """The newest row of each key (and of each value of `per`) as a table in hash buckets of `keys`.

    Each bucket is one file, sorted by the keys, so joins, windows and groups on the keys read it as it
    lies. A key is cut to its newest rows before it is shuffled, so a hot one sends few. Rows with a NULL
    in `keys` or `per` join nothing and would meet in one bucket: they go, all of them, to a plain table
    beside it, which has `_incomplete` added to its name. `buckets` fixes the tasks of later
    joins; tables that are to be joined need the same number.
    """
    whole = _whole([*keys, *per])
    newest = latest_by(df.where(whole), [*keys, *per], order)
    writer = newest.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    rest = df.where(~whole).write.mode("overwrite").format("parquet")
    rest.option("path", f"{path}{_REST}").saveAsTable(f"{table}{_REST}")


def unify_buckets(
    spark: SparkSession,
    table: str,
    now: Moment = None,
    keys: Sequence[str] = PARTNER,
    order: Sequence[str] = PARTNER_ORDER,
    **options,
) -> DataFrame:
    """`partners.unify` of a table in buckets of `keys`, which holds rows per source: no row is shuffled
    but those with an incomplete key."""
    whole = unify(spark.table(table), now, "join", keys, order, **options)
    rest = unify(spark.table(f"{table}{_REST}"), now, "pivot", keys, order, **options)
    return whole.unionByName(rest)


def upsert_buckets(
    spark: SparkSession,
    table: str,
    updates: DataFrame,
    bucket_keys: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int,
    position: Sequence[str] | None = None,
) -> DataFrame:
    """`changes.upsert` into a table with one row per `keys`, in buckets of `bucket_keys`: those of them that
    `write_buckets` took as its keys, the others being `per`.

    The updates are cut to the newest per key and dealt to the same buckets; the table stays where it is
    and is read once. Rows that miss a key are upserted into the table beside it.
    """
    whole, stored = _whole(keys), spark.table(table)
    new = latest_by(updates.where(whole), keys, order).select(*stored.columns).repartition(buckets, *bucket_keys)
    merged = latest_by(stored.unionByName(new), keys, order)  # both in the same buckets, so is their union
    rest = upsert(spark.table(f"{table}{_REST}"), updates.where(~whole), keys, order, position)
    return merged.unionByName(rest.select(*merged.columns))


# --- key ranges -----------------------------------------------------------------------------

def write_clustered(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    files: int,
    spread: Sequence[str] = (),
    row_group: int | None = None,
    distinct: int | None = None,
) -> None:
    """Rows in about `files` files that follow one another by `keys`, sorted, with bloom filters on the keys.

    `spread` columns go on ordering the rows of one key, so that a hot key fills several files instead of
    one. `distinct` is how many values of a key a row group is expected to hold, `row_group` its size in
    bytes. What range of keys each file holds is written to a hidden folder beside the files, from a scan of
    the key columns alone; `read_clustered` goes by it, and reads files it doesn't know of.
    """
    columns = [*keys, *[c for c in spread if c not in keys]]
    writer = df.repartitionByRange(files, *columns).sortWithinPartitions(*columns).write.mode("overwrite")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        if distinct:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct))
    if row_group:
        writer = writer.option("parquet.block.size", str(row_group))
    writer.parquet(path)
    # A struct of the keys sorts like the rows do: by the first key, then the next, NULL before all.
    key = F.struct(*keys)
    ranges = df.sparkSession.read.schema(df.select(*keys).schema).parquet(path)
    ranges = ranges.groupBy(F.col("_metadata.file_name").alias("file"))
    ranges = ranges.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n"))
    ranges.write.mode("overwrite").parquet(f"{path}/{_RANGES}")


def intervals(ranges: DataFrame, most: int = INTERVALS) -> list[Row]:
    """At most `most` rows (low, high) that cover all of `ranges`, whose columns are two structs of keys.

    Few ranges are covered as they are. More are sorted, and neighbours merged, so what is covered grows but
    nothing is left out, and the driver gets `most` rows however many there are.
    """
    low, high = ranges.columns
    exact = ranges.select(F.col(low).alias("low"), F.col(high).alias("high")).distinct().limit(most + 1).collect()
    if len(exact) <= most:
        return exact
    dealt = ranges.repartitionByRange(most, low)
    merged = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(low).alias("low"), F.max(high).alias("high"))
    return merged.select("low", "high").collect()


def _literal(value: Row, schema: StructType) -> Column:
    return F.struct(*[F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in schema])


def _any(conditions: Sequence[Column]) -> Column:
    """True where one of them is; a balanced tree, as a long chain of ORs is deep to plan."""
    found = list(conditions) or [F.lit(False)]
    while len(found) > 1:
        found = [reduce(lambda a, b: a | b, found[i : i + 2]) for i in range(0, len(found), 2)]
    return found[0]


def _within(cover: Sequence[Row], schema: StructType) -> Column:
    """A condition that every row inside the intervals meets, in comparisons that reach the file scan: row groups
    are skipped by their extremes, and for single keys by their bloom filters."""

    def inside(low: Row, high: Row) -> Column:
        parts = []
        for field in schema:
            column, a, b = F.col(field.name), low[field.name], high[field.name]
            if a is not None and a == b:
                parts.append(column == F.lit(a).cast(field.dataType))
                continue  # the next key is bounded as well
            if a is not None:
                parts.append(column >= F.lit(a).cast(field.dataType))
            if b is not None:
                upper = column <= F.lit(b).cast(field.dataType)
                parts.append(upper if a is not None else upper | column.isNull())
            break
        return reduce(lambda x, y: x & y, parts, F.lit(True))

    return _any([inside(r["low"], r["high"]) for r in cover])


def touched_files(spark: SparkSession, path: str, cover: Sequence[Row]) -> tuple[list[str], list[str]]:
    """The files of a clustered layer that may hold keys of the intervals, and those that can't."""
    ranges = spark.read.parquet(f"{path}/{_RANGES}")
    schema = ranges.schema["low"].dataType
    meets = _any([
        (F.col("low") <= _literal(r["high"], schema)) & (F.col("high") >= _literal(r["low"], schema)) for r in cover
    ])
    apart = {r["file"] for r in ranges.where(~meets).select("file").collect()}  # file names, as Spark lists them too
    found: tuple[list[str], list[str]] = ([], [])
    for file in sorted(spark.read.parquet(path).inputFiles()):
        found[file.rsplit("/", 1)[-1] in apart].append(file)
    return found


def _files(spark: SparkSession, files: Sequence[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def read_clustered(spark: SparkSession, path: str, ranges: DataFrame, most: int = INTERVALS) -> DataFrame:
    """Rows of a clustered layer among which are all those inside `ranges`, two structs of its keys each.

    Only files whose keys meet the ranges are opened, and only row groups in them that may. A few rows
    outside are among them: match them by the ranges themselves, as `replay` does.
    """
    cover = intervals(ranges, most)
    schema = spark.read.parquet(path).schema
    keys = spark.read.parquet(f"{path}/{_RANGES}").schema["low"].dataType
    return _files(spark, touched_files(spark, path, cover)[0], schema).where(_within(cover, keys))


def replay_ranges(ranges: DataFrame, partition: str = "kafka_partition", offset: str = "kafka_offset") -> DataFrame:
    """Replay ranges (partition, from, to; a NULL end is open) as two structs of the clustering keys."""
    r = ranges.toDF("_partition", "_from", "_to")

    def end(value: Column) -> Column:
        return F.struct(F.col("_partition").alias(partition), value.alias(offset))

    last = F.coalesce(F.col("_to").cast("long"), F.lit((1 << 63) - 1))
    return r.select(end(F.col("_from").cast("long")).alias("low"), end(last).alias("high"))


def upsert_clustered(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    cluster_keys: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    position: Sequence[str] | None = None,
    most: int = INTERVALS,
) -> tuple[DataFrame, DataFrame]:
    """`changes.upsert` into a layer clustered by `cluster_keys` (some of `keys`), as two frames: what becomes of
    the files that updates touch, and the rows of the other files, which are not shuffled."""
    key = F.struct(*cluster_keys)
    schema = spark.read.parquet(path).schema
    cover = intervals(updates.select(key.alias("low"), key.alias("high")), most)
    touched, apart = touched_files(spark, path, cover)
    merged = upsert(_files(spark, touched, schema), updates, keys, order, position)
    return merged, _files(spark, apart, schema)
