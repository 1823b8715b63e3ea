"""Tables in hash buckets that go from one whole version to the next.

The files of a version lie in folders of their own, `data/version=V/bucket=B`, and a small pointer says
for every bucket which folder holds it. A version writes only the buckets it touches; the pointer takes
the others over from the version before, and is renamed into place last. Readers go by the newest
pointer, so they see a version or the one before, never parts of both. What a failed job has written
has no pointer, and the next one writes over it. One job writes a table at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.changes import change_feed, net_changes
from tidemark.session import folders, names, read_text, remove, write_text

VERSION = "change_version"
SLICE = "_slice"


@dataclass(frozen=True)
class Version:
    """`files` gives the version whose folder holds a bucket; a bucket that isn't there is empty. `note`
    is whatever the writer wants to change together with the rows, such as how far it has read."""

    number: int
    buckets: int
    schema: str
    files: Mapping[int, int] = field(default_factory=dict)
    note: Mapping[str, int] = field(default_factory=dict)


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def deal(rows: DataFrame, keys: Sequence[Column], buckets: int) -> DataFrame:
    """The rows shuffled by their `bucket` and, within it, a slice of the keys (a column more), so that all
    tasks have work however few buckets there are, and a bucket lies in as many tasks as it has slices."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = F.pmod(F.xxhash64(*keys), F.lit(-(-tasks // buckets))).cast("int")
    return rows.withColumn(SLICE, slices).repartition("bucket", SLICE)


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions there are pointers of, ascending."""
    found = (name.partition(".") for name in names(spark, f"{path}/pointers"))
    return sorted(int(number) for number, _, kind in found if kind == "json" and number.isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version of the table, by default the newest; None if there is none."""
    known = numbers(spark, path)
    if not known or number is not None and number not in known:
        return None
    stored = json.loads(read_text(spark, f"{path}/pointers/{known[-1] if number is None else number}.json"))
    return Version(**stored | {"files": {int(b): v for b, v in stored["files"].items()}})


def read(
    spark: SparkSession, path: str, at: Version | None, only: Iterable[int] | None = None, schema: StructType | None = None,
) -> DataFrame:
    """The rows of a version with their `bucket`, or of some of its buckets; no others are listed or read."""
    if schema is None:
        schema = StructType.fromJson(json.loads(at.schema))
    wanted = set(at.files if only is None else only) & set(at.files) if at else set()
    if not wanted:
        return spark.createDataFrame([], schema)
    folder = f"{path}/data"
    paths = [f"{folder}/version={at.files[b]}/bucket={b}" for b in sorted(wanted)]
    return spark.read.schema(schema).option("basePath", folder).parquet(*paths).select(*schema.names)


def commit(
    rows: DataFrame,
    path: str,
    base: Version | None,
    buckets: int,
    touched: Iterable[int],
    note: Mapping[str, int] | None = None,
    keys: Sequence[str] | None = None,
    compare: Sequence[str] | None = None,
    place: Sequence[str] = (),
    dealt: bool = False,
    fed: DataFrame | None = None,
) -> Version:
    """The next version: `rows`, with a column `bucket`, in place of all rows of the `touched` buckets.

    They are shuffled to their buckets first, unless `dealt` says that they come from `deal`. A writer that knows
    which rows have changed gives them as `fed`, and no versions are compared.
    Given `keys`, which rows have changed is written beside them, see `read_changes`; only touched buckets
    are compared. Rows with a NULL in their key are told apart by the columns of `place`.
    """
    spark = rows.sparkSession
    number = base.number + 1 if base else 1
    folder = f"{path}/data/version={number}"
    placed = rows if dealt else rows.hint("rebalance", "bucket")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    touched = set(touched)
    files = {b: v for b, v in (base.files if base else {}).items() if b not in touched}
    files |= {int(name.partition("=")[2]): number for name in folders(spark, folder) if name.startswith("bucket=")}
    new = Version(number, buckets, rows.schema.json(), files, dict(note or {}))
    if fed is None and keys is not None:
        old = read(spark, path, base, touched, rows.schema)
        fed = change_feed(old.drop("bucket"), read(spark, path, new, touched).drop("bucket"), keys, compare, place)
    if fed is not None:
        fed.write.mode("overwrite").parquet(f"{path}/changes/{VERSION}={number}")
    write_text(spark, f"{path}/pointers/{number}.json", json.dumps(asdict(new)))
    return new


def read_changes(
    spark: SparkSession, path: str, since: int = 0, until: int | None = None,
) -> DataFrame:
    """Every row changed after version `since` up to `until` (by default the newest), with the number of
    the version that changed it; raises if the changes of one of them are no longer kept."""
    newest = version(spark, path)
    last = (newest.number if newest else 0) if until is None else until
    kept = {int(n.partition("=")[2]) for n in folders(spark, f"{path}/changes") if n.startswith(VERSION)}
    wanted = list(range(since + 1, last + 1))
    if newest is None or last > newest.number or not set(wanted) <= kept:
        raise ValueError(f"the changes of versions {since + 1} to {last} aren't all there")
    if not wanted:
        fed = spark.read.parquet(f"{path}/changes/{VERSION}={max(kept)}").limit(0)
        return fed.withColumn(VERSION, F.lit(0))
    reader = spark.read.option("basePath", f"{path}/changes")
    return reader.parquet(*[f"{path}/changes/{VERSION}={n}" for n in wanted])


def changes_between(
    spark: SparkSession, path: str, keys: Sequence[str], since: int = 0, until: int | None = None,
    place: Sequence[str] = (),
) -> DataFrame:
    """What has changed in all between two versions, as `changes.change_feed` of both would give it, out of
    the change rows alone."""
    return net_changes(read_changes(spark, path, since, until), keys, VERSION, place)


def vacuum(spark: SparkSession, path: str, keep: int = 2, keep_changes: int | None = None) -> None:
    """Delete all but the newest `keep` versions, and what only they or failed jobs have written. The change rows of
    the newest `keep_changes` versions stay, by default of all."""
    known = numbers(spark, path)
    if not known:
        return
    for old in known[:-keep]:
        remove(spark, f"{path}/pointers/{old}.json")
    kept = [version(spark, path, n) for n in known[-keep:]]
    used = {(v, b) for at in kept for b, v in at.files.items()}
    for folder in folders(spark, f"{path}/data"):
        number = int(folder.partition("=")[2])
        inside = {int(n.partition("=")[2]) for n in folders(spark, f"{path}/data/{folder}") if n.startswith("bucket=")}
        if not any((number, b) in used for b in inside):
            remove(spark, f"{path}/data/{folder}")
            continue
        for b in inside:
            if (number, b) not in used:
                remove(spark, f"{path}/data/{folder}/bucket={b}")
    if keep_changes is not None:
        for name in folders(spark, f"{path}/changes"):
            if int(name.partition("=")[2]) <= known[-1] - keep_changes:
                remove(spark, f"{path}/changes/{name}")


def name_version(spark: SparkSession, view: str, path: str, at: Version) -> None:
    """A name in the catalog for a version: a view that reads its folders, replaced at once."""
    columns = [f"`{c}`" for c in StructType.fromJson(json.loads(at.schema)).names if c != "bucket"]
    by: dict[int, list[str]] = {}
    for bucket, number in sorted(at.files.items()):
        by.setdefault(number, []).append(str(bucket))
    where = " OR ".join(f"version = {v} AND bucket IN ({', '.join(b)})" for v, b in by.items()) or "false"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(columns)} FROM parquet.`{path}/data` WHERE {where}")
