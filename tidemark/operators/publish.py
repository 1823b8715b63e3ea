"""Publishing: contract projection, keyed messages and the message sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampType

from tidemark.operators.changes import change_feed
from tidemark.schemas import PARTNER_CONTRACT, avro_schema


def conform(df: DataFrame, contract: StructType = PARTNER_CONTRACT) -> DataFrame:
    """The contract's fields, by name, in its order and types.

    An optional field that is absent becomes NULL. A required field must exist, and a NULL in it
    stops the job: no consumer gets a record that breaks the contract.
    """
    present = set(df.columns)
    fields = []
    for field in contract:
        if field.name in present:
            value = F.col(field.name).cast(field.dataType)
        elif field.nullable:
            value = F.lit(None).cast(field.dataType)
        else:
            raise ValueError(f"required field {field.name!r} is missing")
        if not field.nullable:
            broken = F.raise_error(F.lit(f"required field {field.name} is NULL"))
            value = F.coalesce(value, broken.cast(field.dataType))
        fields.append(value.alias(field.name))
    return df.select(*fields)


def breaches(df: DataFrame, contract: StructType = PARTNER_CONTRACT) -> DataFrame:
    """The rows that break the contract, with the required fields they lack in `missing_fields`."""
    return _checked(df, contract).where(F.size("missing_fields") > 0)


def publishable(df: DataFrame, contract: StructType = PARTNER_CONTRACT) -> DataFrame:
    """The rows that keep the contract."""
    return _checked(df, contract).where(F.size("missing_fields") == 0).drop("missing_fields")


def missing_fields(contract: StructType = PARTNER_CONTRACT) -> Column:
    """The required fields that are NULL."""
    required = [f.name for f in contract if not f.nullable]
    absent = [F.when(F.col(name).isNull(), F.lit(name)) for name in required]
    return F.array_compact(F.array(*absent))


def _checked(df: DataFrame, contract: StructType) -> DataFrame:
    return df.withColumn("missing_fields", missing_fields(contract))


def serialize(contract: StructType, serializer: str = "json") -> Column:
    """The contract's fields as one message value.

    Both forms carry timestamps as milliseconds. `avro` needs the spark-avro package.
    """
    if serializer == "avro":
        from pyspark.sql.avro.functions import to_avro

        return to_avro(F.struct(*contract.fieldNames()), avro_schema(contract))
    if serializer != "json":
        raise ValueError(f"serializer must be 'json' or 'avro', not {serializer!r}")
    fields = [
        F.unix_millis(f.name).alias(f.name) if isinstance(f.dataType, TimestampType)
        else F.col(f.name)
        for f in contract
    ]
    return F.to_json(F.struct(*fields))


def to_messages(
    df: DataFrame,
    contract: StructType = PARTNER_CONTRACT,
    serializer: str = "json",
    key: str = "bp_number",
) -> DataFrame:
    """(key, value) messages; one key always goes to one partition of the topic."""
    value = serialize(contract, serializer)
    return conform(df, contract).select(F.col(key).cast("string").alias("key"), value.alias("value"))


def changed_messages(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    contract: StructType = PARTNER_CONTRACT,
    serializer: str = "json",
    key: str = "bp_number",
    tombstones: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Messages of the entities that are new or changed since the last snapshot.

    `compare` names the fields that matter, so a new processing time alone publishes nothing. With
    `tombstones` an entity that is gone is told by its key and a NULL value, unless another entity
    with that key is left. Records that break the contract stop the job, or are left out when not
    `strict`: see `breaches`.
    """
    changes = change_feed(old, new, keys, compare)
    current = changes.where(F.col("change_type").isin("insert", "update_post"))
    if not strict:
        current = publishable(current, contract)
    messages = to_messages(current, contract, serializer, key)
    if not tombstones:
        return messages
    name = F.col(key).cast("string").alias("key")
    gone = changes.where((F.col("change_type") == "delete") & F.col(key).isNotNull()).select(name)
    gone = gone.distinct().join(new.select(name), "key", "left_anti")
    empty = F.lit(None).cast(messages.schema["value"].dataType)
    return messages.unionByName(gone.withColumn("value", empty))


def publish(
    messages: DataFrame,
    fmt: str,
    options: Mapping[str, str] | None = None,
    checkpoint: str | None = None,
    path: str | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery | None:
    """Send (key, value) messages to `kafka` or files; streams need a checkpoint folder."""
    if not messages.isStreaming:
        writer = messages.write.format(fmt).options(**(options or {})).mode("append")
        writer.save(path) if path else writer.save()
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = messages.writeStream.format(fmt).options(**(options or {}))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start(path) if path else writer.start()
