"""Outbound contracts as Avro record text: read, compared between versions, and messages read by either.

The text is the contract; the `StructType` that Spark needs is made from it. A message is read by the version it was
written with and then brought to the reader's: fields the reader doesn't have are left out, optional ones the writer
didn't have take their default, and types may only widen.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
    LongType, MapType, StringType, StructField, StructType, TimestampType,
)

# Fixed values of the format: its types, and what a writer's type may be read as.
PRIMITIVES = {
    "boolean": BooleanType(), "int": IntegerType(), "long": LongType(), "float": FloatType(),
    "double": DoubleType(), "bytes": BinaryType(), "string": StringType(),
}
LOGICAL = {"date": DateType(), "timestamp-millis": TimestampType(), "timestamp-micros": TimestampType()}
PROMOTIONS = {
    "int": {"bigint", "float", "double"}, "bigint": {"float", "double"}, "float": {"double"},
    "string": {"binary"}, "binary": {"string"},
}


@dataclass(frozen=True)
class Contract:
    """A record: its fields with their types, the defaults of those that have one, and the names they had before."""

    name: str
    fields: StructType
    defaults: Mapping[str, object] = field(default_factory=dict)
    aliases: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


def read_contract(text: str) -> Contract:
    """The contract of an Avro record text. Named types inside it may be used again by name."""
    return _record(json.loads(text), {})


def _record(record: dict, named: dict[str, DataType]) -> Contract:
    if not isinstance(record, dict) or record.get("type") != "record":
        raise ValueError("a contract is an Avro record")
    struct, defaults, aliases = StructType(), {}, {}
    for entry in record["fields"]:
        kind, nullable = _type(entry["type"], named)
        struct = struct.add(StructField(entry["name"], kind, nullable))
        if "default" in entry:
            defaults[entry["name"]] = entry["default"]
        if entry.get("aliases"):
            aliases[entry["name"]] = tuple(entry["aliases"])
    named[record["name"]] = struct
    return Contract(record["name"], struct, defaults, aliases)


def _type(kind, named: dict[str, DataType]) -> tuple[DataType, bool]:
    """The type of Spark, and whether it may be null."""
    if isinstance(kind, list):
        others = [k for k in kind if k != "null"]
        if len(others) != 1:
            raise ValueError(f"a union of null and one type is needed, not {json.dumps(kind)}")
        return _type(others[0], named)[0], len(others) < len(kind)
    if isinstance(kind, str):
        if kind not in PRIMITIVES and kind not in named:
            raise ValueError(f"unknown type {kind!r}")
        return PRIMITIVES.get(kind) or named[kind], False
    logical, inner = kind.get("logicalType"), kind["type"]
    if logical == "decimal":
        return DecimalType(kind["precision"], kind.get("scale", 0)), False
    if logical in LOGICAL:
        return LOGICAL[logical], False
    if inner == "array":
        item, nullable = _type(kind["items"], named)
        return ArrayType(item, nullable), False
    if inner == "map":
        value, nullable = _type(kind["values"], named)
        return MapType(StringType(), value, nullable), False
    if inner == "record":
        return _record(kind, named).fields, False
    if inner == "enum":
        named[kind["name"]] = StringType()
        return StringType(), False
    return _type(inner, named)


def _source(name: str, reader: Contract, writer: Contract) -> str | None:
    """The writer's field that a field of the reader takes its value from."""
    known = set(writer.fields.fieldNames())
    return next((n for n in (name, *reader.aliases.get(name, ())) if n in known), None)


def _fits(old: DataType, new: DataType) -> str | None:
    """Why a value of the old type can't be read as the new one; None if it can."""
    if old == new:
        return None
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        if old.containsNull and not new.containsNull:
            return "its elements may be null"
        return _fits(old.elementType, new.elementType)
    if isinstance(old, MapType) and isinstance(new, MapType):
        if old.valueContainsNull and not new.valueContainsNull:
            return "its values may be null"
        return _fits(old.valueType, new.valueType)
    if isinstance(old, StructType) and isinstance(new, StructType):
        found = breaks(Contract("", old), Contract("", new))
        return "; ".join(f"{name}: {why}" for name, why in found.items()) or None
    if new.simpleString() in PROMOTIONS.get(old.simpleString(), ()):
        return None
    return f"{old.simpleString()} can't be read as {new.simpleString()}"


def breaks(writer: Contract, reader: Contract) -> dict[str, str]:
    """The fields of the reader that messages of the writer can't fill, and why; empty if all can be read."""
    found = {}
    for entry in reader.fields:
        source = _source(entry.name, reader, writer)
        if source is None:
            if entry.name not in reader.defaults and not entry.nullable:
                found[entry.name] = "required, without a default, and not written"
            continue
        written = writer.fields[source]
        if written.nullable and not entry.nullable:
            found[entry.name] = "required, but written as optional"
        elif why := _fits(written.dataType, entry.dataType):
            found[entry.name] = why
    return found


def resolve(rows: DataFrame, writer: Contract, reader: Contract) -> DataFrame:
    """Rows of the writer's fields as those of the reader; raises with all reasons if they can't be."""
    if found := breaks(writer, reader):
        raise ValueError("; ".join(f"{name}: {why}" for name, why in found.items()))
    columns = []
    for entry in reader.fields:
        source = _source(entry.name, reader, writer)
        value = F.col(source) if source else _default(reader.defaults.get(entry.name), entry.dataType)
        columns.append(value.cast(_open(entry.dataType)).alias(entry.name))
    return rows.select(*columns)


def _default(value: object, kind: DataType) -> Column:
    if isinstance(value, (list, dict)):
        return F.from_json(F.lit(json.dumps(value)), kind)
    return F.lit(value)


def _open(kind: DataType) -> DataType:
    """The type with nulls allowed inside, as which values come out of a message."""
    if isinstance(kind, ArrayType):
        return ArrayType(_open(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(kind.keyType, _open(kind.valueType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _open(f.dataType)) for f in kind])
    return kind


def _stored(kind: DataType) -> DataType:
    return LongType() if isinstance(kind, TimestampType) else kind


def read_messages(
    messages: DataFrame, writers: Mapping[int, Contract], reader: Contract, version: str = "version", value: str = "value",
) -> DataFrame:
    """JSON messages of several versions, as `publish.to_messages` writes them, in the reader's fields.

    `version` names the column with the contract each was written by. Each version is one projection of the feed, with the number
    as a filter. Messages of a version that isn't among `writers` are not read as any other: they stop the job.
    """
    known = F.col(version).isin(*writers)
    stop = F.raise_error(F.concat(F.lit("no contract of version "), F.coalesce(F.col(version).cast("string"), F.lit("null"))))
    checked = messages.withColumn(version, F.when(known, F.col(version)).otherwise(stop.cast("int")))
    out = None
    for number, writer in writers.items():
        stored = StructType([StructField(f.name, _stored(f.dataType)) for f in writer.fields])
        parsed = checked.where(F.col(version) == number).select(F.from_json(value, stored).alias("_m"))
        fields = [
            (F.timestamp_millis(f"_m.{f.name}") if isinstance(f.dataType, TimestampType) else F.col(f"_m.{f.name}")).alias(f.name)
            for f in writer.fields
        ]
        rows = resolve(parsed.select(*fields), writer, reader)
        out = rows if out is None else out.unionByName(rows)
    return out
