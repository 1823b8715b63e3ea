from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException

from tidemark.operators import contracts
from tidemark.operators.contracts import breaks, read_contract, read_messages, resolve
from tidemark.schemas import PARTNER_CONTRACT, avro_schema


def record(*fields, name="R"):
    return read_contract(json.dumps({"type": "record", "name": name, "fields": list(fields)}))


def f(name, kind, **more):
    return {"name": name, "type": kind, **more}


def test_the_contract_comes_back_out_of_its_text():
    assert read_contract(avro_schema()).fields == PARTNER_CONTRACT


def test_types_of_the_format(spark):
    found = record(
        f("a", {"type": "array", "items": ["null", "int"]}), f("m", {"type": "map", "values": "double"}),
        f("e", {"type": "enum", "name": "E", "symbols": ["X"]}), f("e2", "E"), f("d", {"type": "int", "logicalType": "date"}),
        f("n", {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}),
        f("r", ["null", {"type": "record", "name": "In", "fields": [f("x", "long")]}]), f("s", ["string", "null"]), f("again", "In"))
    assert found.fields.simpleString() == (
        "struct<a:array<int>,m:map<string,double>,e:string,e2:string,d:date,n:decimal(9,2),r:struct<x:bigint>,s:string,again:struct<x:bigint>>")
    assert [x.nullable for x in found.fields] == [False] * 6 + [True, True, False]
    for bad in (f("u", ["int", "string"]), f("u", "nothing")):
        with pytest.raises(ValueError):
            record(bad)
    with pytest.raises(ValueError, match="Avro record"):
        read_contract('"string"')


@pytest.mark.parametrize(("old", "new", "why"), [
    (f("x", "int"), f("x", "long"), None),
    (f("x", "long"), f("x", "double"), None),
    (f("x", "string"), f("x", "bytes"), None),
    (f("x", "long"), f("x", "int"), "bigint can't be read as int"),
    (f("x", "string"), f("x", "long"), "string can't be read as bigint"),
    (f("x", "int"), f("x", ["null", "int"]), None),
    (f("x", ["null", "int"]), f("x", "int"), "required, but written as optional"),
    (f("x", "int"), f("y", "int"), "required, without a default, and not written"),
    (f("x", "int"), f("y", "int", default=3), None),
    (f("x", "int"), f("y", ["null", "int"]), None),
    (f("x", "int"), f("y", "long", aliases=["x"]), None),
    (f("x", {"type": "array", "items": "int"}), f("x", {"type": "array", "items": "long"}), None),
    (f("x", {"type": "array", "items": ["null", "int"]}), f("x", {"type": "array", "items": "int"}), "its elements may be null"),
    (f("x", {"type": "map", "values": "long"}), f("x", {"type": "map", "values": "int"}), "bigint can't be read as int"),
])
def test_each_rule_of_a_new_version(spark, old, new, why):
    writer, reader = record(old), record(new)
    assert breaks(writer, reader) == ({} if why is None else {new["name"]: why})
    if why is not None:
        with pytest.raises(ValueError, match=why.split(",")[0]):
            resolve(spark.range(0).selectExpr("id AS x"), writer, reader)


def test_messages_of_two_versions_are_read_by_either(spark):
    old = record(f("k", "string"), f("n", "int"), f("gone", ["null", "string"]), f("at", {"type": "long", "logicalType": "timestamp-millis"}))
    new = record(f("k", "string"), f("n", "long"), f("tags", {"type": "array", "items": "string"}, default=["none"]),
                 f("more", ["null", "string"], default=None), f("when", {"type": "long", "logicalType": "timestamp-millis"}, aliases=["at"]))
    messages = spark.createDataFrame([
        (1, '{"k":"a","n":7,"gone":"x","at":1500}'),
        (2, '{"k":"b","n":5000000000,"tags":["t"],"more":"m","when":2500}')], "version int, value string")
    got = read_messages(messages, {1: old, 2: new}, new)
    assert [c for c, _ in got.dtypes] == ["k", "n", "tags", "more", "when"]
    rows = sorted((r.k, r.n, r.tags, r.more, r.when.microsecond) for r in got.collect())
    assert rows == [("a", 7, ["none"], None, 500000), ("b", 5000000000, ["t"], "m", 500000)]
    with pytest.raises(ValueError, match="n: bigint can't be read as int; at: required"):
        read_messages(messages, {1: old, 2: new}, old)
    with pytest.raises(PySparkException, match="no contract of version 2"):
        read_messages(messages, {1: old}, old).collect()


def test_nested_records_are_compared_field_by_field():
    inner = lambda *fields: {"type": "record", "name": "In", "fields": list(fields)}
    writer = record(f("r", inner(f("x", "int"))))
    assert breaks(writer, record(f("r", inner(f("x", "long"), f("y", ["null", "int"]))))) == {}
    assert breaks(writer, record(f("r", inner(f("x", "string"))))) == {"r": "x: int can't be read as string"}
    assert contracts.PROMOTIONS["float"] == {"double"}
