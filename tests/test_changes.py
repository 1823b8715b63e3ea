import random
import uuid

import re

import pytest
from pyspark.errors import PySparkException

from tidemark.operators.changes import change_feed, merge_into, upsert, upsert_touched

SNAPSHOT = "k string, n int, v string, at string"


def changes(spark, old, new, **options):
    feed = change_feed(spark.createDataFrame(old, SNAPSHOT), spark.createDataFrame(new, SNAPSHOT),
                       ["k", "n"], **options)
    return sorted((tuple(r) for r in feed.collect()), key=repr)


def test_inserts_updates_and_deletes(spark):
    old = [("a", 1, "x", "t0"), ("b", 1, "x", "t0"), ("c", 1, "x", "t0"), ("d", 1, None, "t0")]
    new = [("a", 1, "x", "t0"), ("b", 1, "y", "t0"), ("d", 1, None, "t0"), ("e", 1, "x", "t0")]
    assert changes(spark, old, new) == [
        ("delete", "c", 1, "x", "t0"), ("insert", "e", 1, "x", "t0"),
        ("update_post", "b", 1, "y", "t0"), ("update_pre", "b", 1, "x", "t0"),
    ]


def test_nulls_are_values(spark):
    old = [("a", 1, None, "t0"), ("b", 1, "x", "t0"), (None, None, "x", "t0")]
    new = [("a", 1, "x", "t0"), ("b", 1, None, "t0"), (None, None, "x", "t0")]
    assert changes(spark, old, new) == [
        ("update_post", "a", 1, "x", "t0"), ("update_post", "b", 1, None, "t0"),
        ("update_pre", "a", 1, None, "t0"), ("update_pre", "b", 1, "x", "t0"),
    ]


def test_only_compared_columns_count(spark):
    old, new = [("a", 1, "x", "t0"), ("b", 1, "x", "t0")], [("a", 1, "x", "t1"), ("b", 1, "y", "t1")]
    assert changes(spark, old, new, compare=["v"]) == [
        ("update_post", "b", 1, "y", "t1"), ("update_pre", "b", 1, "x", "t0"),
    ]


@pytest.fixture(params=["union", "touched"])
def merge(request, folder):
    if request.param == "union":
        return upsert
    return lambda *sides: upsert_touched(*sides, f"{folder}/{uuid.uuid4().hex}")


def test_upsert_by_hand(spark, merge):
    rng = random.Random(5)
    keys = [None, "hot", *map(str, range(30))]
    target = {k: (k, rng.randrange(100), f"old-{k}") for k in keys[:20]}
    updates = [(rng.choice(["hot", rng.choice(keys)]), 200 - i if i % 2 else i, f"new-{i}")
               for i in range(200)]
    want = dict(target)
    for u in sorted(updates, key=lambda u: u[1]):
        if u[0] is None or u[0] not in want or u[1] > want[u[0]][1]:
            # A row without a key updates nothing: each stays, once for each order value.
            want[u if u[0] is None else u[0]] = u
    schema = "k string, o int, v string"
    got = merge(spark.createDataFrame(list(target.values()), schema),
                spark.createDataFrame(updates, schema), ["k"], ["o", "v"])
    rows = sorted(((r.k, r.o, r.v) for r in got.collect()), key=repr)
    assert rows == sorted(want.values(), key=repr)
    again = merge(got, spark.createDataFrame(updates, schema), ["k"], ["o", "v"])
    assert sorted(((r.k, r.o, r.v) for r in again.collect()), key=repr) == rows


def test_late_updates_lose(spark, merge):
    schema = "k string, o int, v string"
    target = spark.createDataFrame([("a", 10, "stored")], schema)
    late = spark.createDataFrame([("a", 9, "late"), ("b", 1, "new")], schema)
    kept = {r.k: r.v for r in merge(target, late, ["k"], ["o"]).collect()}
    assert kept == {"a": "stored", "b": "new"}


def test_few_updates_leave_the_target_unshuffled(spark, plan, folder):
    spark.range(1000).selectExpr("cast(id as string) k", "id o", "id v").write.parquet(f"{folder}/target")
    target = spark.read.parquet(f"{folder}/target")
    few = spark.createDataFrame([("7", 5000, -1), ("new", 1, -2), ("8", 0, -3)], "k string, o bigint, v bigint")
    merged = upsert_touched(target, few, ["k"], ["o"], f"{folder}/newest")
    text = plan(merged, "formatted")
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "SinglePartition" not in text
    whole = [at for at in re.findall(r"Location: [^\n]*?/(target|newest)[^\n]*\n(?:[^\n]+\n)*?ReadSchema: [^\n]*v:bigint", text) if at == "target"]
    assert len(whole) <= 1  # whole rows of the target are read once, its keys once more
    assert merged.count() == 1001
    assert {(r.k, r.v) for r in merged.where("v < 0").collect()} == {("7", -1), ("new", -2)}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10b")
    try:
        beyond = upsert_touched(target, few, ["k"], ["o"], f"{folder}/newest2")
        assert "Broadcast" not in plan(beyond)
        assert beyond.count() == 1001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_merge_needs_a_table_format_that_has_it(spark, folder):
    spark.range(3).selectExpr("id k", "id o").write.option("path", folder).saveAsTable("plain_target")
    with pytest.raises(PySparkException):
        merge_into("plain_target", spark.range(1).selectExpr("id k", "9L o"), ["k"], ["o"])
