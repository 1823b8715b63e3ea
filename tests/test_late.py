from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import shapes
from tidemark.sources.readers import read_table_stream
from tidemark.streaming import late, versions


def put(spark, folder, hours):
    rows = [(h, None if h is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for h in hours]
    spark.createDataFrame(rows, "h int, event_timestamp timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")


def counts(rows):
    return rows.groupBy(F.window("event_timestamp", "1 hour").start.alias("window_start")).agg(F.count("*").alias("n"), F.max("h").alias("h"))


def run(spark, folder, checkpoint="checkpoint"):
    late.keep_late(read_table_stream(spark, f"{folder}/in"), f"{folder}/split", f"{folder}/{checkpoint}", "10 HOURS")
    return late.refresh_windows(spark, f"{folder}/split", f"{folder}/gold", counts)


def hours(spark, path):
    return sorted(str(r.h) for r in spark.read.parquet(path).collect())


def test_late_rows_are_kept_and_only_their_windows_change(spark, folder):
    put(spark, folder, [0, 5, 30, None])
    run(spark, folder)
    put(spark, folder, [3, 19, 20, 60])
    at = run(spark, folder)
    put(spark, folder, [5, 61, 100])
    last = run(spark, folder)
    assert hours(spark, f"{folder}/split/late") == ["19", "3", "5"]
    assert hours(spark, f"{folder}/split/kept") == ["0", "100", "20", "30", "5", "60", "61", "None"]
    whole = counts(spark.read.parquet(f"{folder}/in")).where("window_start IS NOT NULL")
    gold = versions.read(spark, f"{folder}/gold", last).drop("bucket")
    assert sorted(map(tuple, gold.collect())) == sorted(map(tuple, whole.collect()))
    kept = {b for b, v in last.files.items() if v < last.number}
    assert kept and all(at.files[b] == last.files[b] for b in kept)
    assert run(spark, folder) is None


def test_a_repeated_batch_is_split_the_same_way(spark, folder):
    put(spark, folder, [0, 30])
    run(spark, folder)
    first = hours(spark, f"{folder}/split/kept")
    late.keep_late(read_table_stream(spark, f"{folder}/in"), f"{folder}/split", f"{folder}/again", "10 HOURS")
    assert hours(spark, f"{folder}/split/kept") == first and hours(spark, f"{folder}/split/late") == []


def test_paths_of_unknown_shape(spark):
    rows = [("a", '{"x": 1, "y": {"z": [1, "two", {"deep": null}]}}'), ("a", '{"x": "one", "y": null}'), ("a", "{broken"),
            ("b", "[true, 2.5]"), ("b", None), ("b", '{"<odd>`key": {"k": 1}}'), (None, '"text"')]
    df = spark.createDataFrame(rows, "kind string, details string")
    got = {(r[0], r.path, r.kind): r.n for r in shapes.paths(df.withColumnRenamed("kind", "flow"), "details", ["flow"]).collect()}
    assert got == {
        ("a", "$", "OBJECT"): 2, ("a", "$", "UNREADABLE"): 1, ("a", "$.x", "NUMBER"): 1, ("a", "$.x", "STRING"): 1,
        ("a", "$.y", "OBJECT"): 1, ("a", "$.y", "NULL"): 1, ("a", "$.y.z", "ARRAY"): 1, ("a", "$.y.z[*]", "NUMBER"): 1,
        ("a", "$.y.z[*]", "STRING"): 1, ("a", "$.y.z[*]", "OBJECT"): 1, ("a", "$.y.z[*].deep", "NULL"): 1,
        ("b", "$", "ARRAY"): 1, ("b", "$[*]", "BOOLEAN"): 1, ("b", "$[*]", "NUMBER"): 1, ("b", "$", "NULL"): 1,
        ("b", "$", "OBJECT"): 1, ("b", "$.<odd>`key", "OBJECT"): 1, ("b", "$.<odd>`key.k", "NUMBER"): 1, (None, "$", "STRING"): 1}
    value = shapes.readable(df.where("kind = 'a'"), "details")
    assert sorted(r[0] or 0 for r in value.select(shapes.at_path("_value", "$.x", "int")).collect()) == [0, 0, 1]
    assert shapes.merged_schema(df.where("kind = 'b' AND details LIKE '[%'"), "details").first().schema == "ARRAY<VARIANT>"
    assert shapes.paths(df.limit(0), "details").collect() == []
