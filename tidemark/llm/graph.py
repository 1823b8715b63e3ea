"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def written(df: DataFrame, path: str) -> DataFrame:
    """The frame as files in the shared folder, so nothing before it is computed again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(spark: SparkSession, links: DataFrame, folder: str) -> DataFrame:
    """(node, component): every linked node with the smallest node it can reach.

    `links` has columns a and b, longs; direction, repetition and loops don't matter. Large-star and
    small-star steps in turn until nothing moves, a logarithmic number of rounds. Every step keeps at
    most as many links as there were, whatever the degree of a node, and each round is one table in
    `folder`. Nodes without a link to another one aren't returned.
    """
    state = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{folder}/links-0",
    )
    seen, step = None, 0
    while True:
        mark = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                state.select("v", "v").distinct()
            )
        seen, step = mark, step + 1
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                    F.col("m").alias("v"))
            .distinct()
        )
        state = written(small, f"{folder}/links-{step}")
