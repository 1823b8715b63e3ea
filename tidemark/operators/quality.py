"""Expectations: counted, never dropping a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.functions.columns import passes

Rules = Mapping[str, str]


def rule_counters(rules: Rules) -> list[Column]:
    """The row count and the passing rows of each rule, named by the rule."""
    return [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(passes(rule)).alias(name) for name, rule in rules.items()
    ]


def _expectations(rules: Rules) -> Column:
    """The counters as an array of (name, passed_records, failed_records)."""
    return F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.col(name).alias("passed_records"),
            (F.col("_rows") - F.col(name)).alias("failed_records"),
        )
        for name in rules
    ])


def expectation_counts(
    df: DataFrame, rules: Rules, by: Sequence[str] = (), extra: Sequence[Column] = ()
) -> DataFrame:
    """One row per group with an `expectations` array, the shape the event log stores."""
    counted = df.groupBy(*by).agg(*rule_counters(rules), *extra)
    return counted.withColumn("expectations", _expectations(rules)).drop(*rules)


def measure(df: DataFrame, rules: Rules, by: Sequence[str] = ()) -> DataFrame:
    """(name, passed_records, failed_records) of every rule from a single pass over the rows."""
    return expectation_counts(df, rules, by).select(*by, F.inline("expectations"))


def observe_rules(df: DataFrame, rules: Rules, observation: Observation) -> DataFrame:
    """The same rows; the counts are gathered by whatever action writes them.

    Observe last, right before the write: rows of a stage before a shuffle are counted again
    when a lost executor makes that stage run again.
    """
    return df.observe(observation, *rule_counters(rules))


def observed_counts(observation: Observation, rules: Rules) -> list[tuple[str, int, int]]:
    """(name, passed, failed) of the finished action; waits for it."""
    counted = observation.get
    return [(name, counted[name], counted["_rows"] - counted[name]) for name in rules]


def tag(df: DataFrame, rules: Rules) -> DataFrame:
    """Every row with the names of the rules it breaks."""
    broken = [F.when(~passes(rule), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken)))


def valid_rows(df: DataFrame, rule: str) -> DataFrame:
    """The rows that satisfy one rule."""
    return df.where(F.expr(rule))
