"""Reports on the quality log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import Moment, moment
from tidemark.schemas import ALERT_THRESHOLD, LOG_DETAILS, THROUGHPUT_ROWS, TREND_HOURS


def parse_event_log(log: DataFrame) -> DataFrame:
    """Progress rows of the log with `details` typed: timestamp and the `flow_progress` fields."""
    details = F.from_json("details", LOG_DETAILS)
    progress = log.where("event_type = 'flow_progress'")
    return progress.select("timestamp", details.alias("_d")).select(
        "timestamp", "_d.flow_progress.*"
    )


def expectation_rows(log: DataFrame) -> DataFrame:
    """One row per logged expectation; progress rows without any are skipped."""
    parsed = parse_event_log(log).where("data_quality IS NOT NULL")
    return parsed.select("timestamp", F.inline("data_quality.expectations"))


def _pass_rate(passed: Column, total: Column) -> Column:
    """Percentage with two digits; NULL when nothing was counted."""
    return F.round(passed * F.lit(100.0) / F.nullif(total, F.lit(0)), 2)


def dq_summary(log: DataFrame) -> DataFrame:
    """Passed, failed, total and pass rate per expectation, the worst first."""
    sums = expectation_rows(log).groupBy(F.col("name").alias("expectation_name")).agg(
        F.sum("passed_records").alias("passed_records"),
        F.sum("failed_records").alias("failed_records"),
    )
    total = F.col("passed_records") + F.col("failed_records")
    summary = sums.withColumn("total_records", total)
    rate = _pass_rate(F.col("passed_records"), F.col("total_records"))
    return summary.withColumn("pass_rate_pct", rate).orderBy("pass_rate_pct", "expectation_name")


def dq_failure_trend(log: DataFrame, as_of: Moment = None, hours: int = TREND_HOURS) -> DataFrame:
    """Failures per hour and expectation in the hours before `as_of`, the latest first."""
    since = moment(as_of) - F.make_interval(hours=F.lit(hours))
    recent = expectation_rows(log.where(F.col("timestamp") >= since)).where("failed_records > 0")
    hour = F.date_trunc("hour", "timestamp").alias("hour_bucket")
    trend = recent.groupBy(hour, F.col("name").alias("expectation_name")).agg(
        F.sum("failed_records").alias("failed_records")
    )
    return trend.orderBy(F.desc("hour_bucket"), F.desc("failed_records"), "expectation_name")


def flow_throughput(log: DataFrame, n: int = THROUGHPUT_ROWS) -> DataFrame:
    """The `n` latest flow updates that report output rows."""
    updates = parse_event_log(log).where("metrics.num_output_rows IS NOT NULL")
    return updates.select(
        "timestamp",
        F.col("name").alias("flow_name"),
        F.col("metrics.num_output_rows").alias("output_rows"),
        F.col("metrics.num_input_rows").alias("input_rows"),
        "status",
    ).orderBy(F.desc("timestamp"), "flow_name").limit(n)


def alerts(summary: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Expectations below the threshold, and those whose rate is unknown."""
    return summary.where(F.col("pass_rate_pct").isNull() | (F.col("pass_rate_pct") < threshold))


def healthy(summary: DataFrame, threshold: float = ALERT_THRESHOLD) -> bool:
    """True when nothing raises an alert; stops at the first alert found."""
    return alerts(summary, threshold).isEmpty()
