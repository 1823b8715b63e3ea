import json

import pytest

from tidemark.operators import monitor

AS_OF = "2024-01-31 00:00:00"


def entry(ts, *expectations, kind="flow_progress", name="flow", out=1, quality=True):
    progress = {"name": name, "status": "COMPLETED",
                "metrics": {"num_output_rows": out, "num_input_rows": 2}}
    if quality:
        progress["data_quality"] = {"expectations": [
            {"name": n, "passed_records": p, "failed_records": f} for n, p, f in expectations]}
    return ts, kind, json.dumps({"flow_progress": progress})


@pytest.fixture
def log(spark):
    rows = [
        entry("2024-01-29 23:59:59", ("a", 5, 7)),
        entry("2024-01-30 00:00:00", ("a", 90, 5), ("b", 1, 0)),
        entry("2024-01-30 10:10:00", ("a", 5, 3), ("empty", 0, 0)),
        entry("2024-01-30 10:50:00", ("a", 0, 4), ("c", 2, 1), out=None),
        entry("2024-01-30 11:00:00", ("a", 100, 100), kind="create_update"),
        entry("2024-01-30 12:00:00", quality=False, name="idle", out=9),
        ("2024-01-30 13:00:00", "flow_progress", "not json"),
        ("2024-01-30 13:00:00", "flow_progress", None),
    ]
    df = spark.createDataFrame(rows, "ts string, event_type string, details string")
    return df.selectExpr("CAST(ts AS TIMESTAMP) AS timestamp", "event_type", "details")


def test_summary_sums_and_orders(log):
    rows = [tuple(r) for r in monitor.dq_summary(log).collect()]
    assert rows == [
        ("empty", 0, 0, 0, None), ("c", 2, 1, 3, 66.67), ("a", 100, 19, 119, 84.03),
        ("b", 1, 0, 1, 100.0),
    ]


def test_alerts_include_unknown_rates(log):
    summary = monitor.dq_summary(log)
    assert {r.expectation_name for r in monitor.alerts(summary).collect()} == {"empty", "c", "a"}
    low = {r.expectation_name for r in monitor.alerts(summary, threshold=84.03).collect()}
    assert low == {"empty", "c"}
    assert not monitor.healthy(summary)
    assert monitor.healthy(summary.where("expectation_name = 'b'"))


def test_trend_covers_the_last_day(log):
    rows = [(str(r.hour_bucket), r.expectation_name, r.failed_records)
            for r in monitor.dq_failure_trend(log, AS_OF).collect()]
    assert rows == [
        ("2024-01-30 10:00:00", "a", 7), ("2024-01-30 10:00:00", "c", 1),
        ("2024-01-30 00:00:00", "a", 5),
    ]
    week = monitor.dq_failure_trend(log, AS_OF, hours=48).collect()
    assert sum(r.failed_records for r in week) == 20


def test_throughput_is_the_latest_updates_with_output(log, plan):
    rows = monitor.flow_throughput(log, n=2)
    assert [(r.flow_name, r.output_rows) for r in rows.collect()] == [("idle", 9), ("flow", 1)]
    assert "TakeOrderedAndProject" in plan(rows)
