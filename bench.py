"""Headline timings, one JSON line on stdout.

Each layer is first written as a table, as a deployment would do, so that a query is timed on
the layer it reads and not on making the messages. Batch results go to the `noop` sink, which
computes every row. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set data, cores and repetitions; the
median after one untimed run is reported. With BENCH_EVENT_LOG set to a folder, the shuffle bytes
of a run are added from Spark's event log.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import time
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.operators import changes, dedup, envelope, events, monitor, partners, publish, quality
from tidemark.plans import catalog, flows, pipelines
from tidemark.schemas import EVENT_RULES, PARTNER_RULES
from tidemark.session import build_session, run_dir
from tidemark.sources import feeds
from tidemark.sources.readers import read_table_stream, replay
from tidemark.streaming import aggregates, jobs, latest
from tidemark.streaming.dedup import dedup_stream, with_watermark
from tidemark.streaming.quality import measure_stream

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
EVENT_LOG = os.environ.get("BENCH_EVENT_LOG")
NOW = catalog.NOW


def session():
    conf = {
        "spark__sql__shuffle__partitions": str(CPUS),
        "spark__driver__memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark__ui__showConsoleProgress": "false",
    }
    if EVENT_LOG:
        conf |= {
            "spark__eventLog__enabled": "true",
            "spark__eventLog__dir": f"file://{EVENT_LOG}",
            "spark__eventLog__rolling__enabled": "false",
            "spark__eventLog__compress": "false",
        }
    spark = build_session("tidemark-bench", f"local[{CPUS}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def layers(spark, root):
    """Raw and trusted tables of both flows, the partner snapshots and the quality log."""
    raw = {
        "events_raw": envelope.event_envelope(feeds.event_feed(spark, SF_DIR), NOW),
        "partners_raw": envelope.bp_envelope(feeds.partner_feed(spark, SF_DIR), NOW),
    }

    def keep(name, df):
        # Several files, so that streams and scans have something to spread.
        df.repartition(CPUS).write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    t = {name: keep(name, df) for name, df in raw.items()}
    t["events_parsed"] = keep("events_parsed", flows.parsed_events(t["events_raw"]))
    t["partners_parsed"] = keep("partners_parsed", flows.parsed_partners(t["partners_raw"]))
    t["events_trusted"] = keep("events_trusted", flows.trusted_events(t["events_raw"], NOW))
    t["partners_trusted"] = keep("partners_trusted", flows.bp_trusted(t["partners_raw"], NOW))
    early = F.col("kafka_ingest_timestamp") < F.lit(catalog.PARTNER_SPLIT).cast("timestamp")
    keys, order = catalog.SOURCE_KEYS, dedup.PARTNER_ORDER
    t["snapshot_old"] = keep(
        "snapshot_old", dedup.latest_by(t["partners_parsed"].where(early), keys, order)
    )
    t["snapshot_new"] = keep("snapshot_new", dedup.latest_by(t["partners_parsed"], keys, order))
    t["late_changes"] = keep("late_changes", t["partners_parsed"].where(~early))
    t["log"] = keep("log", feeds.quality_log(t["events_parsed"], t["partners_parsed"]))
    return t


def batch_queries(spark, t):
    keys, order = dedup.PARTNER_KEYS, dedup.PARTNER_ORDER
    source_keys = catalog.SOURCE_KEYS
    return {
        "trusted_events": lambda: flows.trusted_events(t["events_raw"], NOW),
        "events_dedup": lambda: dedup.dedup_events(t["events_parsed"]),
        "hourly_event_metrics": lambda: events.hourly_metrics(
            t["events_trusted"], now=NOW, unique_ids=True),
        "hourly_event_metrics_general": lambda: events.hourly_metrics(t["events_trusted"], now=NOW),
        "hourly_event_metrics_approx": lambda: events.hourly_metrics(
            t["events_trusted"], now=NOW, approx=True),
        "sliding_event_metrics": lambda: events.hourly_metrics(
            t["events_trusted"], slide="15 minutes", now=NOW, unique_ids=True),
        "entity_daily_summary": lambda: events.entity_daily(t["events_trusted"], NOW),
        "type_source_metrics": lambda: events.type_source_metrics(t["events_trusted"]),
        "bp_trusted": lambda: flows.bp_trusted(t["partners_raw"], NOW),
        "bp_latest": lambda: dedup.latest_by(t["partners_parsed"], keys, order),
        "bp_latest_agg": lambda: dedup.latest_by(t["partners_parsed"], keys, order, how="agg"),
        "bp_unified": lambda: partners.unify(t["partners_trusted"], NOW, how="join"),
        "bp_unified_pivot": lambda: partners.unify(t["partners_trusted"], NOW, how="pivot"),
        "publish_messages": lambda: publish.to_messages(
            publish.publishable(partners.unify(t["partners_trusted"], NOW))),
        "bp_upsert": lambda: changes.upsert(
            t["snapshot_old"], t["late_changes"], source_keys, order),
        "bp_upsert_touched": lambda: changes.upsert_touched(
            t["snapshot_old"], t["late_changes"], source_keys, order, run_dir(spark, "bench-newest")),
        "raw_replay": lambda: replay(t["events_raw"], catalog.REPLAY),
        "raw_replay_table": lambda: replay(
            t["events_raw"], spark.createDataFrame(catalog.REPLAY, "p int, a bigint, b bigint")),
        "bp_change_feed": lambda: changes.change_feed(
            t["snapshot_old"], t["snapshot_new"], source_keys),
        "dq_event_counts": lambda: quality.measure(t["events_parsed"], EVENT_RULES),
        "dq_bp_counts": lambda: quality.measure(t["partners_parsed"], PARTNER_RULES),
        "dq_summary": lambda: monitor.dq_summary(t["log"]),
        "flow_throughput": lambda: monitor.flow_throughput(t["log"]),
    }


def stream_queries(spark, root):
    def out(name):
        return run_dir(spark, f"bench-{name}")

    def trusted():
        path = out("trusted")
        raw = read_table_stream(spark, f"{root}/events_raw")
        jobs.run_stream(flows.trusted_events(raw, NOW), f"{path}/table", f"{path}/checkpoint")

    def plain_dedup():
        path = out("dedup")
        parsed = with_watermark(read_table_stream(spark, f"{root}/events_parsed"))
        jobs.run_stream(dedup_stream(parsed), f"{path}/table", f"{path}/checkpoint")

    def counts():
        path = out("counts")
        rows = with_watermark(read_table_stream(spark, f"{root}/events_trusted"))
        metrics = aggregates.hourly_metrics_stream(rows)
        jobs.run_stream(metrics, f"{path}/table", f"{path}/checkpoint", mode="update")

    def newest():
        path = out("latest")
        parsed = read_table_stream(spark, f"{root}/partners_parsed")
        latest.latest_stream(
            parsed, flows.TRUSTED_KEYS, dedup.PARTNER_ORDER, f"{path}/table", f"{path}/checkpoint"
        )

    def folded():
        path = out("fold")
        parsed = read_table_stream(spark, f"{root}/partners_parsed")
        keys, order = flows.TRUSTED_KEYS, dedup.PARTNER_ORDER
        latest.latest_stream(parsed, keys, order, f"{path}/table", f"{path}/checkpoint")
        latest.fold(spark, f"{path}/table", f"{path}/folded", keys, order)

    def upserted():
        path = out("upsert")
        parsed = read_table_stream(spark, f"{root}/events_parsed")
        latest.upsert_stream(
            parsed, ["event_id"], dedup.EVENT_ORDER, f"{path}/checkpoint", f"{path}/table"
        )

    def gold():
        layers = pipelines.Layers(out("gold"))
        raw = read_table_stream(spark, f"{root}/events_raw").withColumn(
            pipelines.INGEST_DAY, F.to_date("kafka_timestamp"))
        measure_stream(
            flows.trusted_events(raw, NOW), EVENT_RULES, "trusted_events", layers.trusted, layers.log,
            layers.checkpoint("trusted"), partition_by=["event_date"],
        )
        pipelines.refresh_event_gold(spark, layers, now=NOW)

    return {
        "bp_latest_folded": folded,
        "events_upsert_stream": upserted,
        "event_gold_refresh": gold,
        "trusted_events_stream": trusted,
        "events_dedup_stream": plain_dedup,
        "hourly_counts_stream": counts,
        "bp_latest_stream": newest,
    }


def shuffle_bytes(folder):
    """Shuffle bytes written per run of a query, from the event log."""
    names, totals = {}, defaultdict(int)
    for path in glob.glob(f"{folder}/*"):
        with open(path) as lines:
            for line in lines:
                event = json.loads(line)
                if event["Event"] == "SparkListenerJobStart":
                    name = (event.get("Properties") or {}).get("spark.job.description", "")
                    for stage in event["Stage IDs"]:
                        names[stage] = name
                elif event["Event"] == "SparkListenerTaskEnd":
                    written = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                    totals[names.get(event["Stage ID"], "")] += written.get("Shuffle Bytes Written", 0)
    runs = RUNS + 1
    return {n.removeprefix("bench:"): b // runs for n, b in totals.items() if n.startswith("bench:")}


def main():
    spark = session()
    root = run_dir(spark, "bench")
    started = time.perf_counter()
    tables = layers(spark, root)
    setup = time.perf_counter() - started

    def run_batch(build):
        build().write.format("noop").mode("overwrite").save()

    work = {n: (lambda b=b: run_batch(b)) for n, b in batch_queries(spark, tables).items()}
    work |= stream_queries(spark, root)
    only = sys.argv[1:]
    seconds, failed = {}, {}
    for name, run in work.items():
        if only and name not in only:
            continue
        spark.sparkContext.setJobDescription(f"bench:{name}")
        times = []
        try:
            run()
            for _ in range(RUNS):
                started = time.perf_counter()
                run()
                times.append(time.perf_counter() - started)
        except Exception as error:  # one query's failure is reported beside the figures of the others
            failed[name] = str(error).partition("\n")[0][:300]
            continue
        seconds[name] = round(statistics.median(times), 3)
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    report = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else SF_DIR,
        "cpus": CPUS,
        "runs": RUNS,
        "setup_sec": round(setup, 3),
    }
    if failed:
        report["failed"] = failed
    spark.stop()
    if EVENT_LOG:
        report["shuffle_bytes"] = shuffle_bytes(EVENT_LOG)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
