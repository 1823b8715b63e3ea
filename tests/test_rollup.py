from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.operators import events, rollup
from tidemark.session import folders
from tidemark.sources.readers import read_table_stream
from tidemark.streaming import jobs, rollup as deltas

def trusted(spark, n, seed=1, start=0):
    rnd = random.Random(seed)
    rows = [
        (f"e{start + i}", rnd.choice(["A", "B", None]), rnd.choice([None, f"u{rnd.randint(0, 40)}"]), "USER", rnd.choice(["web", None]),
         rnd.choice([None, *range(60)]), rnd.choice([None, f"s{rnd.randint(0, 90)}"]), rnd.choice([None, 1.5, -2.0, 0.25]))
        for i in range(n)
    ]
    raw = spark.createDataFrame(rows, "event_id string, event_type string, entity_id string, entity_type string, source_system string, "
                                "minutes int, session_id string, amount_usd double")
    at = F.expr("timestamp'2024-01-30 22:30:00' + make_interval(0, 0, 0, 0, 0, minutes * 7)")
    return raw.withColumn("event_timestamp", at).withColumns({
        "event_date": F.to_date(at), "event_hour": F.hour(at)}).drop("minutes")


KEYS = ["window_start", *rollup.DIMENSIONS]


def exactly(df, *but):
    columns = [c for c in df.columns if c not in ("gold_processed_at", "summary_created_at", *rollup.SKETCHED, *but)]
    return sorted((tuple(r) for r in df.select(*sorted(columns)).collect()), key=repr)


def test_states_of_deliveries_equal_a_recompute_at_every_grain(spark, folder):
    parts = [trusted(spark, 300, seed, 1000 * seed) for seed in range(3)]
    for i, part in enumerate(parts):
        part.write.mode("append").parquet(f"{folder}/table")
        rows = read_table_stream(spark, f"{folder}/table")
        deltas.keep_states(rows, f"{folder}/states", f"{folder}/checkpoint", exact=True)
        deltas.fold_states(spark, f"{folder}/states", deltas.PANES, keep=1)
        if i == 1:
            deltas.fold_states(spark, f"{folder}/states", deltas.ENTITIES, keep=0)
    assert len(folders(spark, f"{folder}/states/{deltas.PANES}")) == 2  # folded ones go with the next fold
    whole = spark.read.parquet(f"{folder}/table")
    states = deltas.read_states(spark, f"{folder}/states", deltas.PANES)
    assert not any("/table" in f for f in states.inputFiles())
    for seconds, slide in ((3600, None), (3600, 900), (7200, 1800), (86400, 86400)):
        got = rollup.metrics(states, seconds, slide)
        want = events.hourly_metrics(whole, f"{seconds} seconds", slide and f"{slide} seconds")
        assert exactly(got) == exactly(want)
        estimates = {tuple(r[k] for k in KEYS): [r[c] for c in rollup.SKETCHED] for r in got.collect()}
        for r in want.collect():
            for a, b in zip(estimates[tuple(r[k] for k in KEYS)], [r[c] for c in rollup.SKETCHED], strict=True):
                assert abs(a - b) <= 0.05 * b + 0.5
    daily = deltas.read_states(spark, f"{folder}/states", deltas.ENTITIES)
    assert exactly(rollup.entity_daily(daily)) == exactly(events.entity_daily(whole))
    for seconds in (3600, 86400):
        counted = deltas.exact_counts(spark, f"{folder}/states", seconds)
        want = whole.where("event_timestamp IS NOT NULL").groupBy(F.window("event_timestamp", f"{seconds} seconds").start.alias("window_start"), *rollup.DIMENSIONS).agg(
            F.count_distinct("entity_id").alias("unique_entities"), F.count_distinct("session_id").alias("unique_sessions"),
        ).where("unique_entities + unique_sessions > 0")
        assert sorted(map(tuple, counted.collect()), key=repr) == sorted(map(tuple, want.select(counted.columns).collect()), key=repr)


def test_a_repeated_batch_counts_once(spark, folder):
    part = trusted(spark, 100)
    part.write.parquet(f"{folder}/table")
    for k in range(2):  # the second checkpoint knows nothing of the first, so batch 0 is written again
        deltas.keep_states(read_table_stream(spark, f"{folder}/table"), f"{folder}/states", f"{folder}/checkpoint{k}", exact=True)
    states = deltas.read_states(spark, f"{folder}/states", deltas.PANES)
    assert exactly(rollup.metrics(states)) == exactly(events.hourly_metrics(part))
    numbers = spark.read.parquet(f"{folder}/states/{deltas.NUMBERS}/entity_id")
    assert numbers.count() == part.select("entity_id").where("entity_id IS NOT NULL").distinct().count()
    assert jobs.batch_ids(spark, f"{folder}/states/{deltas.PANES}") == [0]


def test_counts_by_states_copy_no_rows(spark, plan):
    rows = trusted(spark, 50)
    numbers = rollup.new_numbers(rows.select(F.col("entity_id").alias("value")), None)
    text = plan(rollup.bitmap_counts(rollup.bitmap_states(rows, numbers, "entity_id"), "n", 86400))
    assert "Expand" not in text and "Generate" not in text
    assert "Expand" not in plan(rollup.metrics(rollup.pane_states(rows), 3600))
    assert "Expand" in plan(events.hourly_metrics(rows))
