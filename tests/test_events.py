import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import events

NOW = "2024-02-01 00:00:00"
START = datetime(2024, 1, 1, 9)
SCHEMA = ("event_id string, event_type string, source_system string, entity_type string, "
          "entity_id string, session_id string, event_timestamp timestamp, amount double, "
          "currency string")


def random_events(seed, n=300, copies=False):
    """A third of the rows belong to one entity; ids, entities and sessions may be missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.34 else rng.choice(["u1", "u2", "u3", "u4", None])
        rows.append((
            rng.choice([f"e{i}", f"e{i // 3}" if copies else f"e{i}", None]),
            rng.choice(["VIEW", "BUY"]), rng.choice(["web", None]), "USER", user,
            rng.choice([f"s{rng.randrange(6)}", None]),
            START + timedelta(seconds=rng.randrange(0, 6 * 3600), microseconds=rng.randrange(10**6)),
            rng.choice([None, 1.25, -2.5, 10.0]), rng.choice(["USD", "EUR", "XXX", None]),
        ))
    return rows


def frame(spark, rows):
    return events.add_event_columns(spark.createDataFrame(rows, SCHEMA), NOW)


def by_hand(rows, size, step, calendar):
    """Window metrics straight from their definition."""
    groups = defaultdict(list)
    epoch = datetime(1970, 1, 1)
    for r in rows:
        since = (r[6] - epoch) // step * step
        k = 0
        while k * step < size:
            start = epoch + since - k * step
            if start <= r[6] < start + size:
                extra = (r[6].date(), r[6].hour) if calendar else ()
                groups[(start, r[1], r[2], r[3]) + extra].append(r)
            k += 1
    out = {}
    for key, rs in groups.items():
        amounts = [r[7] for r in rs if r[7] is not None]
        distinct = [len({r[i] for r in rs if r[i] is not None}) for i in (0, 4, 5)]
        out[key] = (
            len(rs), *distinct,
            round(sum(amounts), 6) if amounts else None,
            round(sum(amounts) / len(amounts), 6) if amounts else None,
            min(r[6] for r in rs), max(r[6] for r in rs), key[0] + size,
        )
    return out


def collected(df, calendar):
    out = {}
    for r in df.collect():
        extra = (r.event_date, r.event_hour) if calendar else ()
        key = (r.window_start, r.event_type, r.source_system, r.entity_type) + extra
        assert key not in out
        rounded = [None if v is None else round(v, 6)
                   for v in (r.total_amount_usd, r.avg_amount_usd)]
        out[key] = (r.event_count, r.unique_events, r.unique_entities, r.unique_sessions,
                    *rounded, r.first_event_at, r.last_event_at, r.window_end)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_tumbling_metrics_by_hand(spark, seed):
    rows = random_events(seed, copies=True)
    got = collected(events.hourly_metrics(frame(spark, rows), now=NOW), True)
    hour = timedelta(hours=1)
    assert got == by_hand(rows, hour, hour, True)


@pytest.mark.parametrize("window,slide,size,step", [
    ("1 hour", "15 minutes", 60, 15), ("1 hour", "20 minutes", 60, 20),
    ("2 hours", "30 minutes", 120, 30), ("50 minutes", "15 minutes", 50, 15),
])
def test_sliding_metrics_by_hand(spark, window, slide, size, step):
    rows = random_events(size + step, copies=True)
    got = collected(events.hourly_metrics(frame(spark, rows), window, slide, NOW), False)
    assert got == by_hand(rows, timedelta(minutes=size), timedelta(minutes=step), False)


def test_counting_unique_ids_needs_no_distinct(spark, plan):
    df = frame(spark, random_events(7))
    exact = collected(events.hourly_metrics(df, now=NOW), True)
    assert collected(events.hourly_metrics(df, now=NOW, unique_ids=True), True) == exact
    sliding = collected(events.hourly_metrics(df, slide="15 minutes", now=NOW), False)
    counted = events.hourly_metrics(df, slide="15 minutes", now=NOW, unique_ids=True)
    assert collected(counted, False) == sliding


def test_estimates_need_one_shuffle(spark, plan):
    df = frame(spark, random_events(8))
    estimate = events.hourly_metrics(df, now=NOW, approx=True)
    assert plan(estimate).count("Exchange hashpartitioning") == 1
    exact = collected(events.hourly_metrics(df, now=NOW), True)
    got = collected(estimate, True)
    assert got.keys() == exact.keys()
    for key, want in exact.items():
        assert got[key][0] == want[0] and got[key][4:] == want[4:]
        for estimated, counted in zip(got[key][1:4], want[1:4]):
            assert estimated == pytest.approx(counted, rel=0.2, abs=1)


def test_basic_metrics_start_and_end_with_the_events_seen(spark):
    rows = random_events(3)
    got = events.hourly_metrics_basic(frame(spark, rows)).collect()
    assert sum(r.event_count for r in got) == len(rows)
    for r in got:
        assert r.window.start <= r.window_start <= r.window_end < r.window.end


def test_entity_days(spark):
    rows = random_events(4)
    got = events.entity_daily(frame(spark, rows), NOW).collect()
    want = defaultdict(list)
    for r in rows:
        want[r[4], r[3], r[6].date(), r[2]].append(r)
    assert len(got) == len(want)
    for r in got:
        rs = want[r.entity_id, r.entity_type, r.event_date, r.source_system]
        amounts = [x[7] for x in rs if x[7] is not None]
        assert r.total_events == len(rs)
        assert r.event_types_seen == sorted({x[1] for x in rs})
        assert r.daily_amount_usd == (pytest.approx(sum(amounts)) if amounts else None)
        assert (r.first_activity, r.last_activity) == (min(x[6] for x in rs), max(x[6] for x in rs))


def test_amounts_are_converted_by_mapping_or_table(spark):
    df = spark.createDataFrame(random_events(5), SCHEMA)
    rates = {"USD": 1.0, "EUR": 1.1}
    mapped = events.convert_amount(df, rates)
    table = spark.createDataFrame(list(rates.items()), "code string, rate double")
    joined = events.convert_amount(df, table)
    assert mapped.exceptAll(joined).isEmpty() and joined.exceptAll(mapped).isEmpty()
    for r in mapped.collect():
        rate = rates.get(r.currency, 1.0)
        assert r.amount_usd == (None if r.amount is None else pytest.approx(r.amount * rate))
    for none in (None, {}):
        same = events.convert_amount(df, none)
        assert same.where(~F.col("amount_usd").eqNullSafe(F.col("amount"))).isEmpty()


def test_derived_columns_have_real_types(spark):
    df = frame(spark, random_events(6, n=3))
    types = dict(df.dtypes)
    assert (types["event_date"], types["event_hour"]) == ("date", "int")
    assert (types["trusted_at"], types["amount_usd"]) == ("timestamp", "double")
