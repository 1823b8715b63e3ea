"""Event layer: derived columns and aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import Moment, moment
from tidemark.schemas import METRIC_WINDOW

DIMENSIONS = ("event_type", "source_system", "entity_type")


def convert_amount(
    df: DataFrame,
    rates: Mapping[str, float] | DataFrame | None = None,
    amount: str = "amount",
    currency: str = "currency",
    out: str = "amount_usd",
    order: Sequence[str | Column] = (),
    missing: float | None = 1.0,
) -> DataFrame:
    """`out` is the amount times the rate of its currency.

    Without rates the amount is taken as it is. A mapping becomes a literal lookup, with no join
    at all. A (currency, rate) table, with more columns if need be, is joined; its size decides
    whether Spark broadcasts it. Of several rates for a currency the one highest by `order` counts,
    or the largest rate without an order, so no event is ever multiplied. A currency without a
    rate, or none, takes `missing`: by default the amount is unchanged, with None it is NULL.
    """
    if rates is None or rates == {}:
        return df.withColumn(out, F.col(amount))
    if isinstance(rates, DataFrame):
        code, rate, *_ = rates.columns
        ranked = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], F.col(rate))
        table = rates.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("_currency")).agg(
            F.max_by(F.col(rate), ranked).alias("_rate")
        )
        joined = df.join(table, F.col(currency) == F.col("_currency"), "left")
        factor = F.coalesce("_rate", F.lit(missing).cast("double"))
        return joined.withColumn(out, F.col(amount) * factor).drop("_currency", "_rate")
    pairs = [F.lit(item) for code, rate in rates.items() for item in (code, float(rate))]
    found = F.try_element_at(F.create_map(*pairs), F.col(currency))
    return df.withColumn(out, F.col(amount) * F.coalesce(found, F.lit(missing).cast("double")))


def add_event_columns(df: DataFrame, now: Moment = None, rates=None) -> DataFrame:
    """Date, hour, processing time and the converted amount."""
    derived = df.withColumns({
        "event_date": F.to_date("event_timestamp"),
        "event_hour": F.hour("event_timestamp"),
        "trusted_at": moment(now),
    })
    return convert_amount(derived, rates)


def _distinct(column: str, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


def window_bounds(df: DataFrame) -> DataFrame:
    """The window's start and end as columns of their own."""
    bounds = {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    return df.withColumns(bounds).drop("_window")


def hourly_metrics(
    trusted: DataFrame,
    window: str = METRIC_WINDOW,
    slide: str | None = None,
    now: Moment = None,
    approx: bool = False,
    unique_ids: bool = False,
) -> DataFrame:
    """Counts, distinct counts, sums and times per window, type, source and entity type.

    Tumbling windows also carry their date and hour. Each exact distinct count multiplies the
    rows before the first aggregate; `unique_ids` says the rows were deduplicated by `event_id`,
    so counting the ids is the distinct count and one copy less is made. `approx` uses sketches
    of fixed size instead and needs a single shuffle.
    """
    if slide and not approx:
        size, step = _seconds(window), _seconds(slide)
        if size and step and size >= step:
            return _sliding_metrics(trusted, size, step, unique_ids).withColumn(
                "gold_processed_at", moment(now)
            )
    calendar = () if slide else ("event_date", "event_hour")
    ids = F.count("event_id") if unique_ids else _distinct("event_id", approx)
    spans = F.window("event_timestamp", window, slide)
    metrics = trusted.groupBy(spans.alias("_window"), *DIMENSIONS, *calendar).agg(
        F.count("*").alias("event_count"),
        ids.alias("unique_events"),
        _distinct("entity_id", approx).alias("unique_entities"),
        _distinct("session_id", approx).alias("unique_sessions"),
        F.sum("amount_usd").alias("total_amount_usd"),
        F.avg("amount_usd").alias("avg_amount_usd"),
        F.min("event_timestamp").alias("first_event_at"),
        F.max("event_timestamp").alias("last_event_at"),
    )
    return window_bounds(metrics).withColumn("gold_processed_at", moment(now))


def _seconds(duration: str) -> int | None:
    """Length of a duration such as `15 minutes`; None for other forms."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    number, _, unit = duration.strip().partition(" ")
    length = units.get(unit.strip().lower().removesuffix("s"))
    return int(number) * length if length and number.isdigit() else None


def _sliding_metrics(trusted: DataFrame, size: int, step: int, unique_ids: bool) -> DataFrame:
    """Exact metrics of windows at least as long as their slide.

    Copying each event into every window it falls in, once per distinct count, would shuffle
    windows x counts rows per event. Instead rows are added up per pane (one slide long, or the
    longest stretch that divides both window and slide), with a line for the pane itself and one
    for each distinct value in it. A value counts in the windows its pane belongs to, less those
    that the value's previous pane already counted in, so the distinct counts of overlapping
    windows become plain sums that combine before the last shuffle.
    """
    back = F.expr(f"INTERVAL {size - step} SECONDS")
    one = F.expr(f"INTERVAL {step} SECONDS")
    length = gcd(size, step)

    def begin(time: Column) -> Column:
        """The last begin of a window at or before a pane's time."""
        if length == step:
            return time
        over = F.pmod(F.unix_seconds(time.cast("timestamp")), F.lit(step)).cast("decimal(18, 6)")
        return time - F.make_dt_interval(secs=over)

    counted = {"entity": "entity_id", "session": "session_id"}
    if not unique_ids:
        counted["id"] = "event_id"

    def line(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))

    lines = [line("pane", F.lit(None))] + [line(k, F.col(c)) for k, c in counted.items()]
    of_pane = F.col("kind") == "pane"
    amount = F.when(of_pane, F.col("amount_usd"))
    seen = F.when(of_pane, F.col("event_timestamp"))
    pane = F.window("event_timestamp", f"{length} seconds").start.alias("pane")
    panes = (
        trusted.select(
            pane, *DIMENSIONS, "event_id", "event_timestamp", "amount_usd",
            F.inline(F.array(*lines)),
        )
        .where(of_pane | F.col("value").isNotNull())
        .groupBy("pane", "kind", "value", *DIMENSIONS)
        .agg(
            F.count("*").alias("events"),
            F.count("event_id").alias("ids"),
            F.sum(amount).alias("amount"),
            F.count(amount).alias("amounts"),
            F.min(seen).alias("first"),
            F.max(seen).alias("last"),
        )
    )
    ids = F.sum(F.when(of_pane, F.col("ids"))) if unique_ids else F.count_if(F.col("kind") == "id")
    added = {
        "event_count": F.sum(F.when(of_pane, F.col("events"))),
        "unique_events": ids,
        "unique_entities": F.count_if(F.col("kind") == "entity"),
        "unique_sessions": F.count_if(F.col("kind") == "session"),
        "total_amount_usd": F.sum("amount"),
        "_amounts": F.sum(F.when(of_pane, F.col("amounts"))),
        "first_event_at": F.min("first"),
        "last_event_at": F.max("last"),
    }
    added = [total.alias(name) for name, total in added.items()]
    if size == step:  # windows that don't overlap: each is one pane, and no value counts in two
        windows = panes.groupBy(F.col("pane").alias("window_start"), *DIMENSIONS).agg(*added)
    else:
        previous = F.lag("pane").over(Window.partitionBy("kind", "value", *DIMENSIONS).orderBy("pane"))
        spans = panes.withColumn("counted_up_to", begin(F.when(~of_pane, previous))).withColumns({
            "earliest": F.greatest(begin(F.col("pane") - back), F.col("counted_up_to") + one),
            "latest": begin(F.col("pane")),
        })
        # Lines of the same stretch of windows are added up before they are copied into each window.
        stretches = spans.where("earliest <= latest").groupBy("earliest", "latest", *DIMENSIONS).agg(*added)
        windows = (
            stretches.withColumn("window_start", F.explode(F.sequence("earliest", "latest", one)))
            .groupBy("window_start", *DIMENSIONS)
            .agg(
                *[F.sum(c).alias(c) for c in (
                    "event_count", "unique_events", "unique_entities", "unique_sessions", "total_amount_usd", "_amounts")],
                F.min("first_event_at").alias("first_event_at"),
                F.max("last_event_at").alias("last_event_at"),
            )
        )
    average = F.col("total_amount_usd") / F.nullif(F.col("_amounts"), F.lit(0))
    return windows.select(
        "window_start", *DIMENSIONS, "event_count", "unique_events", "unique_entities", "unique_sessions",
        "total_amount_usd", average.alias("avg_amount_usd"), "first_event_at", "last_event_at",
        (F.col("window_start") + F.expr(f"INTERVAL {size} SECONDS")).alias("window_end"),
    )


def hourly_metrics_basic(trusted: DataFrame, window: str = METRIC_WINDOW) -> DataFrame:
    """Per window, type and source; start and end are the first and last event seen."""
    spans = F.window("event_timestamp", window).alias("window")
    return trusted.groupBy(spans, "event_type", "source_system").agg(
        F.count("*").alias("event_count"),
        F.count_distinct("entity_id").alias("unique_entities"),
        F.min("event_timestamp").alias("window_start"),
        F.max("event_timestamp").alias("window_end"),
    )


def type_source_metrics(events: DataFrame) -> DataFrame:
    """Per type and source over all time; a sum over no amounts is NULL."""
    return events.groupBy("event_type", "source_system").agg(
        F.count("*").alias("event_count"),
        F.count_distinct("entity_id").alias("unique_entities"),
        F.sum("amount_usd").alias("total_amount_usd"),
    )


def entity_daily(trusted: DataFrame, now: Moment = None) -> DataFrame:
    """Daily activity per entity and source, with the sorted set of event types seen."""
    daily = trusted.groupBy("entity_id", "entity_type", "event_date", "source_system").agg(
        F.count("*").alias("total_events"),
        F.array_sort(F.collect_set("event_type")).alias("event_types_seen"),
        F.sum("amount_usd").alias("daily_amount_usd"),
        F.min("event_timestamp").alias("first_activity"),
        F.max("event_timestamp").alias("last_activity"),
    )
    return daily.withColumn("summary_created_at", moment(now))
