"""Business partners: derived columns and one record per partner out of several source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import Moment, compact_date, moment, person_name
from tidemark.operators.dedup import PARTNER_ORDER, latest_by
from tidemark.schemas import BASE_FIELDS, BASE_SOURCE, PARTNER_CONTRACT, SOURCE_FIELDS

PARTNER = ("sap_client", "bp_number")
DELETED = "event_type = 'DELETE'"


def add_bp_columns(df: DataFrame, now: Moment = None) -> DataFrame:
    """Processing time and the two dates; unreadable dates are NULL."""
    return df.withColumns({
        "trusted_processed_at": moment(now),
        "created_date_parsed": compact_date("created_date"),
        "changed_date_parsed": compact_date("changed_date"),
    })


def resolve_name(df: DataFrame, out: str = "unified_name") -> DataFrame:
    """Customer name, else vendor name, else first and last name, else NULL."""
    name = F.coalesce("customer_name", "vendor_name", person_name())
    return df.withColumn(out, name)


def _pivoted(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    base_source: str,
    base_fields: Sequence[str],
    sources: Mapping[str, Mapping[str, str]],
    drop_deleted: bool,
) -> DataFrame:
    """One scan and one shuffle: the newest row of each source is picked inside the aggregate."""

    def newest(source: str, fields: Sequence[Column]) -> Column:
        mine = F.col("source_table") == source
        return F.max_by(F.when(mine, F.struct(*fields)), F.when(mine, F.struct(*order)))

    base = [F.col(f) for f in base_fields] + [F.expr(DELETED).alias("_deleted")]
    picked = [newest(base_source, base).alias("_base")]
    for source, names in sources.items():
        fields = [F.col(column).alias(out) for out, column in names.items()]
        picked.append(newest(source, fields).alias(f"_{source}"))
    merged = rows.groupBy(*keys).agg(*picked).where("_base IS NOT NULL")
    if drop_deleted:
        merged = merged.where("NOT coalesce(_base._deleted, false)")
    # As in an equi-join, a partner whose key has a NULL gets no attributes of other sources.
    known = F.expr(" AND ".join(f"{key} IS NOT NULL" for key in keys))
    attributes = [
        F.when(known, F.col(f"_{source}.{out}")).alias(out)
        for source, names in sources.items()
        for out in names
    ]
    return merged.select(*keys, *[f"_base.{f}" for f in base_fields], *attributes)


def _joined(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    base_source: str,
    base_fields: Sequence[str],
    sources: Mapping[str, Mapping[str, str]],
    drop_deleted: bool,
) -> DataFrame:
    """One branch per source, each cut to its newest row per partner, then left joins."""

    def branch(source: str) -> DataFrame:
        return latest_by(rows.where(F.col("source_table") == source), keys, order)

    merged = branch(base_source)
    if drop_deleted:
        merged = merged.where(f"NOT coalesce({DELETED}, false)")
    merged = merged.select(*keys, *base_fields)
    for source, names in sources.items():
        fields = [F.col(column).alias(out) for out, column in names.items()]
        merged = merged.join(branch(source).select(*keys, *fields), list(keys), "left")
    return merged


def unify(
    trusted: DataFrame,
    now: Moment = None,
    how: str = "pivot",
    keys: Sequence[str] = PARTNER,
    order: Sequence[str] = PARTNER_ORDER,
    base_source: str = BASE_SOURCE,
    base_fields: Sequence[str] = BASE_FIELDS,
    sources: Mapping[str, Mapping[str, str]] = SOURCE_FIELDS,
    drop_deleted: bool = False,
) -> DataFrame:
    """Exactly one record per partner that has a base row.

    Every source gives its newest row, so no join can fan out. `sources` maps a source table to
    the attributes it adds (`{out: column}`); another table is one more entry. `drop_deleted`
    leaves out partners whose newest base row is a deletion. `pivot` and `join` give the same
    rows; `pivot` reads the input once however many sources there are.
    """
    plan = {"pivot": _pivoted, "join": _joined}[how]
    rows = trusted.where(F.col("source_table").isin(base_source, *sources))
    merged = plan(rows, keys, order, base_source, base_fields, sources, drop_deleted)
    return resolve_name(merged).withColumn("gold_processed_at", moment(now))


def entity_json(unified: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """The record as JSON text beside its columns; NULL fields are left out of the text."""
    names = list(fields or PARTNER_CONTRACT.fieldNames())
    return unified.withColumn("entity_json", F.to_json(F.struct(*names)))
