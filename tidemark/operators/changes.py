"""Upserts and change rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.dedup import latest_by, whole_keys


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    position: Sequence[str] | None = None,
) -> DataFrame:
    """Target and updates as one row per key, the newest by `order`; late updates lose.

    Rows with a NULL in their key are told apart by `position` (by default the `order` columns), so
    each stays, and once only if it comes again. Both sides are shuffled once, after each task has
    cut its rows to the newest per key.
    """
    return latest_by(target.unionByName(updates), whole_keys(keys, position or order), order)


def upsert_touched(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scratch: str,
    position: Sequence[str] | None = None,
) -> DataFrame:
    """The same for few updates against a large stored target with one row per key.

    The newest update per key is written to `scratch` first, so that Spark plans with its true
    size: while that is below the broadcast threshold the target is only scanned, not shuffled,
    and beyond it the joins are ordinary shuffled ones. A target row that meets a newer update is
    replaced by it within one left join, so its rows are read once. Which updates it has no row for is found
    from its key columns alone.
    """
    position = position or order
    latest_by(updates, whole_keys(keys, position), order).write.parquet(scratch)
    newest = target.sparkSession.read.schema(updates.schema).parquet(scratch)
    columns, wanted = target.columns, dict.fromkeys((*keys, *position))
    other = newest.select(F.struct(*columns).alias("_update"), *[F.col(c).alias(f"_other_{c}") for c in wanted])
    met = target.select(F.struct(*columns).alias("_row"), *wanted).join(other, _same(keys, position), "left")
    now = F.struct(*[F.col(f"_update.{c}") for c in order])
    stored = F.struct(*[F.col(f"_row.{c}") for c in order])
    kept = met.select(F.when(F.col("_update").isNotNull() & (now > stored), F.col("_update")).otherwise(F.col("_row")).alias("_row"))
    updated = newest.select(*wanted)
    known = target.select(*[F.col(c).alias(f"_other_{c}") for c in wanted]).join(updated, _same(keys, position), "left_semi")
    added = newest.join(known, _same(keys, position), "left_anti")
    return kept.select("_row.*").unionByName(added.select(*columns))


def _same(keys: Sequence[str], position: Sequence[str]) -> Column:
    same = [F.col(key).eqNullSafe(F.col(f"_other_{key}")) for key in keys]
    return reduce(lambda a, b: a & b, same) & _if_incomplete(
        keys, [F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in position])


def _if_incomplete(keys: Sequence[str], conditions: Sequence[Column], table: str = "") -> Column:
    """True for rows with a whole key, else only where all conditions hold."""
    whole = reduce(lambda a, b: a & b, [F.col(f"{table}{key}").isNotNull() for key in keys])
    return whole | reduce(lambda a, b: a & b, conditions)


def merge_into(
    table: str,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: Sequence[str] | None = None,
) -> None:
    """Upsert in place, for tables whose format supports MERGE.

    A stored row is replaced only by an update that is newer by `order`; rows with an incomplete
    key are told apart as in `upsert`.
    """
    position = position or order
    newest = latest_by(updates, whole_keys(keys, position), order).alias("u")
    same = [F.col(f"{table}.{key}").eqNullSafe(F.col(f"u.{key}")) for key in keys]
    same.append(_if_incomplete(
        keys, [F.col(f"{table}.{c}").eqNullSafe(F.col(f"u.{c}")) for c in position], "u."))
    now = F.struct(*[F.col(f"u.{c}") for c in order])
    stored = F.struct(*[F.col(f"{table}.{c}") for c in order])
    (
        newest.mergeInto(table, reduce(lambda a, b: a & b, same))
        .whenMatched(now > stored).updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )


def _told_apart(df: DataFrame, keys: Sequence[str], place: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame and its key columns, with the place added where a key has a NULL."""
    if not place:
        return df, list(keys)
    return df.withColumn("_place", whole_keys(keys, place)[-1]), [*keys, "_place"]


def pair_changes(pairs: DataFrame, compare: Sequence[str]) -> DataFrame:
    """Change rows out of pairs of structs `_old` and `_new`, where a missing side is null, that differ in some of
    the columns in `compare`."""
    old, new = (F.struct(*[F.col(f"{side}.{c}") for c in compare]) for side in ("_old", "_new"))
    same = old.eqNullSafe(new)
    added, removed = F.col("_old").isNull(), F.col("_new").isNull()
    changed = pairs.where((added != removed) | (~added & ~removed & ~same))

    def change(kind: Column, row: str) -> Column:
        return F.struct(kind.alias("change_type"), F.col(row).alias("row"))

    before = change(F.when(removed, F.lit("delete")).otherwise(F.lit("update_pre")), "_old")
    after = change(F.when(added, F.lit("insert")).otherwise(F.lit("update_post")), "_new")
    rows = F.when(added, F.array(after)).when(removed, F.array(before))
    rows = rows.otherwise(F.array(before, after))
    return changed.select(F.inline(rows)).select("change_type", "row.*")


def change_feed(
    old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None,
    place: Sequence[str] = (),
) -> DataFrame:
    """The change rows between two snapshots with one row per key.

    `change_type` is insert, delete, or the pair update_pre and update_post. Rows equal in all
    `compare` columns (default: every non-key column) are left out; NULL equals NULL. Map columns
    cannot be compared and must be left out of `compare`. Rows with a NULL in their key are told
    apart by the columns of `place`, if given.
    """
    columns = [c for c in new.columns if c not in keys]
    watched = list(compare or columns)
    old, known = _told_apart(old, keys, place)
    new, _ = _told_apart(new, keys, place)

    def side(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*keys, *columns).alias(f"_{name}")
        return df.select(*[F.col(k).alias(f"_{name}_{k}") for k in known], row)

    same = [F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in known]
    pairs = side(old, "old").join(
        side(new, "new"), reduce(lambda a, b: a & b, same), "full_outer"
    )
    return pair_changes(pairs, watched)


def net_changes(
    rows: DataFrame, keys: Sequence[str], number: str, place: Sequence[str] = (),
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Change rows of several consecutive versions, whose `number` they carry, as those from the first to the last.

    Of every key the row before its first change and the row after its last one are kept, in one
    aggregate; a key that ends as it began is left out.
    """
    columns = [c for c in rows.columns if c not in ("change_type", number)]
    rows, known = _told_apart(rows, keys, place)
    before = F.col("change_type").isin("update_pre", "delete")
    at = F.struct(F.col(number), F.when(before, 0).otherwise(1))
    entry = F.struct(before.alias("before"), F.struct(*columns).alias("row"))
    ends = rows.groupBy(*known).agg(F.min_by(entry, at).alias("first"), F.max_by(entry, at).alias("last"))
    pairs = ends.select(
        F.when(F.col("first.before"), F.col("first.row")).alias("_old"),
        F.when(~F.col("last.before"), F.col("last.row")).alias("_new"),
    )
    return pair_changes(pairs, compare or columns)
