"""Column helpers shared by the operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from tidemark.schemas import COMPACT_DATE

Moment = str | datetime | Column | None


def moment(now: Moment = None) -> Column:
    """The processing time: the given moment, or the clock when none is given.

    Text such as `2024-02-01 00:00:00` is read in the session time zone.
    """
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now.cast("timestamp")
    if isinstance(now, datetime) and now.tzinfo is None:
        now = now.isoformat(" ")
    return F.lit(now).cast("timestamp")


def passes(rule: str) -> Column:
    """True where the SQL predicate holds; a NULL outcome counts as a failure."""
    return F.coalesce(F.expr(rule), F.lit(False))


def compact_date(column: str | Column) -> Column:
    """`yyyyMMdd` text as a date; unreadable text such as `00000000` becomes NULL."""
    return F.try_to_date(column, COMPACT_DATE)


def person_name(first: str = "first_name", last: str = "last_name") -> Column:
    """First and last name joined by a blank; NULL, not `''`, when both are missing."""
    return F.nullif(F.concat_ws(" ", F.col(first), F.col(last)), F.lit(""))
