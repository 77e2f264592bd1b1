"""Processing time, insert-date rules and the start-time argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

START_TIME_FORMAT = "yyyyMMddHHmmss"


def as_of_column(as_of: dt.datetime | Column | None) -> Column:
    """The instant rows are stamped with; the query's start time unless given.

    ``current_timestamp()`` is constant within one query. A caller that runs several
    queries for one batch should pass one instant to all of them.
    """
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def insert_date(
    known: Column,
    as_of: Column,
    rule: str = "keep",
    present: Column | None = None,
    known_flag: Column | None = None,
) -> Column:
    """First-insert date of a mart row.

    ``keep``: the mart's date if it has one, else ``as_of``. ``revive``: a row that is
    absent or flagged deleted starts anew at ``as_of``; a present row keeps its date,
    NULL included.
    """
    if rule == "keep":
        return F.coalesce(known, as_of)
    if rule == "revive":
        anew = ~present | known_flag.eqNullSafe("Y")
        return F.when(anew, as_of).otherwise(known)
    raise ValueError(f"unknown insert-date rule {rule!r}")


def parse_start_time(text: Column) -> Column:
    """``yyyyMMddHHmmss`` in the session time zone as a timestamp."""
    return F.to_timestamp(text, START_TIME_FORMAT)


def start_time_millis(spark: SparkSession, text: str) -> int:
    """``yyyyMMddHHmmss`` in the session time zone as epoch milliseconds."""
    row = spark.range(1).select(F.unix_millis(parse_start_time(F.lit(text)))).first()
    return int(row[0])
