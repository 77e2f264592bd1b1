"""Soft-delete rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkeep.schema import CONFIRMED_STATUS, COUNTED_COURSE_TYPE


def delete_flag(
    course_type: Column,
    status: Column,
    counted_type: str = COUNTED_COURSE_TYPE,
    confirmed: str = CONFIRMED_STATUS,
) -> Column:
    """'N' for a confirmed enrolment in a counted course, else 'Y' (NULL included)."""
    live = (course_type == counted_type) & (status == confirmed)
    return F.when(live, F.lit("N")).otherwise(F.lit("Y"))


def is_unconfirmed(status: Column, confirmed: str = CONFIRMED_STATUS) -> Column:
    """Whether a message's status withdraws the enrolment; a NULL status does not."""
    return F.coalesce(status != confirmed, F.lit(False))
