"""Sending routed keys to their mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkeep.schema import ENROLL, PROGRESS


def route(keys: DataFrame, target: str, *, compat_fallthrough: bool = False) -> DataFrame:
    """Keys for one mart.

    With ``compat_fallthrough`` the enroll mart receives the progress keys as well
    (read there as enrolment keys), as in the original job.
    """
    if target not in (PROGRESS, ENROLL):
        raise ValueError(f"unknown target {target!r}")
    if compat_fallthrough and target == ENROLL:
        return keys.where(F.col("target").isin(PROGRESS, ENROLL))
    return keys.where(F.col("target") == target)
