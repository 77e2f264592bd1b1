"""Full rebuilds and the comparison of a mart with its sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeep.plans.enroll import enroll_rows
from martkeep.plans.progress import progress_rows
from martkeep.sources.tables import SourceTables


def rebuild_progress(
    tables: SourceTables, mart: DataFrame, as_of: dt.datetime | Column | None = None, **options
) -> DataFrame:
    """Progress rows of every learning, one per key; known insert dates are kept."""
    return progress_rows(None, tables, mart, as_of, one_per_key=True, **options)


def rebuild_enroll(
    tables: SourceTables, mart: DataFrame, as_of: dt.datetime | Column | None = None, **options
) -> DataFrame:
    """Enroll-mart rows of every enrolment."""
    return enroll_rows(None, tables, mart, as_of, **options)


def reconcile(
    mart: DataFrame, rebuilt: DataFrame, key: str, compare: Sequence[str]
) -> DataFrame:
    """Rows in which ``mart`` and ``rebuilt`` (both one per key) differ.

    ``side`` is ``rebuild`` or ``mart``; a key whose rows differ appears with both. One
    join by key, instead of two set differences over all columns.
    """
    columns = [key, *compare]
    ours = mart.select(F.col(key).alias("_mart_key"), F.struct(*columns).alias("_mart"))
    theirs = rebuilt.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    joined = ours.join(theirs, F.col("_mart_key") == F.col("_new_key"), "full")
    differing = joined.where(~F.col("_mart").eqNullSafe(F.col("_new")))
    sides = F.array(
        F.struct(F.lit("mart").alias("side"), F.col("_mart").alias("row")),
        F.struct(F.lit("rebuild").alias("side"), F.col("_new").alias("row")),
    )
    return differing.select(F.inline(sides)).where("row IS NOT NULL").select("side", "row.*")
