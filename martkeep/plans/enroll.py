"""Rows of the enroll mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeep.functions import as_of_column
from martkeep.operators.fold import flag_missing, fold
from martkeep.operators.lookups import DEFAULT_POLICY, LookupPolicy, bounded, narrow
from martkeep.schema import ENROLL_COLUMNS, ENROLL_KEY
from martkeep.sources.tables import SourceTables


def enroll_rows(
    keys: DataFrame | None,
    tables: SourceTables,
    mart: DataFrame,
    as_of: dt.datetime | Column | None = None,
    *,
    course_run_from: str = "mart",
    size: int | None = None,
    policy: LookupPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Enroll-mart rows of ``keys`` (all enrolments if None).

    ``course_run_from="mart"`` takes the course run from the existing mart row, so a
    first-time row has none; ``"enroll"`` takes it from the enrolment.
    """
    if course_run_from not in ("mart", "enroll"):
        raise ValueError("course_run_from must be 'mart' or 'enroll'")
    now = as_of_column(as_of)
    current = narrow(tables.enroll, keys, ENROLL_KEY, size, policy)
    known = mart.select(
        ENROLL_KEY,
        F.col("course_run_seq").alias("_known_run"),
        F.col("insert_date").alias("_known"),
    )
    if policy.pushes(size) or policy.broadcasts(size):
        known = bounded(narrow(known, keys, ENROLL_KEY, size, policy), size, policy)
    rows = current.join(known, ENROLL_KEY, "left")
    run = "_known_run" if course_run_from == "mart" else "course_run_seq"
    return rows.select(
        ENROLL_KEY,
        F.col(run).alias("course_run_seq"),
        F.coalesce("_known", now).alias("insert_date"),
        now.alias("update_date"),
        F.lit("N").alias("delete_yn"),
    )


def merged_enroll(
    keys: DataFrame | None,
    tables: SourceTables,
    mart: DataFrame,
    as_of: dt.datetime | Column | None = None,
    *,
    missing: str = "leave",
    **options,
) -> DataFrame:
    """The whole enroll mart after an upsert of the rows of ``keys``; ``missing`` as for progress."""
    if missing not in ("leave", "flag"):
        raise ValueError("missing must be 'leave' or 'flag'")
    rows = enroll_rows(keys, tables, mart, as_of, **options)
    if missing == "flag":
        known = narrow(mart.select(*ENROLL_COLUMNS), keys, ENROLL_KEY)
        rows = flag_missing(rows, known, ENROLL_KEY, as_of_column(as_of))
    return fold(mart.select(*ENROLL_COLUMNS), rows, ENROLL_KEY)
