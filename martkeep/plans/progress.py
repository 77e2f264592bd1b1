"""Rows of the progress mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeep.functions import as_of_column, delete_flag, zero_if_null
from martkeep.operators.fold import flag_missing, fold, stamp, top_subject
from martkeep.operators.lookups import (
    DEFAULT_POLICY,
    LookupPolicy,
    bounded,
    fan_out_left_join,
    mark_matched,
    narrow,
)
from martkeep.schema import PROGRESS_COLUMNS, PROGRESS_KEY, SOURCE_COLUMNS
from martkeep.sources.tables import SourceTables


def courses(tables: SourceTables) -> DataFrame:
    """Course runs with their course: the lookup dimension of both marts."""
    return tables.course_run.join(tables.course, "course_seq").select(
        "course_run_seq", "course_run_nm", "course_id", "course_type_cd"
    )


def of_enrolment(rows: DataFrame, enroll: DataFrame) -> DataFrame:
    """Learning rows with their enrolment, if it is in the same course run."""
    return enroll.join(rows, ["enroll_seq", "course_run_seq"])


def of_course_run(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Learning rows with their course run."""
    return rows.join(runs, "course_run_seq")


def progress_rows(
    keys: DataFrame | None,
    tables: SourceTables,
    mart: DataFrame,
    as_of: dt.datetime | Column | None = None,
    *,
    one_per_key: bool = False,
    insert_dates: str = "keep",
    null_numbers_as_zero: bool = False,
    size: int | None = None,
    policy: LookupPolicy = DEFAULT_POLICY,
    learning: DataFrame | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Progress rows of ``keys`` (all learnings if None) as the tables stand now.

    A learning has one row per subject, or with ``one_per_key`` only its top subject.
    Learnings without a matching enrolment, course run or course have none. ``mart``
    needs ``learning_seq`` and ``insert_date``, and ``delete_yn`` for
    ``insert_dates="revive"``. ``size`` is an upper bound of the number of keys, if one
    is known. ``learning`` gives the touched learning rows where they are at hand (see
    :func:`~martkeep.operators.keys.touched_learnings`); then the table is not read, and
    ``keys`` only restrict the other tables. With ``keep``, columns of ``learning``,
    every one of its rows stays (with ``one_per_key``): these columns are added, and ``_found``
    says whether the joins found the row.

    Order of the joins: everything keyed by learning first, on one partitioning of the
    narrow learning rows; then the enrolment, which compares the course run through the
    learning's own column; the wide course columns last, so no shuffle carries them.
    """
    small = policy.pushes(size) or policy.broadcasts(size)

    def of_keys(table: DataFrame) -> DataFrame:
        # Only where it saves moving the table: the left joins below restrict it anyway,
        # and restricting it by a shuffle first would move it twice.
        return narrow(table, keys if small else None, PROGRESS_KEY, size, policy)

    if learning is None:
        rows = narrow(tables.learning, keys, PROGRESS_KEY, size, policy)
    else:
        rows = learning.select(*SOURCE_COLUMNS["learning"], *keep)
    enroll = narrow(tables.enroll, None, "enroll_seq")
    if policy.pushes(size):
        owners = rows.select("enroll_seq").distinct()
        enroll = narrow(tables.enroll, owners, "enroll_seq", size, policy)
    known = bounded(of_keys(mart), size, policy)
    rows = stamp(rows, known, PROGRESS_KEY, as_of_column(as_of), insert_dates)
    subjects = of_keys(tables.learning_subject)
    if one_per_key:
        rows = rows.join(bounded(top_subject(subjects), size, policy), PROGRESS_KEY, "left")
    else:
        rows = mark_matched(rows, subjects, PROGRESS_KEY)
    # A learning is unique by key, so there are no more rows than keys.
    rows = bounded(rows, size, policy)
    if keep:
        # The learning rows are the left side, so a hot enrolment or course run is split.
        rows = rows.join(enroll.withColumn("_enrolled", F.lit(True)), ["enroll_seq", "course_run_seq"], "left")
        rows = rows.join(courses(tables).withColumn("_running", F.lit(True)), "course_run_seq", "left")
        rows = rows.withColumn("_found", F.col("_enrolled").isNotNull() & F.col("_running").isNotNull())
    else:
        rows = of_enrolment(rows, enroll)
        rows = of_course_run(rows, courses(tables))
    if not one_per_key:
        rows = fan_out_left_join(rows, subjects, PROGRESS_KEY)
    flag = delete_flag(F.col("course_type_cd"), F.col("confirm_status_cd"))
    rows = rows.withColumn("delete_yn", flag)
    if null_numbers_as_zero:
        for name in ("course_run_seq", "learner_seq", "progress_ratio", "learning_subject_seq"):
            rows = rows.withColumn(name, zero_if_null(F.col(name)))
    return rows.select(*PROGRESS_COLUMNS, *([*keep, "_found"] if keep else []))


def merged_progress(
    keys: DataFrame | None,
    tables: SourceTables,
    mart: DataFrame,
    as_of: dt.datetime | Column | None = None,
    *,
    missing: str = "leave",
    **options,
) -> DataFrame:
    """The whole progress mart after an upsert of the rows of ``keys``.

    Mart rows of touched keys that have vanished from the tables stay as they are, or with
    ``missing="flag"`` are flagged as deleted.
    """
    if missing not in ("leave", "flag"):
        raise ValueError("missing must be 'leave' or 'flag'")
    rows = progress_rows(keys, tables, mart, as_of, one_per_key=True, **options)
    if missing == "flag":
        known = mart.select(*PROGRESS_COLUMNS)
        rows = flag_missing(rows, narrow(known, keys, PROGRESS_KEY), PROGRESS_KEY, as_of_column(as_of))
    return fold(mart.select(*PROGRESS_COLUMNS), rows, PROGRESS_KEY)
