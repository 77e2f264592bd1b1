"""The earlier progress job: tombstones, revival of insert dates, last learning only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeep.operators.keys import expand_enrolments, touched_learnings
from martkeep.operators.lookups import DEFAULT_POLICY, LookupPolicy
from martkeep.plans.progress import progress_rows
from martkeep.schema import PROGRESS_COLUMNS, PROGRESS_KEY
from martkeep.sources.tables import SourceTables


def tombstones(keys: DataFrame, learning: DataFrame, like: DataFrame) -> DataFrame:
    """Counted tombstones: one per learning of an enrolment that was withdrawn.

    All columns but the key are NULL (typed as in ``like``) and the flag is 'Y';
    ``n_unconfirmed`` says how many messages asked for it.
    """
    withdrawn = keys.where("n_unconfirmed > 0")
    expanded = expand_enrolments(withdrawn, learning)
    return expanded.select(*_blank(like), "n_unconfirmed")


def last_learnings(
    keys: DataFrame, learning: DataFrame, *, broadcast_keys: bool = False
) -> DataFrame:
    """Per enrolment in ``keys`` the last (highest) of its learnings, with the counts.

    The learnings are aggregated before the join, on the map side, so an enrolment with
    very many of them is no burden.
    """
    enrolments = keys.where("from_enroll").select(
        F.col("seq").alias("enroll_seq"), "n_messages", "n_unconfirmed"
    )
    if broadcast_keys:
        learning = learning.join(F.broadcast(enrolments), "enroll_seq", "left_semi")
        enrolments = F.broadcast(enrolments)
    last = learning.groupBy("enroll_seq").agg(F.max("learning_seq").alias("learning_seq"))
    last = last.withColumnRenamed("enroll_seq", "_owner")
    joined = last.join(enrolments, F.col("_owner") == F.col("enroll_seq"))
    return joined.select("enroll_seq", "learning_seq", "n_messages", "n_unconfirmed")


def earlier_progress_rows(
    keys: DataFrame,
    tables: SourceTables,
    mart: DataFrame,
    as_of: dt.datetime | Column | None = None,
    *,
    last_only: bool = False,
    null_numbers_as_zero: bool = False,
    n_enrolments: int | None = None,
    size: int | None = None,
    policy: LookupPolicy = DEFAULT_POLICY,
    learning: DataFrame | None = None,
) -> DataFrame:
    """One row per touched learning: recomputed, else a tombstone if one was asked for.

    ``keys`` are counted message keys; ``n_enrolments`` and ``size`` bound the enrolments
    and the touched learnings, if known. With ``last_only`` an enrolment message
    recomputes only its last learning; its other learnings can still be tombstoned.
    ``learning`` gives the touched learnings where they are at hand; else they are taken from
    the table, in one pass. Each carries its marks through the joins, so nothing is expanded
    or joined back.
    """
    if learning is None:
        learning = touched_learnings(
            keys, tables.learning, n_enrolments=n_enrolments, n_named=size, policy=policy
        )
    marked = _marked(learning, last_only)
    rows = progress_rows(
        None if size is None else marked.select(PROGRESS_KEY),
        tables,
        mart,
        as_of,
        one_per_key=True,
        insert_dates="revive",
        null_numbers_as_zero=null_numbers_as_zero,
        size=size,
        policy=policy,
        learning=marked,
        keep=("recompute", "tombstone"),
    )
    fresh = F.col("_found") & F.col("recompute")
    blanks = dict(zip(PROGRESS_COLUMNS, _blank(rows), strict=True))
    return rows.where(fresh | F.col("tombstone")).select(
        *(F.when(fresh, F.col(name)).otherwise(blanks[name]).alias(name) for name in PROGRESS_COLUMNS)
    )


def _marked(touched: DataFrame, last_only: bool) -> DataFrame:
    """Touched learnings with ``recompute`` and ``tombstone``."""
    tombstone = F.coalesce(F.col("n_unconfirmed") > 0, F.lit(False))
    if not last_only:
        return touched.withColumn("recompute", F.lit(True)).withColumn("tombstone", tombstone)
    # All learnings of a touched enrolment are here, so the last of these is its last.
    last = touched.where("n_enroll IS NOT NULL").groupBy(F.col("enroll_seq").alias("_owner")).agg(
        F.max("learning_seq").alias("_last")
    )
    joined = touched.join(last, F.col("enroll_seq") == F.col("_owner"), "left")
    is_last = F.coalesce(F.col("n_enroll").isNotNull() & (F.col("learning_seq") == F.col("_last")), F.lit(False))
    return joined.withColumn("recompute", F.col("n_named").isNotNull() | is_last).withColumn("tombstone", tombstone)


def _blank(like: DataFrame) -> list[Column]:
    """Columns of a tombstone, typed as in ``like``."""
    types = {field.name: field.dataType for field in like.schema.fields}
    fixed = {PROGRESS_KEY: F.col(PROGRESS_KEY), "delete_yn": F.lit("Y")}
    return [
        fixed.get(name, F.lit(None).cast(types[name])).alias(name) for name in PROGRESS_COLUMNS
    ]
