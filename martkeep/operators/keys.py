"""Which mart keys a set of messages touches.

Messages are first reduced to one counted row per (table, key). That is the only
aggregation over the message volume; it combines on the map side, so a key named by
a third of all messages costs one row per task. Whatever follows works on keys, and
the counts still allow an exact per-message (bag) result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeep.functions.flags import is_unconfirmed
from martkeep.operators.lookups import DEFAULT_POLICY, LookupPolicy, in_parts, part_columns
from martkeep.schema import CONFIRMED_STATUS, ENROLL, ENROLL_TABLE, PROGRESS, SUBJECT_TABLE


def count_messages(messages: DataFrame, confirmed: str = CONFIRMED_STATUS) -> DataFrame:
    """Messages counted by ``kind`` (table, or 'other'), ``reason`` and key ``seq``.

    Adds ``from_enroll, n_messages, n_unconfirmed, first_source_ts_ms, last_source_ts_ms``.
    ``seq`` is NULL for messages that touch no key. Keys and audit both start from here, so
    the messages are aggregated once.
    """
    enroll = F.col("table_name") == ENROLL_TABLE
    known = F.col("table_name").isin(ENROLL_TABLE, SUBJECT_TABLE)
    sound = F.col("reason").isNull() & known
    keyed = messages.select(
        F.when(known, F.col("table_name")).otherwise(F.lit("other")).alias("kind"),
        "reason",
        F.when(sound, F.when(enroll, F.col("enroll_seq")).otherwise(F.col("learning_seq"))).alias("seq"),
        (sound & enroll & is_unconfirmed(F.col("confirm_status_cd"), confirmed)).alias("unconfirmed"),
        F.col("source_ts_ms").try_cast("double").try_cast("bigint").alias("source_ts_ms"),
    )
    # Whether the key is an enrolment's is an aggregate, not a grouping column, so that a
    # filter on it stays above the aggregation: all users of the keys share one scan and
    # one shuffle.
    return keyed.groupBy("kind", "reason", "seq").agg(
        F.max(F.col("kind") == ENROLL_TABLE).alias("from_enroll"),
        F.count(F.lit(1)).alias("n_messages"),
        F.count_if("unconfirmed").alias("n_unconfirmed"),
        F.min("source_ts_ms").alias("first_source_ts_ms"),
        F.max("source_ts_ms").alias("last_source_ts_ms"),
    )


def keys_of(counted: DataFrame) -> DataFrame:
    """Counted keys: ``from_enroll, seq, n_messages, n_unconfirmed, last_source_ts_ms``."""
    names = ("from_enroll", "seq", "n_messages", "n_unconfirmed", "last_source_ts_ms")
    return counted.where("seq IS NOT NULL").select(*names)


def message_keys(messages: DataFrame, confirmed: str = CONFIRMED_STATUS) -> DataFrame:
    """:func:`keys_of` the messages."""
    return keys_of(count_messages(messages, confirmed))


def expand_enrolments(
    keys: DataFrame, learning: DataFrame, *, broadcast_keys: bool = False
) -> DataFrame:
    """Learnings of the enrolments in ``keys``: the counted rows plus ``learning_seq``.

    Both join inputs are direct shuffles of their keys, so adaptive execution can split
    an enrolment that owns a large share of all learnings.
    """
    enrolments = keys.where("from_enroll")
    if broadcast_keys:
        enrolments = F.broadcast(enrolments)
    owned = learning.select(F.col("enroll_seq").alias("_owner"), "learning_seq")
    return owned.join(enrolments, F.col("_owner") == F.col("seq")).drop("_owner")


def touched_learnings(
    keys: DataFrame,
    learning: DataFrame,
    *,
    n_enrolments: int | None = None,
    n_named: int | None = None,
    policy: LookupPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Whole learning rows that ``keys`` touch, by enrolment or by name, in one pass.

    The columns of ``learning`` and ``n_enroll``, ``n_named``: the messages of the row's
    enrolment and those that name the learning itself (NULL for none), and
    ``n_unconfirmed``. What expands enrolments and what looks learnings up need not read the
    table again. ``n_enrolments`` and ``n_named`` bound the two kinds of keys, if known: few
    are sent to the scan as lists, more are broadcast, and partitions that can hold none of
    them are not read. Otherwise the learning rows are the left side of both joins, which
    adaptive execution can split, so an enrolment may own a large share of them.
    """
    enrolments = keys.where("from_enroll").select(
        F.col("seq").alias("_owner"), F.col("n_messages").alias("n_enroll"), "n_unconfirmed"
    )
    named = keys.where("NOT from_enroll").select(
        F.col("seq").alias("_name"), F.col("n_messages").alias("n_named")
    )
    plain = [name for name in learning.columns if name not in part_columns(learning)]
    sides = ((enrolments, "_owner", "enroll_seq", n_enrolments), (named, "_name", "learning_seq", n_named))
    if all(policy.broadcasts(n) for *_, n in sides):
        wanted = [
            in_parts(learning, side.select(F.col(key).alias(column)), column) if n else F.lit(False)
            for side, key, column, n in sides
        ]
        if all(condition is not None for condition in wanted):
            learning = learning.where(wanted[0] | wanted[1])
        if all(policy.pushes(n) for *_, n in sides):
            lists = [[row[0] for row in side.select(key).collect()] if n else [] for side, key, _, n in sides]
            conditions = [F.col(column).isin(found) for (*_, column, _), found in zip(sides, lists) if found]
            learning = learning.where(reduce(Column.__or__, conditions, F.lit(False)))
        enrolments, named = F.broadcast(enrolments), F.broadcast(named)
    rows = learning.select(*plain).join(enrolments, F.col("enroll_seq") == F.col("_owner"), "left")
    rows = rows.join(named, F.col("learning_seq") == F.col("_name"), "left")
    touched = rows.where("_owner IS NOT NULL OR _name IS NOT NULL")
    return touched.select(*plain, "n_enroll", "n_named", "n_unconfirmed")


def keys_by_target(touched: DataFrame) -> DataFrame:
    """``target, seq, n_messages, n_unconfirmed``, one row per key of each mart."""
    return touched.groupBy("target", "seq").agg(
        F.sum("n_messages").alias("n_messages"), F.sum("n_unconfirmed").alias("n_unconfirmed")
    )


def touched_keys(
    keys: DataFrame,
    learning: DataFrame,
    *,
    broadcast_keys: bool = False,
) -> DataFrame:
    """``seq, target, n_messages, n_unconfirmed``: counted keys per mart.

    An enrolment touches its own enroll-mart row and the progress rows of all its
    learnings; a subject message touches one progress row. The result is a counted
    bag: the same progress key may come from several sources. ``n_unconfirmed`` counts
    the messages that withdraw the enrolment (itself, or behind a progress key). ``seq`` is
    as wide as the wider of the two kinds of keys, so none is lost. ``learning`` is the table,
    or what :func:`touched_learnings` took from it.
    """
    own = keys.select(
        "seq",
        F.when(F.col("from_enroll"), F.lit(ENROLL)).otherwise(F.lit(PROGRESS)).alias("target"),
        "n_messages",
        "n_unconfirmed",
    )
    if "n_enroll" in learning.columns:
        expanded = learning.where("n_enroll IS NOT NULL").withColumnRenamed("n_enroll", "n_messages")
    else:
        expanded = expand_enrolments(keys, learning, broadcast_keys=broadcast_keys)
    expanded = expanded.select(
        F.col("learning_seq").alias("seq"),
        F.lit(PROGRESS).alias("target"),
        "n_messages",
        "n_unconfirmed",
    ).where("seq IS NOT NULL")
    return own.unionByName(expanded)


def distinct_keys(routed: DataFrame, name: str, key_type: str | None = None) -> DataFrame:
    """One row per key, called ``name``, with its message counts added up.

    ``key_type`` should be the type of the same column in the tables: the keys are then
    already partitioned the way the join with those tables needs them.
    """
    key: Column = F.col("seq")
    if key_type is not None:
        key = key.cast(key_type)
    return (
        routed.select(key.alias(name), "n_messages", "n_unconfirmed")
        .groupBy(name)
        .agg(F.sum("n_messages").alias("n_messages"), F.sum("n_unconfirmed").alias("n_unconfirmed"))
    )


def expand_counts(
    counted: DataFrame, count: str = "n_messages", copies_per_row: int = 2**18
) -> DataFrame:
    """Write every row as often as its count says; drops the count column.

    Larger counts than ``copies_per_row`` are cut into chunks that are spread over the
    tasks first, so that one row with an extreme count is not written by a single task.
    """
    columns = [name for name in counted.columns if name != count]
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last_chunk = F.expr(f"(`{count}` - 1) DIV {copies_per_row}")
    chunks = counted.where(F.col(count) > 0).select(
        *columns, count, F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("_chunk")
    )
    copies = F.least(
        F.lit(copies_per_row).cast("bigint"), F.col(count) - F.col("_chunk") * copies_per_row
    )
    return (
        chunks.repartition(parts, *columns, "_chunk")
        .select(*columns, F.explode(F.array_repeat(F.lit(True), copies.cast("int"))).alias("_copy"))
        .drop("_copy")
    )
