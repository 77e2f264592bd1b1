"""Joins against the current state of a table."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LookupPolicy:
    """How a key set of known size restricts a table.

    Up to ``pushdown_keys`` keys are sent to the scan as an IN list. Up to
    ``broadcast_keys`` they, and rows looked up one per key, are broadcast; such rows
    take some 100 bytes, so the default is at most a few hundred MB. Beyond that, or
    when the size is not known, both sides are shuffled, unless the optimizer's own size
    estimate says otherwise.
    """

    pushdown_keys: int = 1000
    broadcast_keys: int = 1_000_000

    def pushes(self, size: int | None) -> bool:
        return size is not None and size <= self.pushdown_keys

    def broadcasts(self, size: int | None) -> bool:
        return size is not None and size <= self.broadcast_keys


DEFAULT_POLICY = LookupPolicy()

#: Most partitions of a table that are listed one by one to prune the others.
LISTED_PARTITIONS = 20_000

# Rows without a match are spread over this many filler rows.
_FILLERS = 4096


def part_name(column: str, parts: int = 0, width: int = 0) -> str:
    """Name of a partition column: ``parts`` hashes of ``column``, or ranges ``width`` keys wide.

    Hashes spread any keys evenly, ranges keep neighbours together: change messages mostly
    touch keys that are close to each other, so ranges prune more.
    """
    if (parts > 0) == (width > 0):
        raise ValueError("either a number of hash partitions or a width of ranges")
    return f"{column}_part_{parts}" if parts else f"{column}_range_{width}"


def part_columns(table: DataFrame, column: str | None = None) -> dict[str, Column]:
    """The partition columns of ``table`` (by ``column``) and how their values follow from the key."""
    found = {}
    for name in table.columns:
        if match := re.fullmatch(r"(.+)_(part|range)_(\d+)", name):
            key, kind, n = match.groups()
            if column in (None, key):
                number = F.col(key).cast("bigint")
                value = F.pmod(F.xxhash64(number), F.lit(int(n))) if kind == "part" else F.floor(number / int(n))
                found[name] = value.cast("int")
    return found


def with_part(table: DataFrame, column: str, parts: int = 0, width: int = 0) -> DataFrame:
    """``table`` with the column :func:`part_name`, to be written partitioned by it."""
    name = part_name(column, parts, width)
    return table.withColumn(name, part_columns(table.withColumn(name, F.lit(0)), column)[name])


def in_parts(table: DataFrame, keys: DataFrame, column: str) -> Column | None:
    """Which partitions of ``table`` can hold ``keys``; None where it has none by ``column``, or too many.

    The numbers of these partitions come to the driver, at most :data:`LISTED_PARTITIONS`, so
    the scan lists and reads those directories only.
    """
    for name, value in part_columns(table, column).items():
        wanted = keys.select(column).where(F.col(column).isNotNull()).select(value.alias(name)).distinct()
        numbers = [row[0] for row in wanted.limit(LISTED_PARTITIONS + 1).collect()]
        if len(numbers) <= LISTED_PARTITIONS:
            return F.col(name).isin(numbers)
    return None


def narrow(
    table: DataFrame,
    keys: DataFrame | None,
    column: str,
    size: int | None = None,
    policy: LookupPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Rows of ``table`` whose ``column`` is among ``keys``; all rows without keys.

    ``size`` must be an upper bound of the number of rows of ``keys``, or None when no
    bound is known. A small ``size`` makes this fetch the keys, so they should be cheap to
    compute (persisted, or read from a table). Of a table partitioned by ``column`` (see
    :func:`with_part`) only the partitions of a bounded key set are read.
    """
    plain = [name for name in table.columns if name not in part_columns(table)]
    if keys is None:
        return table.select(*plain)
    keys = keys.select(column)
    if (policy.pushes(size) or policy.broadcasts(size)) and (parts := in_parts(table, keys, column)) is not None:
        table = table.where(parts)
    table = table.select(*plain)
    if policy.pushes(size):
        listed = [row[0] for row in keys.limit(policy.pushdown_keys + 1).collect()]
        if len(listed) <= policy.pushdown_keys:
            return table.where(F.col(column).isin(listed))
    elif policy.broadcasts(size):
        keys = F.broadcast(keys)
    return table.join(keys, column, "left_semi")


def bounded(
    rows: DataFrame, size: int | None, policy: LookupPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Mark ``rows`` for broadcast when ``size``, an upper bound, allows it."""
    return F.broadcast(rows) if policy.broadcasts(size) else rows


def mark_matched(rows: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """Add ``_matched``: whether ``many`` has rows for the key.

    The keys are made distinct on the map side first, so this join never fans out.
    """
    present = many.where(F.col(key).isNotNull()).select(key).distinct()
    present = present.withColumn("_present", F.lit(True))
    joined = rows.join(present, key, "left")
    return joined.withColumn("_matched", F.col("_present").isNotNull()).drop("_present")


def fan_out_left_join(rows: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """``rows LEFT JOIN many USING (key)`` for a ``many`` side of any skew.

    In a left outer join the matches of one key cannot be split over tasks; in an inner
    join adaptive execution can split them. So rows that have no match (known from
    :func:`mark_matched`, called here unless done before) are spread over a fixed number
    of filler rows with NULL columns, and everything is one inner join. Both inputs of
    that join are direct shuffles, as splitting requires.
    """
    if "_matched" not in rows.columns:
        rows = mark_matched(rows, many, key)
    own = [name for name in rows.columns if name != "_matched"]
    extra = [field for field in many.schema.fields if field.name != key]
    kind = rows.schema[key].dataType
    spread = F.pmod(F.xxhash64(*own), F.lit(_FILLERS)).cast(kind)
    left = rows.select(
        *own,
        F.col("_matched").alias("_real"),
        F.when(F.col("_matched"), F.col(key)).otherwise(spread).alias("_on"),
    )
    real = many.where(F.col(key).isNotNull()).select(
        F.lit(True).alias("_real"),
        F.col(key).cast(kind).alias("_on"),
        *(F.col(field.name) for field in extra),
    )
    fillers = rows.sparkSession.range(0, _FILLERS, 1, 1).select(
        F.lit(False).alias("_real"),
        F.col("id").cast(kind).alias("_on"),
        *(F.lit(None).cast(field.dataType).alias(field.name) for field in extra),
    )
    joined = left.join(real.unionByName(fillers), ["_real", "_on"])
    return joined.select(*own, *(field.name for field in extra))
