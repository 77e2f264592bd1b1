"""Mart stores: keyed tables that accept idempotent upserts of whole batches."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from martkeep.operators.lookups import DEFAULT_POLICY, LookupPolicy
from martkeep.sinks.batch_log import BatchLog, BatchRecord
from martkeep.sinks.jdbc_mart import JdbcMart
from martkeep.sinks.parquet_mart import ParquetMart
from martkeep.sinks.table_mart import TableMart


class MartStore(Protocol):
    """What the batch runner needs from a mart.

    ``snapshot`` shows the mart as it was before batch ``before`` where the store can
    tell, ``apply`` upserts rows that hold each key at most once. Applying a batch
    again replaces what its first run wrote. ``overlay`` upserts outside the stream.
    ``begin`` turns a stream's batch number into the store's own, by which the others go.
    ``state`` says what ``snapshot`` is read from, or None where the store cannot tell: if it
    has changed when the rows are written, another writer came between. ``lookup`` gives
    the snapshot's rows of some keys, at a cost that follows from them, not from the mart.
    """

    def begin(self, spark: SparkSession, run: str, batch_id: int) -> int: ...

    def prepare(self, spark: SparkSession, batch_id: int) -> None: ...

    def state(self, spark: SparkSession, before: int | None = None) -> tuple[str, ...] | None: ...

    def snapshot(self, spark: SparkSession, before: int | None = None) -> DataFrame: ...

    def lookup(
        self,
        spark: SparkSession,
        keys: DataFrame,
        size: int | None,
        before: int | None = None,
        policy: LookupPolicy = DEFAULT_POLICY,
    ) -> DataFrame: ...

    def apply(
        self, rows: DataFrame, batch_id: int, origin: tuple[str, int] | None = None
    ) -> None: ...

    def overlay(self, rows: DataFrame, next_batch: int | None = None) -> None: ...


__all__ = ["BatchLog", "BatchRecord", "JdbcMart", "MartStore", "ParquetMart", "TableMart"]
