"""A mart in a catalog table whose format supports MERGE."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkeep.operators.lookups import DEFAULT_POLICY, LookupPolicy, narrow


def spark_types(spark: SparkSession, table: str) -> dict:
    return {field.name: field.dataType for field in spark.table(table).schema.fields}


@dataclass(frozen=True)
class TableMart:
    """``table`` must be in a catalog with row-level operations.

    The format decides which files a merge rewrites; partition or cluster the table by
    a hash of ``key`` so that a batch touches few of them.
    """

    table: str
    key: str

    def begin(self, spark: SparkSession, run: str, batch_id: int) -> int:
        return batch_id

    def prepare(self, spark: SparkSession, batch_id: int) -> None:
        """Nothing to do: compaction belongs to the table format."""

    def state(self, spark: SparkSession, before: int | None = None) -> None:
        return None

    def snapshot(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        spark.catalog.refreshTable(self.table)
        return spark.table(self.table)

    def lookup(
        self,
        spark: SparkSession,
        keys: DataFrame,
        size: int | None,
        before: int | None = None,
        policy: LookupPolicy = DEFAULT_POLICY,
    ) -> DataFrame:
        """Mart rows of ``keys``."""
        return narrow(self.snapshot(spark), keys, self.key, size, policy)

    def apply(
        self, rows: DataFrame, batch_id: int, origin: tuple[str, int] | None = None
    ) -> None:
        """Upsert ``rows`` by MERGE. Not run with success so far: no such format is at hand."""
        kinds = spark_types(rows.sparkSession, self.table)
        rows = rows.select(*(F.col(c).cast(kinds[c]).alias(c) if c in kinds else c for c in rows.columns))
        name = self.table.rsplit(".", 1)[-1]
        same_key = F.col(f"{name}.{self.key}") == F.col(f"fresh.{self.key}")
        (
            rows.alias("fresh")
            .mergeInto(self.table, same_key)
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )

    def overlay(self, rows: DataFrame, next_batch: int | None = None) -> None:
        """Upsert ``rows`` outside the stream."""
        self.apply(rows, next_batch or 0)
