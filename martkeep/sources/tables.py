"""The five source tables, read anew whenever their current state is wanted.

A batch must see the tables as they are when it runs. A file listing is fixed when a
DataFrame is created, so sources hand out new DataFrames instead of keeping them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkeep.operators.lookups import part_columns
from martkeep.schema import SOURCE_COLUMNS, SOURCE_KEYS, SOURCE_TABLES
from martkeep.sources.jdbc import JdbcOptions, key_splits, range_predicates, read_table


@dataclass(frozen=True)
class SourceTables:
    """Snapshot of the source tables, each reduced to the columns in use.

    Columns by which a table is partitioned by a hash or ranges of a key stay as well (see
    :func:`~martkeep.operators.lookups.with_part`): lookups read the touched partitions only.
    """

    learning: DataFrame
    course_run: DataFrame
    course: DataFrame
    enroll: DataFrame
    learning_subject: DataFrame

    @classmethod
    def of(cls, frames: Mapping[str, DataFrame]) -> SourceTables:
        return cls(
            **{
                name: frames[name].select(*(F.col(c).alias(c) for c in (*columns, *part_columns(frames[name]))))
                for name, columns in SOURCE_COLUMNS.items()
            }
        )

    def key_type(self, table: str, column: str) -> str:
        return getattr(self, table).schema[column].dataType.simpleString()


class TableSource(Protocol):
    def load(self, spark: SparkSession) -> SourceTables: ...


@dataclass(frozen=True)
class FunctionTables:
    """Tables made by a function, for example views over other tables."""

    make: Callable[[SparkSession], SourceTables]

    def load(self, spark: SparkSession) -> SourceTables:
        return self.make(spark)


@dataclass(frozen=True)
class FileTables:
    """One directory or file per table."""

    paths: Mapping[str, str]
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def load(self, spark: SparkSession) -> SourceTables:
        reader = spark.read.format(self.format).options(**self.options)
        return SourceTables.of({name: reader.load(self.paths[name]) for name in SOURCE_COLUMNS})


@dataclass(frozen=True)
class CatalogTables:
    """Tables of the session catalog, by default under their operational names."""

    names: Mapping[str, str] = field(default_factory=lambda: dict(SOURCE_TABLES))

    def load(self, spark: SparkSession) -> SourceTables:
        for name in self.names.values():
            spark.catalog.refreshTable(name)
        return SourceTables.of({key: spark.table(name) for key, name in self.names.items()})


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a database, scanned in key ranges that hold about as many rows each."""

    options: JdbcOptions
    names: Mapping[str, str] = field(default_factory=lambda: dict(SOURCE_TABLES))
    split: bool = True

    def load(self, spark: SparkSession) -> SourceTables:
        frames = {}
        for name, columns in SOURCE_COLUMNS.items():
            key, table = SOURCE_KEYS[name], self.names[name]
            splits = key_splits(spark, self.options, table, key) if self.split else []
            frames[name] = read_table(
                spark, self.options, table, columns, predicates=range_predicates(key, splits)
            )
        return SourceTables.of(frames)
