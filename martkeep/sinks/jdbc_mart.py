"""A mart in a database: bulk write to a staging table, then one upsert statement."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martkeep.operators.lookups import DEFAULT_POLICY, LookupPolicy, narrow
from martkeep.sources.jdbc import JdbcOptions, key_bounds, key_predicates, read_table

# Texts of any length, and dates with microseconds that do not end in 2038.
_SQL_TYPES = {
    "int": "INT",
    "bigint": "BIGINT",
    "string": "TEXT",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}
_DIALECT_TYPES = {"mysql": {"timestamp": "DATETIME(6)", "timestamp_ntz": "DATETIME(6)"}}


def create_statement(
    table: str,
    schema: str,
    key: str,
    dialect: str = "mysql",
    without_key: bool = False,
    types: Mapping[str, str] | None = None,
) -> str:
    """DDL of a mart table with its primary key (staging tables have none).

    ``types`` replaces the SQL type of a column, by name, or of a Spark type.
    """
    kinds = _SQL_TYPES | _DIALECT_TYPES.get(dialect, {}) | dict(types or {})
    lines = []
    for column in T.StructType.fromDDL(schema).fields:
        kind = kinds.get(column.name) or kinds[column.dataType.simpleString()]
        if column.name == key:
            kind += " NOT NULL"
        elif dialect == "mysql" and kind.startswith(("TIMESTAMP", "DATETIME")):
            kind += " NULL"
        lines.append(f"{column.name} {kind}")
    if not without_key:
        lines.append(f"PRIMARY KEY ({key})")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(lines)})"


def upsert_statement(
    table: str, staging: str, columns: Sequence[str], key: str, dialect: str = "mysql"
) -> str:
    """One statement that moves the staging rows into the mart, a new row winning.

    A task that is repeated after its commit leaves its rows in the staging table twice;
    they are equal, and the statement reads each once.
    """
    names = ", ".join(columns)
    staging = f"(SELECT DISTINCT {names} FROM {staging})"
    rest = [name for name in columns if name != key]
    if dialect == "mysql":
        updates = ", ".join(f"{name} = VALUES({name})" for name in rest)
        return (
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} s"
            f" ON DUPLICATE KEY UPDATE {updates}"
        )
    if dialect == "merge":
        updates = ", ".join(f"{name} = s.{name}" for name in rest)
        values = ", ".join(f"s.{name}" for name in columns)
        return (
            f"MERGE INTO {table} t USING {staging} s ON t.{key} = s.{key}"
            f" WHEN MATCHED THEN UPDATE SET {updates}"
            f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
        )
    if dialect == "conflict":
        updates = ", ".join(f"{name} = excluded.{name}" for name in rest)
        return (
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} s WHERE true"
            f" ON CONFLICT ({key}) DO UPDATE SET {updates}"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


#: What a column of a mart may be in an existing table, by its type in Spark.
_ACCEPTED = {
    "int": ("int", "bigint"),
    "bigint": ("bigint",),
    "string": ("string",),
    "double": ("double",),
    "timestamp": ("timestamp", "timestamp_ntz"),
    "timestamp_ntz": ("timestamp", "timestamp_ntz"),
}


def schema_problems(found: T.StructType, schema: str) -> list[str]:
    """Why a mart of ``schema`` cannot be kept in a table with the columns ``found``; empty if it can.

    Columns may have any order and case, and there may be more. A narrower number would
    overflow and a decimal without places would drop fractions.
    """
    there = {column.name.lower(): column.dataType.simpleString() for column in found.fields}
    problems = []
    for column in T.StructType.fromDDL(schema).fields:
        kind, want = there.get(column.name.lower()), column.dataType.simpleString()
        if kind is None:
            problems.append(f"no column {column.name}")
        elif kind.split("(")[0] not in (*_ACCEPTED.get(want, (want,)), *(("varchar", "char") if want == "string" else ())):
            problems.append(f"column {column.name} is {kind}, not {want}")
    return problems


@dataclass(frozen=True)
class JdbcMart:
    """``dialect``: ``mysql`` (on duplicate key), ``merge`` or ``conflict``.

    ``types`` sets SQL types by column name or Spark type. ``writer`` names the job that
    writes, and with it its staging table: two jobs on one mart need two names. Up to
    ``lookup_keys`` keys are looked up by lists, which the database answers from its index.
    """

    options: JdbcOptions
    table: str
    schema: str
    key: str
    dialect: str = "mysql"
    types: Mapping[str, str] = field(default_factory=dict)
    writer: str = ""
    lookup_keys: int = 100_000

    @property
    def staging(self) -> str:
        name = re.sub("[^0-9A-Za-z]+", "_", self.writer)
        return f"{self.table}_staging" + (f"_{name}" if name else "")

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(column.name for column in T.StructType.fromDDL(self.schema).fields)

    def begin(self, spark: SparkSession, run: str, batch_id: int) -> int:
        return batch_id

    def create(self, spark: SparkSession) -> None:
        self._execute(
            spark,
            create_statement(self.table, self.schema, self.key, self.dialect, False, self.types),
            create_statement(self.staging, self.schema, self.key, self.dialect, True, self.types),
        )
        self.check(spark)

    def check(self, spark: SparkSession) -> None:
        """Refuse a table that was there before and cannot hold the mart."""
        reader = spark.read.format("jdbc").options(**self.options.reader_options(self.table))
        if problems := schema_problems(reader.load().schema, self.schema):
            raise ValueError(f"table {self.table}: {'; '.join(problems)}")

    def prepare(self, spark: SparkSession, batch_id: int) -> None:
        """Nothing to do: the database keeps itself compact."""

    def snapshot(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The mart as it is now, in ranges of its key; a database keeps no earlier states."""
        bounds = key_bounds(spark, self.options, self.table, self.key)
        return read_table(spark, self.options, self.table, self.columns, self.key, bounds)

    def state(self, spark: SparkSession, before: int | None = None) -> None:
        return None

    def lookup(
        self,
        spark: SparkSession,
        keys: DataFrame,
        size: int | None,
        before: int | None = None,
        policy: LookupPolicy = DEFAULT_POLICY,
    ) -> DataFrame:
        """Mart rows of ``keys``: keyed reads of 1000 keys a task, or beyond ``lookup_keys`` a scan."""
        if size is None or size > self.lookup_keys:
            return narrow(self.snapshot(spark, before), keys, self.key, size, policy)
        values = [row[0] for row in keys.select(self.key).where(f"{self.key} IS NOT NULL").distinct().collect()]
        if not values:
            return spark.createDataFrame([], self.schema)
        predicates = key_predicates(self.key, values)
        return read_table(spark, self.options, self.table, self.columns, predicates=predicates)

    def apply(
        self, rows: DataFrame, batch_id: int, origin: tuple[str, int] | None = None
    ) -> None:
        """Upsert ``rows``. Executors write the staging table, the database merges it."""
        writer = rows.select(*self.columns).write.format("jdbc").mode("overwrite")
        writer.options(**self.options.writer_options(self.staging)).save()
        self._execute(
            rows.sparkSession,
            upsert_statement(self.table, self.staging, self.columns, self.key, self.dialect),
        )

    def overlay(self, rows: DataFrame, next_batch: int | None = None) -> None:
        """Upsert ``rows`` outside the stream."""
        self.apply(rows, next_batch or 0)

    def _execute(self, spark: SparkSession, *statements: str) -> None:
        jvm = spark.sparkContext._jvm
        jvm.java.lang.Class.forName(self.options.driver)
        connection = jvm.java.sql.DriverManager.getConnection(
            self.options.url, self.options.user, self.options.password
        )
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for text in statements:
                statement.executeUpdate(text)
            connection.commit()
        finally:
            connection.close()
