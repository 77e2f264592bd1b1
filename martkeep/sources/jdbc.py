"""Tables behind JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcOptions:
    """Connection of a database and how wide to read from it."""

    url: str
    user: str = ""
    password: str = ""
    driver: str = "com.mysql.cj.jdbc.Driver"
    fetch_size: int = 10_000
    read_partitions: int = 16
    write_partitions: int = 16
    batch_size: int = 10_000

    def connection(self) -> dict[str, str]:
        options = {"url": self.url, "driver": self.driver}
        if self.user:
            options["user"] = self.user
        if self.password:
            options["password"] = self.password
        return options

    def reader_options(
        self, table: str, key: str | None = None, bounds: tuple[int, int] | None = None
    ) -> dict[str, str]:
        """Options of a scan, split into ranges of ``key`` when ``bounds`` are known."""
        options = self.connection() | {"dbtable": table, "fetchsize": str(self.fetch_size)}
        if key and bounds and bounds[0] is not None and bounds[1] > bounds[0]:
            options |= {
                "partitionColumn": key,
                "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1]),
                "numPartitions": str(self.read_partitions),
            }
        return options

    def writer_options(self, table: str) -> dict[str, str]:
        """Options of a bulk write that keeps an existing table's definition."""
        return self.connection() | {
            "dbtable": table,
            "truncate": "true",
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.write_partitions),
        }


def bounds_query(table: str, key: str) -> str:
    return f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"


def key_bounds(
    spark: SparkSession, options: JdbcOptions, table: str, key: str
) -> tuple[int, int]:
    """Smallest and largest key, asked from the database (it answers from the index)."""
    reader = spark.read.format("jdbc").options(**options.connection())
    low, high = reader.option("query", bounds_query(table, key)).load().first()
    return low, high


#: Keys that ranges are cut by, and the most that a sample may bring to the driver.
SAMPLED_KEYS, MOST_SAMPLED = 10_000, 200_000


def sample_query(table: str, key: str, rows: int) -> str | None:
    """About :data:`SAMPLED_KEYS` of ``rows`` keys, by a remainder; None where that is all of them.

    The divisor has no small factors, so that keys which are all even, say, are sampled too.
    """
    step = rows // SAMPLED_KEYS
    if step < 2:
        return None
    while any(step % small == 0 for small in (2, 3, 5, 7)):
        step += 1
    return f"SELECT {key} AS k FROM {table} WHERE MOD({key}, {step}) = 1"


def splits_of(sample: Sequence[int], parts: int) -> list[int]:
    """Keys that cut a sample into ``parts`` of equal size; fewer where the sample has few keys."""
    ordered = sorted(sample)
    cuts = {ordered[len(ordered) * i // parts] for i in range(1, parts)} if ordered else set()
    return sorted(cuts - {ordered[0]} if ordered else cuts)


def range_predicates(key: str, splits: Sequence[int]) -> list[str] | None:
    """A condition per range between ``splits``; together they hold every row once."""
    if not splits:
        return None
    low, high = f"{key} < {splits[0]} OR {key} IS NULL", f"{key} >= {splits[-1]}"
    between = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(splits, splits[1:])]
    return [low, *between, high]


def key_predicates(key: str, values: Sequence, at_once: int = 1000) -> list[str]:
    """Conditions that together name each of ``values``, ``at_once`` a list."""
    numbers = sorted({int(value) for value in values})
    chunks = [numbers[i : i + at_once] for i in range(0, len(numbers), at_once)]
    return [f"{key} IN ({', '.join(map(str, chunk))})" for chunk in chunks]


def key_splits(spark: SparkSession, options: JdbcOptions, table: str, key: str) -> list[int]:
    """Where to cut a table into ranges of about as many rows each.

    From a sample of the keys, which the database takes from the index: equal widths would
    put a dense range into one task. Small tables, whose sample would be all of them, are
    cut at equal widths.
    """
    reader = spark.read.format("jdbc").options(**options.connection())
    counts = f"SELECT MIN({key}) AS low, MAX({key}) AS high, COUNT(*) AS n FROM {table}"
    low, high, n = reader.option("query", counts).load().first()
    parts = options.read_partitions
    text = sample_query(table, key, n)
    sample = []
    if text:
        found = reader.option("query", text).load().limit(MOST_SAMPLED).collect()
        sample = [int(row[0]) for row in found]
    if len(sample) < 10 * parts:
        sample = range(int(low), int(high) + 1) if n and high > low else ()
    return splits_of(sample, parts) if not isinstance(sample, range) else widths_of(sample, parts)


def widths_of(keys: range, parts: int) -> list[int]:
    """Keys that cut a range into ``parts`` of equal width."""
    return sorted({keys.start + len(keys) * i // parts for i in range(1, parts)} - {keys.start})


def read_table(
    spark: SparkSession,
    options: JdbcOptions,
    table: str,
    columns: Sequence[str],
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Scan of ``columns``; column lists and filters put on it are sent to the database.

    Split into ranges of equal width within ``bounds``, or into one task per predicate.
    """
    settings = options.reader_options(table, key, bounds)
    if predicates:
        url = settings.pop("url")
        frame = spark.read.jdbc(url, settings.pop("dbtable"), predicates=list(predicates), properties=settings)
    else:
        frame = spark.read.format("jdbc").options(**settings).load()
    return frame.select(*(F.col(name).alias(name) for name in columns))


def keyed_read(table: DataFrame, key: str, values: Sequence, columns: Sequence[str]) -> DataFrame:
    """``SELECT columns FROM table WHERE key IN (values)`` with the list pushed down.

    For a handful of keys at hand; a DataFrame of keys belongs in a join
    (:func:`martkeep.operators.lookups.narrow`).
    """
    return table.where(F.col(key).isin(*values)).select(*columns)
