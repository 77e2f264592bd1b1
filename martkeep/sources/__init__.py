"""Where messages and table state come from."""

from martkeep.sources.jdbc import JdbcOptions, keyed_read, read_table
from martkeep.sources.kafka import KafkaOptions, read_kafka
from martkeep.sources.messages import stream_parquet, stream_text
from martkeep.sources.tables import (
    CatalogTables,
    FileTables,
    JdbcTables,
    SourceTables,
    TableSource,
)

__all__ = [
    "CatalogTables",
    "FileTables",
    "JdbcOptions",
    "JdbcTables",
    "KafkaOptions",
    "SourceTables",
    "TableSource",
    "keyed_read",
    "read_kafka",
    "read_table",
    "stream_parquet",
    "stream_text",
]
