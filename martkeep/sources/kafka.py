"""Change messages from Kafka."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from martkeep.functions.dates import start_time_millis


@dataclass(frozen=True)
class KafkaOptions:
    """Which topics to read and where to begin.

    Give either ``topics`` (all their partitions) or ``partitions``, a map of topic to
    partition numbers. ``start_time`` (``yyyyMMddHHmmss``, session time zone) takes
    precedence over ``starting``. Both only matter for a query without a checkpoint.
    """

    bootstrap_servers: str
    topics: Sequence[str] = ()
    partitions: Mapping[str, Sequence[int]] = field(default_factory=dict)
    group: str | None = None
    starting: str = "latest"
    start_time: str | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None

    def reader_options(self, spark: SparkSession) -> dict[str, str]:
        if bool(self.topics) == bool(self.partitions):
            raise ValueError("give either topics or partitions")
        options = {"kafka.bootstrap.servers": self.bootstrap_servers}
        if self.partitions:
            chosen = {topic: list(numbers) for topic, numbers in self.partitions.items()}
            options["assign"] = json.dumps(chosen)
        else:
            options["subscribe"] = ",".join(self.topics)
        if self.group:
            options["kafka.group.id"] = self.group
        if self.start_time:
            options["startingTimestamp"] = str(start_time_millis(spark, self.start_time))
            # A partition without newer messages starts at its end.
            options["startingOffsetsByTimestampStrategy"] = "latest"
        else:
            options["startingOffsets"] = self.starting
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options


def read_kafka(spark: SparkSession, options: KafkaOptions) -> DataFrame:
    """Streaming DataFrame with one text column ``value``; message keys are ignored."""
    reader = spark.readStream.format("kafka").options(**options.reader_options(spark))
    return reader.load().selectExpr("CAST(value AS STRING) AS value")
