"""One record per batch that names what the batch wrote in each mart.

Marts, quarantine and audit are written one after the other. With a log a batch counts only
once its record is there, so readers see all of a batch or nothing of it, also while it is
being written and after a stop between two writes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from martkeep.sinks.files import delete, listed, put_if_absent, read_text

_NAME = re.compile(r"batch-([0-9a-z]+)-(\d+)((?:\.[0-9a-z_]+=\d+)*)\.json$")


def plain(run: str) -> str:
    """A stream's name as part of a file's."""
    return re.sub("[^0-9a-z]", "", run.lower()) or "0"


@dataclass(frozen=True)
class BatchRecord:
    run: str
    batch_id: int
    numbers: Mapping[str, int] = field(default_factory=dict)

    @property
    def of(self) -> tuple[str, int]:
        return self.run, self.batch_id

    @classmethod
    def named(cls, name: str) -> BatchRecord | None:
        """The record in a file of this name, if it is one."""
        if not (match := _NAME.match(name)):
            return None
        numbers = dict(part.split("=") for part in match[3].split(".") if part)
        return cls(match[1], int(match[2]), {mart: int(number) for mart, number in numbers.items()})


@dataclass(frozen=True)
class BatchLog:
    """``path`` is a folder of its own. Names of files say everything, so one listing reads all."""

    path: str

    def record(
        self, spark: SparkSession, run: str, batch_id: int, numbers: Mapping[str, int], **more: object
    ) -> bool:
        """Make batch ``batch_id`` of stream ``run`` count; False if it did already.

        ``numbers`` holds, per mart it wrote to, the mart's own number of the batch.
        """
        named = "".join(f".{mart}={number}" for mart, number in sorted(numbers.items()))
        text = json.dumps({"run": run, "batch_id": batch_id, "numbers": dict(numbers), **more}, sort_keys=True)
        return put_if_absent(spark, f"{self.path}/batch-{plain(run)}-{batch_id:012d}{named}.json", text)

    def records(self, spark: SparkSession) -> list[BatchRecord]:
        names = listed(spark, self.path)
        found = {record.of: record for record in map(BatchRecord.named, names) if record}
        if folded := sorted(name for name in names if name.startswith("folded-")):
            for run, batch_id, numbers in json.loads(read_text(spark, f"{self.path}/{folded[-1]}")):
                found.setdefault((run, batch_id), BatchRecord(run, batch_id, numbers))
        return sorted(found.values(), key=lambda r: r.of)

    def fold(self, spark: SparkSession) -> None:
        """Write all records so far as one file and remove theirs; for a log that has grown long."""
        names = listed(spark, self.path)
        text = json.dumps([[r.run, r.batch_id, dict(r.numbers)] for r in self.records(spark)])
        folds = [name for name in names if name.startswith("folded-")]
        number = max((int(name[7:19]) for name in folds), default=-1) + 1
        if put_if_absent(spark, f"{self.path}/folded-{number:012d}.json", text):
            for name in [*folds, *filter(BatchRecord.named, names)]:
                delete(spark, f"{self.path}/{name}")

    def numbers(self, spark: SparkSession, mart: str) -> set[int]:
        """The mart's numbers of all batches that count."""
        return {record.numbers[mart] for record in self.records(spark) if mart in record.numbers}

    def rows_of(self, spark: SparkSession, path: str) -> DataFrame:
        """What batches that count wrote below ``path`` (quarantine or audit)."""
        counted = {(r.run, r.batch_id) for r in self.records(spark)}
        paths = []
        for run in listed(spark, path):
            if run.startswith("run_id="):
                for batch in listed(spark, f"{path}/{run}"):
                    if batch.startswith("batch_id=") and (plain(run[7:]), int(batch[9:])) in counted:
                        paths.append(f"{path}/{run}/{batch}")
        if not paths:
            return spark.read.option("basePath", path).parquet(path).limit(0)
        return spark.read.option("basePath", path).parquet(*paths)

    def snapshots(self, spark: SparkSession, *marts) -> tuple[DataFrame, ...]:
        """The marts as one and the same set of batches left them."""
        while True:
            before = self.records(spark)
            frames = tuple(mart.snapshot(spark) for mart in marts)
            if self.records(spark) == before:
                return frames
