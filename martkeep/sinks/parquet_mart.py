"""A keyed mart on plain Parquet, which has no MERGE.

The mart is a full copy bucketed by key, plus one directory of upserted rows per batch
since. A batch therefore writes only its own rows, never the mart. Batches are numbered
by the mart, in the order in which they first came, whatever number a stream gives them:
the directory's name says which batch of which stream it holds, so a repeated batch finds
its number and replaces its own rows, and a stream with a new checkpoint goes on behind
the last. A batch starts from the state before itself. Readers fold the batches into the
full copy by an anti join, which leaves the bucketed copy unshuffled.

Numbers are reserved: a batch's number is a file that only one writer can create, so several
streams may write to one mart. A batch counts where its number says, whichever is written
first, and a higher number wins. Only what lies below the lowest reserved and unwritten
number is folded. A reservation lapses after a while, so that a writer that is gone holds
nothing up.

Once the batches outgrow a share of the full copy they are folded in for good, so the
amount rewritten stays proportional to the amount of change. Batches that are many but small
are first folded into one layer between them and the full copy.
"""

from __future__ import annotations

import hashlib
import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeep.operators.fold import fold, fold_delta
from martkeep.operators.lookups import DEFAULT_POLICY, LookupPolicy, narrow
from martkeep.sinks.batch_log import BatchLog, plain
from martkeep.sinks.files import delete, file_system, folders_with, listed, put_if_absent, read_text, renew

_BUCKET = re.compile(r"_(\d{5,})(?:\..*)?$")  # in the name of a bucket's file
_NAME = re.compile(r"(full|layer|batch)-(\d+)(?:-r(\d+)-b(\d+)|-of-([0-9a-z]+)-(\d+))?$")


def _end(upserts: list[_Version]) -> int:
    """The number of the batch behind the last of ``upserts``."""
    return max(v.number + (v.kind == "batch") for v in upserts)


@dataclass(frozen=True)
class _Version:
    """A batch's upserts, the upserts since the full copy (layer) or the full state before ``number``.

    A state can be written again, after a rebuild; the highest ``revision`` counts.
    """

    kind: str
    number: int
    revision: int
    buckets: int
    path: str
    origin: tuple[str, int] | None = None
    complete: bool = True
    changed: int = 0


@dataclass(frozen=True)
class ParquetMart:
    """``path`` must be reachable from every executor.

    ``buckets`` should make a bucket of the full copy a few hundred MB. The batches are
    folded in when they exceed ``fold_ratio`` times the full copy; ``max_batches`` smaller
    ones become a layer. ``keep`` full copies stay for readers that still use them. With
    ``log`` batches of streams count once that has a record of them under ``name``. A
    reserved number that nothing was written for lapses after ``lapse_hours``.
    """

    path: str
    schema: str
    key: str
    buckets: int = 8
    fold_ratio: float = 0.25
    max_batches: int = 200
    keep: int = 2
    log: BatchLog | None = None
    name: str = "mart"
    lapse_hours: float = 24.0

    def create(self, spark: SparkSession, rows: DataFrame | None = None) -> None:
        """Start the mart with ``rows``, or empty."""
        if rows is None:
            rows = spark.createDataFrame([], self.schema)
        self._write_full(rows, 0)

    def begin(self, spark: SparkSession, run: str, batch_id: int) -> int:
        """The mart's number of batch ``batch_id`` of stream ``run``: its old one if it repeats.

        A new number is reserved by creating its file; whoever comes second takes the next.
        """
        found, origin = self._listed(spark), (plain(run), batch_id)
        text = f"{origin[0]} {batch_id}"
        folded = max((v.number for v in found if v.kind == "full" and v.complete), default=0)
        reserved = self._reserved(spark)
        own = [v.number for v in found if v.origin == origin and v.number >= folded]
        written = {v.number for v in found if v.kind == "batch"}
        for number in own or sorted(n for n in reserved.keys() - written if n >= folded):
            path = self._reservation(number)
            if own or read_text(spark, path) == text:
                put_if_absent(spark, path, text)
                renew(spark, path)
                return number
        number = max(self._next(found), max(reserved, default=-1) + 1)
        while not put_if_absent(spark, self._reservation(number), text):
            number += 1
        return number

    def prepare(self, spark: SparkSession, batch_id: int) -> None:
        """Fold earlier batches into the full copy if they have grown large."""
        before = self._foldable(spark, batch_id)
        full, upserts = self._state(spark, before)
        if not upserts:
            return
        size = self._bytes(spark, [full]) if full else 0
        grown = self._bytes(spark, upserts)
        if grown > self.fold_ratio * size:
            self.compact(spark, before)
        elif sum(v.kind == "batch" for v in upserts) >= self.max_batches:
            self._write_layer(spark, upserts)

    def compact(self, spark: SparkSession, before: int | None = None) -> None:
        """Write a new full copy of the state before batch ``before``.

        Only batches that cannot run again may be folded in: within a streaming batch,
        those before it. Nothing from the lowest open number on is folded.
        """
        before = self._foldable(spark, before)
        _, upserts = self._state(spark, before)
        if upserts:
            self._write_full(self.snapshot(spark, before), _end(upserts))
            self._drop_old(spark)

    def state(self, spark: SparkSession, before: int | None = None) -> tuple[str, ...]:
        """What :meth:`snapshot` reads; differs if another writer's batch has come in."""
        full, versions = self._state(spark, before)
        return tuple(v.path for v in [*([full] if full else []), *versions])

    def vacuum(self, spark: SparkSession, older_than_hours: float | None = None) -> list[str]:
        """Remove what does not count any more; returns the names of what was removed.

        That is: directories whose writing did not end, or that the log has no record of,
        and reserved numbers that nothing complete was written for, each unchanged for
        ``older_than_hours`` (``lapse_hours``, unless given; no batch may take longer than
        that); batches folded into all full copies that are kept; and their reservations.
        """
        hours = self.lapse_hours if older_than_hours is None else older_than_hours
        until = time.time() * 1000 - hours * 3_600_000
        dropped = self._drop_old(spark)
        found = self._listed(spark)
        dead = [v for v in found if not v.complete and v.changed <= until]
        alive = {v.number for v in found if v.kind == "batch" and v not in dead}
        fulls = [v.number for v in found if v.kind == "full" and v.complete]
        for version in dead:
            delete(spark, version.path)
        for number, changed in self._reserved(spark).items():
            if number not in alive and (changed <= until or number < min(fulls, default=0)):
                delete(spark, self._reservation(number))
                dropped.append(f"number {number}")
        return dropped + [v.path.rsplit("/", 1)[-1] for v in dead]

    def snapshot(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The mart before batch ``before``, or as it is now."""
        full, versions = self._state(spark, before)
        base = self._read_full(spark, full)
        if not versions:
            return base
        return fold_delta(base, self._newest(spark, versions).select(*base.columns), self.key)

    def lookup(
        self,
        spark: SparkSession,
        keys: DataFrame,
        size: int | None,
        before: int | None = None,
        policy: LookupPolicy = DEFAULT_POLICY,
    ) -> DataFrame:
        """The snapshot's rows of ``keys``; of the full copy only the buckets that can hold them are read.

        Few keys are sent to the scan as a list, which prunes buckets. For more, up to what
        ``policy`` broadcasts, the numbers of their buckets are computed; they are at most as
        many as the mart has.
        """
        full, versions = self._state(spark, before)
        if full is None or policy.pushes(size) or not policy.broadcasts(size):
            return narrow(self.snapshot(spark, before), keys, self.key, size, policy)
        kind = T.StructType.fromDDL(self.schema)[self.key].dataType
        bucket = F.pmod(F.hash(F.col(self.key).cast(kind)), F.lit(full.buckets))
        wanted = {row[0] for row in keys.select(bucket.alias("bucket")).distinct().collect()}
        if 2 * len(wanted) > full.buckets:
            base = self._read_full(spark, full)
        else:
            base = self._read_buckets(spark, full, wanted)
        base = narrow(base, keys, self.key, size, policy)
        if not versions:
            return base
        upserts = narrow(self._newest(spark, versions), keys, self.key, size, policy)
        return fold_delta(base, upserts.select(*base.columns), self.key)

    def _read_buckets(self, spark: SparkSession, full: _Version, buckets: set[int]) -> DataFrame:
        """The rows of some buckets of a full copy."""
        names = [n for n in listed(spark, full.path) if (m := _BUCKET.search(n)) and int(m[1]) in buckets]
        if not names:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{full.path}/{name}" for name in names])

    def _newest(self, spark: SparkSession, versions: list[_Version]) -> DataFrame:
        """The last upsert of each key, with its batch in ``_batch``."""
        upserts = spark.read.schema(f"{self.schema}, _batch BIGINT").parquet(
            *(version.path for version in versions)
        )
        if len(versions) == 1:
            return upserts
        newest = upserts.groupBy(self.key).agg(F.max("_batch").alias("_batch"))
        return upserts.join(newest, [self.key, "_batch"])

    def apply(
        self, rows: DataFrame, batch_id: int, origin: tuple[str, int] | None = None
    ) -> None:
        """Upsert ``rows``, which hold each key at most once, as the mart's batch ``batch_id``.

        ``origin`` is the stream and its own number, as given to :meth:`begin`.
        """
        spark = rows.sparkSession
        suffix = f"-of-{plain(origin[0])}-{origin[1]}" if origin else ""
        lapsed = time.time() * 1000 - self.lapse_hours * 3_600_000
        if origin and self._reserved(spark).get(batch_id, 0) < lapsed:
            raise RuntimeError(f"number {batch_id} of {self.path} has lapsed; begin the batch again")
        fields = T.StructType.fromDDL(self.schema).fields
        typed = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))
        typed.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/batch-{batch_id:012d}{suffix}")

    def overlay(self, rows: DataFrame, next_batch: int | None = None) -> None:
        """Upsert ``rows`` into a new full copy of the state before batch ``next_batch``.

        For rows of any number, such as a rebuild, while no batch is running. Without a
        number all batches so far count.
        """
        spark = rows.sparkSession
        if next_batch is None:
            next_batch = self._next(self._listed(spark))
        mart = self.snapshot(spark, before=next_batch)
        self._write_full(fold(mart, rows, self.key), next_batch)
        self._drop_old(spark)

    def versions(self, spark: SparkSession) -> list[_Version]:
        """Completely written directories that count, oldest first."""
        found = self._listed(spark)
        complete = [v for v in found if v.complete]
        if any(v.kind == "full" for v in found) and not any(v.kind == "full" for v in complete):
            raise RuntimeError(f"{self.path} holds no complete copy of the mart")
        return complete

    def _listed(self, spark: SparkSession) -> list[_Version]:
        """All directories, also of writes that did not end: one listing and one search."""
        names = {name: changed for name, changed in listed(spark, self.path).items() if _NAME.match(name)}
        done = folders_with(spark, self.path, "_SUCCESS") if names else set()
        counted = self.log.numbers(spark, self.name) if self.log and names else None
        found = []
        for name, changed in names.items():
            match = _NAME.match(name)
            number, revision, buckets = (int(text or 0) for text in match.groups()[1:4])
            origin = (match[5], int(match[6])) if match[5] else None
            complete = name in done and (counted is None or origin is None or number in counted)
            path = f"{self.path}/{name}"
            found.append(_Version(match[1], number, revision, buckets, path, origin, complete, changed))
        return sorted(found, key=lambda v: (v.number, v.revision))

    def _reservation(self, number: int) -> str:
        return f"{self.path}/_numbers/{number:012d}"

    def _reserved(self, spark: SparkSession) -> dict[int, int]:
        """Reserved numbers and when."""
        names = listed(spark, f"{self.path}/_numbers")
        return {int(name): changed for name, changed in names.items() if name.isdigit()}

    def _foldable(self, spark: SparkSession, before: int | None) -> int | None:
        """``before``, or the lowest number below it that someone is still to write."""
        complete = {v.number for v in self._listed(spark) if v.kind == "batch" and v.complete}
        since = time.time() * 1000 - self.lapse_hours * 3_600_000
        open_numbers = [n for n, at in self._reserved(spark).items() if n not in complete and at > since]
        fulls = [v.number for v in self._listed(spark) if v.kind == "full" and v.complete]
        open_numbers = [n for n in open_numbers if n >= max(fulls, default=0)]
        if before is not None:
            open_numbers.append(before)
        return min(open_numbers, default=None)

    @staticmethod
    def _next(found: list[_Version]) -> int:
        """A full copy is the state before its number, so that number may still be free."""
        return max((v.number + (v.kind == "batch") for v in found), default=0)

    def _state(
        self, spark: SparkSession, before: int | None
    ) -> tuple[_Version | None, list[_Version]]:
        """Newest full copy of a state before batch ``before``; the layer and batches since."""
        versions = self.versions(spark)
        last = max((v.number for v in versions), default=0) + 1 if before is None else before
        fulls = [v for v in versions if v.kind == "full" and v.number <= last]
        full = fulls[-1] if fulls else None
        first = full.number if full else 0
        layers = [v for v in versions if v.kind == "layer" and first < v.number <= last]
        layer = layers[-1:]
        first = layer[0].number if layer else first
        batches = [v for v in versions if v.kind == "batch" and first <= v.number < last]
        return full, layer + batches

    def _read_full(self, spark: SparkSession, full: _Version | None) -> DataFrame:
        if full is None:
            return spark.createDataFrame([], self.schema)
        name = self._table_name(full.number, full.revision)
        quoted = full.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({self.schema}) USING parquet"
            f" CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {full.buckets} BUCKETS"
            f" LOCATION '{quoted}'"
        )
        return spark.table(name)

    def _write_full(self, rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        same = [v for v in self._listed(spark) if v.kind == "full" and v.number == number]
        revision = same[-1].revision + 1 if same else 0
        while not put_if_absent(spark, f"{self.path}/_numbers/full-{number}-{revision}", ""):
            revision += 1
        path = f"{self.path}/full-{number:012d}-r{revision}-b{self.buckets}"
        name = self._table_name(number, revision)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        fields = T.StructType.fromDDL(self.schema).fields
        typed = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))
        (
            typed.repartition(self.buckets, self.key)
            .sortWithinPartitions(self.key)
            .write.format("parquet")
            .mode("overwrite")
            .bucketBy(self.buckets, self.key)
            .sortBy(self.key)
            .option("path", path)
            .saveAsTable(name)
        )

    def _write_layer(self, spark: SparkSession, upserts: list[_Version]) -> None:
        """Fold batches into one layer; what an older layer holds is dropped."""
        number = _end(upserts)
        if not put_if_absent(spark, f"{self.path}/_numbers/layer-{number}", ""):
            return  # another writer folds them
        rows = self._newest(spark, upserts).select(
            *T.StructType.fromDDL(self.schema).names, "_batch"
        )
        rows.write.mode("overwrite").parquet(f"{self.path}/layer-{number:012d}")
        layers = [v for v in upserts if v.kind == "layer"]
        for version in self.versions(spark) if layers else ():
            old = version.kind == "batch" and version.number < layers[0].number
            if old or (version.kind == "layer" and version.number < layers[0].number):
                delete(spark, version.path)

    def _drop_old(self, spark: SparkSession) -> list[str]:
        versions = self.versions(spark)
        fulls = [v for v in versions if v.kind == "full"]
        if len(fulls) <= self.keep:
            return []
        kept = fulls[-self.keep :]
        folded = [
            v for v in versions if v.kind != "full" and v.number + (v.kind == "batch") <= kept[0].number
        ]
        for version in fulls[: -self.keep]:
            name = self._table_name(version.number, version.revision)
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for version in [*fulls[: -self.keep], *folded]:
            delete(spark, version.path)
        return [v.path.rsplit("/", 1)[-1] for v in [*fulls[: -self.keep], *folded]]

    def _table_name(self, number: int, revision: int) -> str:
        digest = hashlib.md5(self.path.encode()).hexdigest()[:12]
        return f"martkeep_{digest}_{number}_{revision}"

    def _bytes(self, spark: SparkSession, versions: list[_Version]) -> int:
        total = 0
        for version in versions:
            fs, path = file_system(spark, version.path)
            total += fs.getContentSummary(path).getLength()
        return total
