"""One micro-batch: messages in, upserts of both marts out.

The stream itself is stateless, without watermark or window: a row depends on its key
and the tables as they stand, so duplicate, late and reordered messages recompute the
same row. The marts are the only state, and applying a batch again replaces it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martkeep.functions.dates import start_time_millis
from martkeep.operators.fold import flag_missing
from martkeep.operators.keys import (
    count_messages,
    distinct_keys,
    keys_by_target,
    keys_of,
    touched_keys,
    touched_learnings,
)
from martkeep.operators.lookups import DEFAULT_POLICY, LookupPolicy
from martkeep.operators.messages import read_messages, rejected, since
from martkeep.operators.routing import route
from martkeep.plans.earlier import earlier_progress_rows
from martkeep.plans.enroll import enroll_rows
from martkeep.plans.progress import progress_rows
from martkeep.plans.upkeep import rebuild_enroll, rebuild_progress, reconcile
from martkeep.schema import ENROLL, ENROLL_KEY, PROGRESS, PROGRESS_KEY
from martkeep.sinks import BatchLog, MartStore
from martkeep.sources.tables import SourceTables, TableSource


@dataclass(frozen=True)
class UpkeepOptions:
    """Choices of the job; the defaults are the documented semantics.

    ``on_error``: keep unusable messages (``quarantine``), drop them (``skip``) or stop
    (``fail``). ``tombstones`` selects the earlier progress job: withdrawn enrolments
    blank their learnings and deleted rows revive with a new insert date. ``start_time``
    (``yyyyMMddHHmmss``) skips older messages of a file source. ``key_type`` bounds the keys
    of messages; by default it is the widest key of the tables. ``missing="flag"`` marks mart
    rows of touched keys as deleted when the tables no longer give a row for them; by default
    they stay as they are. The others reproduce quirks of the original job.
    """

    on_error: str = "quarantine"
    coercion: str = "strict"
    key_type: str | None = None
    tombstones: bool = False
    last_only: bool = False
    null_numbers_as_zero: bool = False
    compat_fallthrough: bool = False
    course_run_from: str = "mart"
    start_time: str | None = None
    missing: str = "leave"
    policy: LookupPolicy = field(default=DEFAULT_POLICY)


def _utc_now() -> Column:
    return F.lit(dt.datetime.now(dt.timezone.utc))


@dataclass(frozen=True)
class MartUpkeep:
    """Keeps up to two marts. ``clock`` gives the instant a batch is stamped with.

    With ``log`` a batch ends with one record of what it wrote. Marts that know the log (see
    :class:`~martkeep.sinks.ParquetMart`) show nothing of a batch before that.
    """

    tables: TableSource
    progress: MartStore | None = None
    enroll: MartStore | None = None
    options: UpkeepOptions = field(default_factory=UpkeepOptions)
    quarantine_path: str | None = None
    audit_path: str | None = None
    clock: Callable[[], Column] = _utc_now
    log: BatchLog | None = None

    def __post_init__(self) -> None:
        if self.options.on_error == "quarantine" and not self.quarantine_path:
            raise ValueError("on_error='quarantine' needs a quarantine_path")
        if self.options.missing not in ("leave", "flag"):
            raise ValueError("missing must be 'leave' or 'flag'")

    def start(
        self,
        raw: DataFrame,
        checkpoint: str,
        *,
        name: str = "martkeep",
        every: str | None = None,
        available_now: bool = False,
    ) -> StreamingQuery:
        """Start the streaming query on ``raw`` (a stream with a text column ``value``)."""
        writer = (
            raw.writeStream.queryName(name)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self.process)
        )
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif every:
            writer = writer.trigger(processingTime=every)
        return writer.start()

    def run_available(self, raw: DataFrame, checkpoint: str, name: str = "martkeep") -> None:
        """Process what the source has now and stop."""
        self.start(raw, checkpoint, name=name, available_now=True).awaitTermination()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Process one batch of raw messages; also usable for a plain DataFrame."""
        spark = batch.sparkSession
        options = self.options
        as_of = self.clock()
        run = _run_of(spark)
        origin = (run, batch_id)
        with _adaptive(spark), _kept() as keep:
            tables = self.tables.load(spark)
            messages = self._messages(batch, tables)
            if options.on_error == "quarantine":
                messages = keep(messages)  # read twice
                self._write(rejected(messages), self.quarantine_path, run, batch_id)
            # Few rows beside the messages; everything below starts from them.
            counted = keep(count_messages(messages))
            keys = keys_of(counted)
            sizes = dict(keys.groupBy("from_enroll").count().collect())
            totals: dict[str, tuple[int, int]] = {}
            numbers: dict[str, int] = {}
            if sizes:
                learnings = keep(
                    touched_learnings(
                        keys,
                        tables.learning,
                        n_enrolments=sizes.get(True, 0),
                        n_named=sizes.get(False, 0),
                        policy=options.policy,
                    )
                )
                keyed = keep(keys_by_target(touched_keys(keys, learnings)))
                sums = keyed.groupBy("target").agg(F.count("*"), F.sum("n_messages"))
                totals = {target: (n_keys, n) for target, n_keys, n in sums.collect()}
                if self.progress is not None and PROGRESS in totals:
                    numbers[PROGRESS] = self._upsert_progress(
                        origin, keyed, learnings, totals[PROGRESS][0], tables, as_of
                    )
                if self.enroll is not None:
                    size = totals.get(ENROLL, (0, 0))[0]
                    if options.compat_fallthrough:
                        size += totals.get(PROGRESS, (0, 0))[0]
                    if size:
                        numbers[ENROLL] = self._upsert_enroll(origin, keyed, size, tables, as_of)
            if self.audit_path:
                self._write(audit_rows(counted, totals, as_of), self.audit_path, run, batch_id)
            if self.log is not None:
                self.log.record(spark, run, batch_id, numbers)

    def rebuild(self, spark: SparkSession, next_batch: int | None = None) -> None:
        """Recompute both marts for all keys of the tables, keeping insert dates.

        Run it while the stream is stopped; ``next_batch`` is the mart's number of the batch
        that comes next, by default behind the last. Mart rows whose key is gone from the tables stay as they are.
        """
        for store, rows, _, _ in self._rebuilt(spark, next_batch):
            store.overlay(rows, next_batch)

    def reconcile(self, spark: SparkSession, next_batch: int | None = None) -> dict[str, DataFrame]:
        """Per mart, the rows in which it differs from a rebuild (dates left out)."""
        found = {}
        for store, rows, key, name in self._rebuilt(spark, next_batch):
            compare = [c for c in rows.columns if c != key and not c.endswith("_date")]
            mart = store.snapshot(spark, before=next_batch)
            found[name] = reconcile(mart, rows, key, compare)
        return found

    def _rebuilt(self, spark: SparkSession, next_batch: int | None):
        """(store, rows of all keys, key, name) of each mart."""
        tables, as_of = self.tables.load(spark), self.clock()
        if self.progress is not None:
            rows = rebuild_progress(
                tables,
                self.progress.snapshot(spark, before=next_batch),
                as_of,
                insert_dates="revive" if self.options.tombstones else "keep",
                null_numbers_as_zero=self.options.null_numbers_as_zero,
            )
            yield self.progress, rows, PROGRESS_KEY, PROGRESS
        if self.enroll is not None:
            rows = rebuild_enroll(
                tables,
                self.enroll.snapshot(spark, before=next_batch),
                as_of,
                course_run_from=self.options.course_run_from,
            )
            yield self.enroll, rows, ENROLL_KEY, ENROLL

    def _messages(self, batch: DataFrame, tables: SourceTables) -> DataFrame:
        options = self.options
        kinds = {tables.key_type("learning", PROGRESS_KEY), tables.key_type("enroll", ENROLL_KEY)}
        key_type = options.key_type or ("int" if kinds <= {"int", "smallint", "tinyint"} else "bigint")
        messages = read_messages(
            batch.select("value"),
            on_error=options.on_error,
            coercion=options.coercion,
            key_type=key_type,
            require_status=options.tombstones,
            require_source_ts=not options.tombstones,
        )
        if options.start_time:
            start = start_time_millis(batch.sparkSession, options.start_time)
            messages = since(messages, start)
        # The text is only needed again for the quarantine.
        text = F.when(F.col("reason").isNotNull(), F.col("value"))
        return messages.withColumn("value", text)

    def _settle(
        self,
        store: MartStore,
        origin: tuple[str, int],
        keys: DataFrame,
        size: int,
        rows_of: Callable[[DataFrame], DataFrame],
    ) -> int:
        """Upsert ``rows_of`` the mart's rows of ``keys``; the store's number of the batch.

        If another writer's earlier batch came in meanwhile, the rows were made from a state
        that is no longer the one before this batch: they are made and written again.
        """
        spark = keys.sparkSession
        number = store.begin(spark, *origin)
        store.prepare(spark, number)
        while True:
            state = store.state(spark, number)
            known = store.lookup(spark, keys, size, number, self.options.policy)
            store.apply(rows_of(known), number, origin)
            if store.state(spark, number) == state:
                return number

    def _upsert_progress(self, origin, keyed, learnings, size, tables, as_of) -> int:
        options = self.options
        kind = tables.key_type("learning", PROGRESS_KEY)
        keys = keyed.where(F.col("target") == PROGRESS).select(F.col("seq").cast(kind).alias(PROGRESS_KEY))
        common = {
            "null_numbers_as_zero": options.null_numbers_as_zero,
            "size": size,
            "policy": options.policy,
            "learning": learnings,
        }

        def rows_of(mart: DataFrame) -> DataFrame:
            if options.tombstones:
                rows = earlier_progress_rows(
                    keys, tables, mart, as_of, last_only=options.last_only, **common
                )
            else:
                rows = progress_rows(keys, tables, mart, as_of, one_per_key=True, **common)
            return flag_missing(rows, mart, PROGRESS_KEY, as_of) if options.missing == "flag" else rows

        return self._settle(self.progress, origin, keys, size, rows_of)

    def _upsert_enroll(self, origin, keyed, size, tables, as_of) -> int:
        options = self.options
        kind = tables.key_type("enroll", ENROLL_KEY)
        routed = route(keyed, ENROLL, compat_fallthrough=options.compat_fallthrough)
        if options.compat_fallthrough:  # both kinds of keys meet here
            keys = distinct_keys(routed, ENROLL_KEY, kind).select(ENROLL_KEY)
        else:
            keys = routed.select(F.col("seq").cast(kind).alias(ENROLL_KEY))

        def rows_of(mart: DataFrame) -> DataFrame:
            rows = enroll_rows(
                keys,
                tables,
                mart,
                as_of,
                course_run_from=options.course_run_from,
                size=size,
                policy=options.policy,
            )
            return flag_missing(rows, mart, ENROLL_KEY, as_of) if options.missing == "flag" else rows

        return self._settle(self.enroll, origin, keys, size, rows_of)

    @staticmethod
    def _write(rows: DataFrame, path: str, run: str, batch_id: int) -> None:
        """Rows of one batch in their own directory, which a repeated batch replaces."""
        rows.write.mode("overwrite").parquet(f"{path}/run_id={run}/batch_id={batch_id}")


def _run_of(spark: SparkSession) -> str:
    """The id that the stream keeps in its checkpoint: a new checkpoint is a new run."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def audit_rows(counted: DataFrame, totals: dict[str, tuple[int, int]], as_of: Column) -> DataFrame:
    """Counts of a batch: messages by table and reason, keys by target mart.

    ``n`` counts messages or emitted keys, ``n_keys`` the distinct keys. ``counted`` are the
    counted messages, ``totals`` the distinct keys and emitted keys per mart: what the batch
    has computed anyway, so no message is looked at again. Tables that no mart depends on
    are counted together, so the result has a handful of rows.
    """
    audit = counted.groupBy(F.lit("messages").alias("kind"), F.col("kind").alias("name"), "reason").agg(
        F.sum("n_messages").alias("n"),
        F.lit(None).cast("bigint").alias("n_keys"),
        F.min("first_source_ts_ms").alias("first_source_ts_ms"),
        F.max("last_source_ts_ms").alias("last_source_ts_ms"),
    )
    if totals:
        rows = [("keys", target, None, n, n_keys, None, None) for target, (n_keys, n) in totals.items()]
        audit = audit.unionByName(counted.sparkSession.createDataFrame(rows, audit.schema))
    return audit.withColumn("as_of", as_of).coalesce(1)


@contextmanager
def _kept():
    """Persists frames for the length of a batch (recomputed if an executor is lost)."""
    frames: list[DataFrame] = []

    def keep(frame: DataFrame) -> DataFrame:
        frames.append(frame.persist(StorageLevel.MEMORY_AND_DISK))
        return frames[-1]

    try:
        yield keep
    finally:
        for frame in reversed(frames):
            frame.unpersist()


@contextmanager
def _adaptive(spark: SparkSession):
    """A stream runs in a session without adaptive execution; a stateless batch wants it."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
