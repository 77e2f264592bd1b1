"""Every registered query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle, views
from checks.views import as_of
from martkeep import operators as ops
from martkeep import plans
from martkeep.functions import delete_flag, key_number, parse_start_time, start_time_millis
from martkeep.plans.progress import courses, of_course_run, of_enrolment
from martkeep.schema import ENROLL, ENROLL_KEY, PROGRESS, PROGRESS_COLUMNS, PROGRESS_KEY
from martkeep.session import shared_folder
from martkeep.sinks import BatchLog, ParquetMart
from martkeep.sources.messages import stream_parquet
from martkeep.sources.tables import FunctionTables, SourceTables
from martkeep.streaming import MartUpkeep, UpkeepOptions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

START_TIME = "20240115000000"
UNDATED = [name for name in PROGRESS_COLUMNS if not name.endswith("_date")]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


class Inputs:
    """What most queries start from, for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._at = (spark, sf_dir)

    @cached_property
    def tables(self) -> SourceTables:
        return views.source_tables(*self._at)

    @cached_property
    def mart(self) -> DataFrame:
        return views.progress_mart(*self._at)

    @cached_property
    def enroll_mart(self) -> DataFrame:
        return views.enroll_mart(*self._at)

    @cached_property
    def keys(self) -> DataFrame:
        return ops.message_keys(ops.read_messages(views.raw(*self._at)))

    @cached_property
    def earlier_keys(self) -> DataFrame:
        """Keys of the messages that the earlier job takes."""
        messages = ops.read_messages(
            views.raw(*self._at), require_status=True, require_source_ts=False
        )
        return ops.message_keys(messages)

    @cached_property
    def learnings(self) -> DataFrame:
        """Touched learning rows, from one pass over the table."""
        return ops.touched_learnings(self.keys, self.tables.learning)

    @cached_property
    def touched(self) -> DataFrame:
        return ops.touched_keys(self.keys, self.tables.learning)

    def progress_keys(self) -> DataFrame:
        kind = self.tables.key_type("learning", PROGRESS_KEY)
        return ops.distinct_keys(ops.route(self.touched, PROGRESS), PROGRESS_KEY, kind)

    def enroll_keys(self, fallthrough: bool = False) -> DataFrame:
        kind = self.tables.key_type("enroll", ENROLL_KEY)
        routed = ops.route(self.touched, ENROLL, compat_fallthrough=fallthrough)
        return ops.distinct_keys(routed, ENROLL_KEY, kind)


# --- messages -----------------------------------------------------------------------


@query
def cdc_nonempty(spark, sf_dir):
    return ops.read_messages(views.raw(spark, sf_dir)).select("event_id", "value")


@query
def cdc_parse(spark, sf_dir):
    return ops.read_messages(views.raw(spark, sf_dir)).drop("value", "reason")


@query
def cdc_accepted(spark, sf_dir):
    messages = ops.accepted(ops.read_messages(views.raw(spark, sf_dir)))
    return messages.select("event_id", "table_name", "enroll_seq", "learning_seq")


@query
def cdc_quarantine(spark, sf_dir):
    messages = ops.rejected(ops.read_messages(views.raw(spark, sf_dir)))
    return messages.select("event_id", "value", "reason")


@query
def cdc_fail_fast(spark, sf_dir):
    """The strict mode over all messages but those that it must stop at."""
    sound = views.raw(spark, sf_dir).where("value <> 'not json'")
    messages = ops.read_messages(sound, on_error="fail", require_status=True)
    return ops.accepted(messages).select("event_id", "table_name", "confirm_status_cd")


@query
def cdc_reasons(spark, sf_dir):
    """Every reason a message can be rejected for, and spellings that are let through."""
    events = views.table(spark, sf_dir, "events")
    return ops.read_messages(events.selectExpr("event_id", f"{oracle.REASON_TEXT} AS value")).select(
        "event_id", "value", "reason", "table_name", "enroll_seq", "learning_seq"
    )


@query
def cdc_since(spark, sf_dir):
    stamped = views.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """concat('{"payload":{"__table":"TBL_LEARNING_SUBJECT","__source_ts_ms":',
           CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING),
           ',"Learning_Seq":', CAST(event_id AS STRING), '}}') AS value""",
    )
    messages = ops.read_messages(stamped)
    return ops.since(messages, start_time_millis(spark, START_TIME)).select(
        "event_id", "learning_seq"
    )


@query
def start_time_parse(spark, sf_dir):
    text = F.date_format("ts", "yyyyMMddHHmmss")
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        text.alias("start_text"),
        parse_start_time(text).cast("timestamp_ntz").alias("start_time"),
    )


@query
def key_coercion(spark, sf_dir):
    text = F.expr(oracle.KEY_TEXT)
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        key_number(text).alias("strict_key"),
        key_number(text, coercion="clamp").alias("clamped_key"),
    )


@query
def named_keys(spark, sf_dir):
    positional = Inputs(spark, sf_dir).touched.where(F.col("target") == PROGRESS)
    rows = positional.select("seq", "target", "n_messages").toDF("_0", "_1", "_2")
    types = {"learning_seq": "int", "target_table": "string", "n_messages": "bigint"}
    return ops.expand_counts(ops.named_rows(rows, types))


# --- keys and routing ---------------------------------------------------------------


@query
def message_keys(spark, sf_dir):
    return Inputs(spark, sf_dir).keys


@query
def touched_keys(spark, sf_dir):
    touched = Inputs(spark, sf_dir).touched
    return ops.expand_counts(touched.select("seq", "target", "n_messages"))


@query
def touched_keys_wide(spark, sf_dir):
    """Learnings whose keys are beyond INT."""
    inputs = Inputs(spark, sf_dir)
    wide = inputs.tables.learning.withColumn("learning_seq", F.expr("learning_seq + 3000000000L"))
    touched = ops.touched_keys(inputs.keys, wide)
    return touched.groupBy("seq", "target").agg(F.sum("n_messages").alias("n_messages"))


@query
def touched_keys_distinct(spark, sf_dir):
    touched = Inputs(spark, sf_dir).touched
    return touched.groupBy("seq", "target").agg(F.sum("n_messages").alias("n_messages"))


@query
def route_exclusive(spark, sf_dir):
    touched = Inputs(spark, sf_dir).touched
    routed = ops.route(touched, PROGRESS).unionByName(ops.route(touched, ENROLL))
    return routed.groupBy("target").agg(F.sum("n_messages").alias("n"))


@query
def route_progress(spark, sf_dir):
    return Inputs(spark, sf_dir).progress_keys().select(PROGRESS_KEY, "n_messages")


@query
def route_enroll(spark, sf_dir):
    return Inputs(spark, sf_dir).enroll_keys().select(ENROLL_KEY, "n_messages")


@query
def route_fallthrough(spark, sf_dir):
    touched = Inputs(spark, sf_dir).touched
    progress, enroll = (
        ops.route(touched, mart, compat_fallthrough=True).select(
            "seq", F.lit(mart).alias("mart"), "n_messages"
        )
        for mart in (PROGRESS, ENROLL)
    )
    return ops.expand_counts(progress.unionByName(enroll))


@query
def enroll_to_learning(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    expanded = ops.expand_enrolments(inputs.keys, inputs.tables.learning)
    return expanded.select(F.col("seq").alias(ENROLL_KEY), "learning_seq")


# --- lookups ------------------------------------------------------------------------


@query
def lookup_learning(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return ops.narrow(inputs.tables.learning, inputs.progress_keys(), PROGRESS_KEY)


@query
def lookup_course_run(spark, sf_dir):
    tables = views.source_tables(spark, sf_dir)
    joined = of_course_run(tables.learning, tables.course_run)
    return joined.select("learning_seq", "course_run_seq", "course_run_nm", "course_seq")


@query
def lookup_course(spark, sf_dir):
    return courses(views.source_tables(spark, sf_dir))


@query
def lookup_enroll(spark, sf_dir):
    tables = views.source_tables(spark, sf_dir)
    joined = of_enrolment(tables.learning, tables.enroll)
    return joined.select("learning_seq", "enroll_seq", "course_run_seq", "confirm_status_cd")


@query
def lookup_subject(spark, sf_dir):
    tables = views.source_tables(spark, sf_dir)
    learning = tables.learning.select("learning_seq", "learner_seq")
    return ops.fan_out_left_join(learning, tables.learning_subject, PROGRESS_KEY)


@query
def lookup_top_subject(spark, sf_dir):
    tables = views.source_tables(spark, sf_dir)
    best = ops.top_subject(tables.learning_subject)
    return tables.learning.select("learning_seq").join(best, PROGRESS_KEY, "left")


@query
def lookup_progress_mart(spark, sf_dir):
    tables = views.source_tables(spark, sf_dir)
    mart = views.progress_mart(spark, sf_dir)
    return ops.stamp(tables.learning.select("learning_seq"), mart, PROGRESS_KEY, as_of())


@query
def insert_date_revival(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    learning = ops.narrow(inputs.tables.learning, inputs.progress_keys(), PROGRESS_KEY)
    rows = ops.stamp(learning, inputs.mart, PROGRESS_KEY, as_of(), "revive")
    return rows.select("learning_seq", "insert_date", "update_date")


@query
def lookup_enroll_row(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return ops.narrow(inputs.tables.enroll, inputs.enroll_keys(), ENROLL_KEY)


@query
def lookup_enroll_mart(spark, sf_dir):
    tables = views.source_tables(spark, sf_dir)
    mart = views.enroll_mart(spark, sf_dir)
    return ops.stamp(tables.enroll.select(ENROLL_KEY), mart, ENROLL_KEY, as_of())


@query
def soft_delete_flag(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    kind, status = F.expr(oracle.FLAG_TYPE), F.expr(oracle.FLAG_STATUS)
    return events.select("event_id", delete_flag(kind, status).alias("delete_yn"))


# --- mart rows ----------------------------------------------------------------------


@query
def progress_rows(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.progress_rows(None, i.tables, i.mart, as_of(), learning=i.learnings)


@query
def progress_rows_sql(spark, sf_dir):
    """The result and a table as views of a SQL query."""
    i = Inputs(spark, sf_dir)
    named = {"check_progress": progress_rows(spark, sf_dir), "check_learning": i.tables.learning}
    text = "SELECT p.* FROM check_progress p JOIN check_learning l USING (learning_seq)"
    return plans.query_views(spark, text, named)


@query
def progress_rows_one_per_key(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.progress_rows(None, i.tables, i.mart, as_of(), one_per_key=True, learning=i.learnings)


@query
def progress_rows_kept(spark, sf_dir):
    """One row per key chosen from the fanned-out rows."""
    rows = progress_rows(spark, sf_dir)
    return ops.one_per_key(rows, PROGRESS_KEY, ("learning_subject_seq", "progress_ratio"))


@query
def progress_rows_null_as_zero(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.progress_rows(
        i.progress_keys(), i.tables, i.mart, as_of(), null_numbers_as_zero=True
    )


@query
def enroll_rows(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.enroll_rows(i.enroll_keys(), i.tables, i.enroll_mart, as_of())


@query
def enroll_rows_sql(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    named = {"check_enroll_rows": enroll_rows(spark, sf_dir), "check_enroll": i.tables.enroll}
    text = "SELECT r.* FROM check_enroll_rows r LEFT SEMI JOIN check_enroll USING (enroll_seq)"
    return plans.query_views(spark, text, named)


@query
def enroll_rows_from_enroll(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.enroll_rows(
        i.enroll_keys(), i.tables, i.enroll_mart, as_of(), course_run_from="enroll"
    )


@query
def enroll_rows_fallthrough(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.enroll_rows(i.enroll_keys(fallthrough=True), i.tables, i.enroll_mart, as_of())


@query
def tombstones(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    rows = plans.tombstones(i.earlier_keys, i.tables.learning, i.mart)
    return ops.expand_counts(rows, "n_unconfirmed")


@query
def last_learning(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    rows = plans.last_learnings(i.keys, i.tables.learning)
    return ops.expand_counts(rows.drop("n_unconfirmed"))


@query
def progress_rows_with_tombstones(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.earlier_progress_rows(i.earlier_keys, i.tables, i.mart, as_of())


@query
def progress_rows_last_only(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.earlier_progress_rows(
        i.earlier_keys, i.tables, i.mart, as_of(), last_only=True
    )


# --- marts --------------------------------------------------------------------------


@query
def merge_progress(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.merged_progress(None, i.tables, i.mart, as_of(), learning=i.learnings)


@query
def merge_progress_flag_missing(spark, sf_dir):
    """Mart rows of touched keys that the tables give no row for are flagged."""
    i = Inputs(spark, sf_dir)
    return plans.merged_progress(i.progress_keys(), i.tables, i.mart, as_of(), missing="flag", learning=i.learnings)


@query
def merge_two_writers(spark, sf_dir):
    """Two streams begin before either writes, share a third of the keys, and end in reverse."""
    i = Inputs(spark, sf_dir)
    folder = shared_folder(spark, "writers")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in i.mart.schema.fields)
    mart = ParquetMart(f"{folder}/progress", schema, PROGRESS_KEY)
    mart.create(spark, i.mart)
    learnings = i.learnings.persist(StorageLevel.MEMORY_AND_DISK)  # as in a batch of the stream
    parts = {run: learnings.where(f"learning_seq % 3 <> {rest}") for run, rest in (("one", 0), ("two", 1))}
    numbers = {run: mart.begin(spark, run, 0) for run in parts}
    try:
        for run, touched in reversed(parts.items()):
            known = mart.snapshot(spark, before=numbers[run])
            rows = plans.progress_rows(None, i.tables, known, as_of(), one_per_key=True, learning=touched)
            mart.apply(rows, numbers[run], (run, 0))
    finally:
        learnings.unpersist()
    return mart.snapshot(spark)


@query
def merge_enroll(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.merged_enroll(i.enroll_keys(), i.tables, i.enroll_mart, as_of())


@query
def rebuild_progress(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.rebuild_progress(i.tables, i.mart, as_of())


@query
def rebuild_enroll(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return plans.rebuild_enroll(i.tables, i.enroll_mart, as_of())


@query
def reconcile_progress(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    merged = plans.merged_progress(None, i.tables, i.mart, as_of(), learning=i.learnings)
    rebuilt = plans.rebuild_progress(i.tables, i.mart, as_of())
    return plans.reconcile(merged, rebuilt, PROGRESS_KEY, UNDATED[1:])


@query
def reconcile_enroll(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    merged = plans.merged_enroll(i.enroll_keys(), i.tables, i.enroll_mart, as_of())
    rebuilt = plans.rebuild_enroll(i.tables, i.enroll_mart, as_of())
    return plans.reconcile(merged, rebuilt, ENROLL_KEY, ["course_run_seq", "delete_yn"])


# --- streams ------------------------------------------------------------------------


def _run_stream(
    spark, sf_dir, options=UpkeepOptions(), parts=("true",)
) -> tuple[MartUpkeep, str]:
    """Run the event file through the streaming job into new marts.

    Each of the conditions ``parts`` is a run with a checkpoint of its own, on the same marts.
    """
    folder = shared_folder(spark, "stream")
    log = BatchLog(f"{folder}/batches")
    progress = views.progress_mart(spark, sf_dir)
    enroll = views.enroll_mart(spark, sf_dir)
    stores = {}
    for name, mart, key in (("progress", progress, PROGRESS_KEY), ("enroll", enroll, ENROLL_KEY)):
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in mart.schema.fields)
        stores[name] = ParquetMart(f"{folder}/{name}", schema, key, log=log, name=name)
        stores[name].create(spark, mart)
    job = MartUpkeep(
        FunctionTables(lambda session: views.source_tables(session, sf_dir)),
        stores["progress"],
        stores["enroll"],
        options,
        quarantine_path=f"{folder}/quarantine",
        audit_path=f"{folder}/audit",
        clock=as_of,
        log=log,
    )
    schema = views.table(spark, sf_dir, "events").schema
    events = stream_parquet(spark, f"{sf_dir}/events*.parquet", schema)
    for number, part in enumerate(parts):
        job.run_available(views.raw_of(events.where(part)), f"{folder}/checkpoint-{number}")
    return job, folder


#: Two halves of all events.
HALVES = ("event_type IN ('click', 'view')", "event_type NOT IN ('click', 'view')")


@query
def stream_progress(spark, sf_dir):
    job, _ = _run_stream(spark, sf_dir)
    return job.progress.snapshot(spark)


@query
def stream_restart(spark, sf_dir):
    """The second half of the messages under a new checkpoint, on the marts of the first."""
    job, _ = _run_stream(spark, sf_dir, parts=HALVES)
    return job.progress.snapshot(spark)


@query
def stream_restart_audit(spark, sf_dir):
    """Quarantine and audit cover both runs."""
    _, folder = _run_stream(spark, sf_dir, parts=HALVES)
    audit = spark.read.parquet(f"{folder}/audit").where("kind = 'messages'")
    kept = spark.read.parquet(f"{folder}/quarantine").select(
        F.lit("quarantine").alias("name"), "reason", F.lit(1).cast("bigint").alias("n")
    )
    both = audit.select("name", "reason", "n").unionByName(kept)
    return both.groupBy("name", "reason").agg(F.sum("n").alias("n"))


@query
def stream_enroll(spark, sf_dir):
    job, _ = _run_stream(spark, sf_dir)
    return job.enroll.snapshot(spark)


@query
def stream_quarantine(spark, sf_dir):
    _, folder = _run_stream(spark, sf_dir)
    rejected = spark.read.parquet(f"{folder}/quarantine")
    return rejected.groupBy("value", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_audit(spark, sf_dir):
    _, folder = _run_stream(spark, sf_dir)
    audit = spark.read.parquet(f"{folder}/audit")
    return audit.groupBy("kind", "name", "reason").agg(
        F.sum("n").alias("n"), F.sum("n_keys").alias("n_keys")
    )


@query
def stream_tombstones(spark, sf_dir):
    """The earlier job as a stream."""
    job, _ = _run_stream(spark, sf_dir, UpkeepOptions(tombstones=True))
    return job.progress.snapshot(spark)
