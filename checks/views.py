"""The change messages, source tables and marts, derived from the driver's tables.

``ASIA`` plays the counted course type and ``BUILDING`` the confirmed status in the
tables; messages carry the literal codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martkeep.schema import SOURCE_COLUMNS
from martkeep.sinks.files import file_system
from martkeep.sources.tables import SourceTables

AS_OF_SQL = "TIMESTAMP '2024-06-01 00:00:00'"
COUNTED_TYPE = "ASIA"
CONFIRMED = "BUILDING"

RAW_VALUE = """CASE
  WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'not json'
  WHEN event_type = 'error' AND event_id % 3 = 1 THEN ''
  WHEN event_type = 'error' THEN concat('{"payload":{"__table":"TBL_OTHER","__source_ts_ms":1,"x":',
       CAST(event_id AS VARCHAR(20)), '}}')
  WHEN event_type IN ('click','view') THEN concat(
       '{"payload":{"__table":"TBL_LEARNING_SUBJECT","__source_ts_ms":1,"Learning_Seq":',
       CAST(event_id AS VARCHAR(20)), '.0}}')
  ELSE concat('{"payload":{"__table":"TBL_ENROLL","__source_ts_ms":1,"Confirm_Status_Cd":"',
       CASE WHEN user_id % 3 = 0 THEN 'LMER01' ELSE 'LMER02' END, '","Enroll_Seq":"',
       CAST(user_id AS VARCHAR(20)), '.9"}}') END"""


def as_of() -> Column:
    """The fixed processing time of all queries, without a zone like the driver's dates."""
    return F.expr("TIMESTAMP_NTZ '2024-06-01 00:00:00'")


_SCHEMAS: dict[tuple[str, int], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is taken from the file footers once, until the file changes."""
    path = f"{sf_dir}/{name}.parquet"
    fs, target = file_system(spark, path)
    known = path, fs.getFileStatus(target).getModificationTime()
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[known]).parquet(path)


def raw_of(events: DataFrame) -> DataFrame:
    return events.selectExpr("event_id", f"{RAW_VALUE} AS value")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_of(table(spark, sf_dir, "events"))


#: So much of a table's Parquet, or so many of its rows, are dealt to one task at most.
TASK_BYTES = 4 << 20
TASK_ROWS = 200_000

_ROWS: dict[tuple[str, int, int], int] = {}


def rows_of(spark: SparkSession, sf_dir: str, name: str) -> int:
    """How many rows a driver table has: counted from the file footers once, until the files change."""
    path = f"{sf_dir}/{name}.parquet"
    fs, target = file_system(spark, path)
    known = path, fs.getFileStatus(target).getModificationTime(), fs.getContentSummary(target).getLength()
    if known not in _ROWS:
        _ROWS[known] = table(spark, sf_dir, name).count()
    return _ROWS[known]


def dealt(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A driver table in tasks by ``keys``, as many as its size and its rows ask for.

    A number that adaptive execution leaves alone: it joins partitions by their compressed
    bytes, and narrow rows take many times these in a task's hash maps. The bytes of the files
    say as little where they compress well, so the rows count too.
    """
    fs, path = file_system(spark, f"{sf_dir}/{name}.parquet")
    by_bytes = -(-fs.getContentSummary(path).getLength() // TASK_BYTES)
    by_rows = -(-rows_of(spark, sf_dir, name) // TASK_ROWS)
    return table(spark, sf_dir, name).repartition(max(1, by_bytes, by_rows), *keys)


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        dealt(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
        .groupBy(
            F.col("l_orderkey").alias("learning_seq"),
            F.col("l_linenumber").alias("learning_subject_seq"),
        )
        .agg(F.max("l_discount").alias("progress_ratio"))
    )


def source_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    customer = table(spark, sf_dir, "customer")
    run = F.when(F.col("o_orderkey") % 10 == 0, (F.col("c_nationkey") + 1) % 25)
    learning = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("learning_seq"),
            F.col("o_custkey").alias("enroll_seq"),
            run.otherwise(F.col("c_nationkey")).alias("course_run_seq"),
            F.col("o_custkey").alias("learner_seq"),
        )
    )
    frames = {
        "learning": learning,
        "course_run": table(spark, sf_dir, "nation").toDF(
            "course_run_seq", "course_run_nm", "course_seq"
        ),
        "course": table(spark, sf_dir, "region").selectExpr(
            "r_regionkey AS course_seq", "r_name AS course_id", "r_name AS course_type_cd"
        ),
        "enroll": customer.selectExpr(
            "c_custkey AS enroll_seq",
            "c_nationkey AS course_run_seq",
            _coded("c_mktsegment", CONFIRMED, "LMER01") + " AS confirm_status_cd",
        ),
        "learning_subject": subjects(spark, sf_dir),
    }
    frames["course"] = frames["course"].withColumn(
        "course_type_cd", F.expr(_coded("course_type_cd", COUNTED_TYPE, "LMCT01"))
    )
    return SourceTables.of({name: frames[name] for name in SOURCE_COLUMNS})


def _coded(column: str, value: str, code: str) -> str:
    """Writes the code the mart rules know in place of the value that plays it."""
    return f"CASE WHEN {column} = '{value}' THEN '{code}' ELSE {column} END"


def progress_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart that knows every third learning, with only its key, date and flag filled."""
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 3 = 0")
        .selectExpr(
            "o_orderkey AS learning_seq",
            "CAST(NULL AS STRING) AS course_run_nm",
            "CAST(NULL AS STRING) AS course_id",
            "CAST(NULL AS INT) AS course_run_seq",
            "CAST(NULL AS BIGINT) AS learner_seq",
            "CAST(NULL AS DOUBLE) AS progress_ratio",
            "CAST(NULL AS INT) AS learning_subject_seq",
            "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS insert_date",
            "CAST(NULL AS TIMESTAMP_NTZ) AS update_date",
            "CASE WHEN o_orderkey % 6 = 0 THEN 'Y' ELSE 'N' END AS delete_yn",
        )
    )


def enroll_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart that knows every second enrolment."""
    return (
        table(spark, sf_dir, "customer")
        .where("c_custkey % 2 = 0")
        .selectExpr(
            "c_custkey AS enroll_seq",
            "c_nationkey AS course_run_seq",
            "TIMESTAMP_NTZ '2023-01-01 00:00:00' AS insert_date",
            "CAST(NULL AS TIMESTAMP_NTZ) AS update_date",
            "'N' AS delete_yn",
        )
    )
