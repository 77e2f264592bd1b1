"""A third of all rows on one key: the joins that meet it are split over tasks."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from martkeep import operators as ops
from martkeep import plans

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
N = 400_000


@contextmanager
def small_thresholds(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in SETTINGS:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def hot(spark, key, hot_value, keys, **columns):
    """N rows, a third of them with ``hot_value``, the others over ``keys`` values."""
    value = F.when(F.col("id") % 3 == 0, F.lit(hot_value)).otherwise(F.xxhash64("id") % keys)
    return spark.range(0, N, 1, 8).select(
        F.abs(value).alias(key), *(expression.alias(name) for name, expression in columns.items())
    )


def run(frame):
    """(row count, checksum, number of split joins)"""
    rows = frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*frame.columns)))
    count, check = rows.collect()[0]
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return count, check, plan.count("skew=true")


@pytest.fixture
def learning(spark):
    return hot(spark, "enroll_seq", 7, 5000, learning_seq=F.col("id"))


@pytest.fixture
def counted(spark):
    return spark.range(5000).selectExpr(
        "CAST(id AS INT) AS seq", "true AS from_enroll", "id AS n_messages", "id AS n_unconfirmed"
    ).repartition("seq").groupBy("seq").agg(
        F.max("from_enroll").alias("from_enroll"),
        F.max("n_messages").alias("n_messages"),
        F.max("n_unconfirmed").alias("n_unconfirmed"),
    )


def test_fan_out_is_split(spark):
    subjects = hot(spark, "k", 7, 5000, subject=F.xxhash64("id"), ratio=F.rand(1))
    rows = spark.range(8000).selectExpr("id AS k", "id * 2 AS payload")
    with small_thresholds(spark):
        count, check, split = run(ops.fan_out_left_join(rows, subjects, "k"))
        plain = rows.join(subjects, "k", "left").select("k", "payload", "subject", "ratio")
        assert (count, check) == run(plain)[:2]
    assert split >= 1


def test_expanding_enrolments_is_split(spark, learning, counted):
    learning = learning.withColumn("learning_seq", F.xxhash64("learning_seq"))
    with small_thresholds(spark):
        count, _, split = run(ops.expand_enrolments(counted, learning))
    assert count == N and split >= 1


def test_last_learnings_aggregate_before_the_join(spark, learning, counted):
    with small_thresholds(spark):
        rows = plans.last_learnings(counted, learning)
        found = {row.enroll_seq: row.learning_seq for row in rows.collect()}
        plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert found[7] >= N - 3
    join = plan.index("Join")
    assert plan.index("partial_max(learning_seq") > join
