"""Session settings this package counts on, and the shared folder for written state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan joins at run time from real shuffle sizes and split skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Lists of as many keys as LookupPolicy.pushdown_keys prune row groups one by one.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Recording the Python line of every column costs more than building the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "martkeep", **overrides: str) -> SparkSession:
    """Session with :data:`SETTINGS`; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | overrides).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    Below ``spark.checkpoint.dir``. Where that is not set, a local session gets a
    temporary folder; on a cluster there is no safe default.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="martkeep-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
