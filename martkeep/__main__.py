"""The streaming job: ``spark-submit ... -m martkeep CONFIG [yyyyMMddHHmmss]``.

Messages come from Kafka, table state and marts live behind JDBC. The optional start time
applies to a query without a checkpoint.
"""

from __future__ import annotations

import argparse

from martkeep.config import JobConfig
from martkeep.operators.lookups import LookupPolicy
from martkeep.schema import ENROLL_KEY, ENROLL_SCHEMA, PROGRESS_KEY, PROGRESS_SCHEMA
from martkeep.session import build_session
from martkeep.sinks import JdbcMart
from martkeep.sources import JdbcTables, read_kafka
from martkeep.streaming import MartUpkeep, UpkeepOptions


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="martkeep")
    parser.add_argument("config", help="properties file")
    parser.add_argument("start_time", nargs="?", help="yyyyMMddHHmmss, default: newest messages")
    parser.add_argument("--jdbc-prefix", default="jdbc", help="prefix of the database settings")
    parser.add_argument("--name", default="martkeep", help="name of the query")
    parser.add_argument(
        "--on-error",
        choices=("quarantine", "skip", "fail"),
        help="default: quarantine if there is a folder for it, else fail",
    )
    parser.add_argument("--quarantine", help="folder for unusable messages")
    parser.add_argument("--audit", help="folder for the counts of each batch")
    parser.add_argument("--tombstones", action="store_true", help="run the earlier progress job")
    return parser.parse_args(given)


def job_of(config: JobConfig, options: argparse.Namespace) -> MartUpkeep:
    """The job of a configuration; the earlier one keeps the progress mart only."""
    writer = {"writer": options.name}
    progress = JdbcMart(
        config.mart, config.progress_table, PROGRESS_SCHEMA, PROGRESS_KEY, **writer
    )
    enroll = JdbcMart(config.mart, config.enroll_table, ENROLL_SCHEMA, ENROLL_KEY, **writer)
    return MartUpkeep(
        JdbcTables(config.source),
        progress,
        None if options.tombstones else enroll,
        UpkeepOptions(
            on_error=options.on_error or ("quarantine" if options.quarantine else "fail"),
            tombstones=options.tombstones,
            policy=LookupPolicy(**config.limits),
            **config.choices,
        ),
        quarantine_path=options.quarantine,
        audit_path=options.audit,
    )


def main(given: list[str] | None = None) -> None:
    options = arguments(given)
    config = JobConfig.from_properties(options.config, options.start_time, options.jdbc_prefix)
    spark = build_session(options.name)
    job = job_of(config, options)
    for store in (job.progress, job.enroll):
        if store is not None:
            store.create(spark)
    raw = read_kafka(spark, config.kafka)
    job.start(raw, config.checkpoint, name=options.name, every=config.every).awaitTermination()


if __name__ == "__main__":
    main()
