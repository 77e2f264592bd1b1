import pytest

from martkeep.__main__ import arguments, job_of
from martkeep.config import JobConfig

TEXT = """
# a comment
kafka.bootstrap.servers=a:9092,b:9092
kafka.topics=one, two
kafka.group=g
db.url=jdbc:mysql://host:3306/
db.username=me
db.password=x=y
source.database=ops
mart.database=mart?useSSL=false
mart.enroll=ENROLL_MART
checkpoint=/shared/checkpoint
trigger=1 minute
"""


def config(tmp_path, extra="", **options):
    path = tmp_path / "job.properties"
    path.write_text(TEXT + extra)
    return JobConfig.from_properties(str(path), jdbc_prefix="db", **options)


def test_properties(tmp_path):
    found = config(tmp_path, start_time="20220928133000")
    assert found.kafka.topics == ("one", "two") and found.kafka.group == "g"
    assert found.kafka.start_time == "20220928133000"
    assert found.source.url == "jdbc:mysql://host:3306/ops"
    assert found.mart.url == "jdbc:mysql://host:3306/mart?useSSL=false"
    assert (found.mart.user, found.mart.password) == ("me", "x=y")
    assert found.enroll_table == "ENROLL_MART" and found.every == "1 minute"


def test_assigned_partitions_replace_topics(tmp_path):
    found = config(tmp_path, "kafka.partitions=t:0,t:2,u:1\n")
    assert found.kafka.partitions == {"t": [0, 2], "u": [1]} and found.kafka.topics == ()


def test_job_of_a_configuration(tmp_path):
    job = job_of(config(tmp_path), arguments(["c", "--audit", "/a"]))
    assert job.progress.table == "TBL_LEARNING_SUBJECT_PROGRESS_RATIO"
    assert job.enroll.table == "ENROLL_MART" and job.audit_path == "/a"
    earlier = job_of(config(tmp_path), arguments(["c", "20220928133000", "--tombstones"]))
    assert earlier.enroll is None and earlier.options.tombstones


def test_every_choice_of_the_job(tmp_path):
    text = (
        "kafka.max.offsets=5000\nkafka.min.partitions=32\nkey.type=bigint\ncoercion=clamp\n"
        "compat.fallthrough=true\ncourse.run.from=enroll\nlast.only=true\n"
        "null.numbers.as.zero=TRUE\npushdown.keys=10\nbroadcast.keys=20\n"
    )
    found = config(tmp_path, text)
    assert (found.kafka.max_offsets_per_trigger, found.kafka.min_partitions) == (5000, 32)
    options = job_of(found, arguments(["c", "--quarantine", "/q"])).options
    assert (options.key_type, options.coercion, options.course_run_from) == ("bigint", "clamp", "enroll")
    assert options.compat_fallthrough and options.last_only and options.null_numbers_as_zero
    assert (options.policy.pushdown_keys, options.policy.broadcast_keys) == (10, 20)
    with pytest.raises(ValueError, match="coercion"):
        config(tmp_path, "coercion=round\n")


def test_bad_messages_are_kept_or_stop_the_job(tmp_path):
    given = config(tmp_path)
    assert job_of(given, arguments(["c"])).options.on_error == "fail"
    assert job_of(given, arguments(["c", "--quarantine", "/q"])).options.on_error == "quarantine"
    with pytest.raises(ValueError, match="quarantine_path"):
        job_of(given, arguments(["c", "--on-error", "quarantine"]))
