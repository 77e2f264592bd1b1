"""Any split, order or repetition of the same messages leaves the same mart."""

import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import world
from martkeep import plans
from martkeep.schema import ENROLL_KEY, ENROLL_SCHEMA, PROGRESS_KEY, PROGRESS_SCHEMA
from martkeep.sinks import ParquetMart
from martkeep.sources.tables import FunctionTables
from martkeep.streaming import MartUpkeep, UpkeepOptions

MESSAGES = [
    *(world.enroll_message(key) for key in (1, 2, 3, 6, 99)),
    *(world.subject_message(key) for key in (5, 11, 21, 31, 404)),
    "not json",
    "",
]
OWNED = {1: {11, 12, 13}, 2: {21}, 6: {41}, 99: {51}}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    batches=st.lists(
        st.lists(st.sampled_from(range(len(MESSAGES))), min_size=1, max_size=6),
        min_size=1,
        max_size=3,
    )
)
def test_the_mart_equals_a_rebuild_of_the_touched_keys(spark, batches):
    folder = f"file:{tempfile.mkdtemp(prefix='martkeep-property-')}"
    progress = ParquetMart(f"{folder}/progress", PROGRESS_SCHEMA, PROGRESS_KEY, buckets=2)
    enroll = ParquetMart(f"{folder}/enroll", ENROLL_SCHEMA, ENROLL_KEY, buckets=2)
    tables = world.tables(spark)
    job = MartUpkeep(FunctionTables(lambda _: tables), progress, enroll, UpkeepOptions(on_error="skip"), clock=world.as_of)
    for number, batch in enumerate(batches):
        job.process(world.raw(spark, *(MESSAGES[i] for i in batch)), number)

    sent = {MESSAGES[i] for batch in batches for i in batch}
    enrolments = {key for key in (1, 2, 3, 6, 99) if world.enroll_message(key) in sent}
    learnings = {key for key in (5, 11, 21, 31, 404) if world.subject_message(key) in sent}
    learnings |= {key for enrolment in enrolments for key in OWNED.get(enrolment, ())}

    rebuilt = world.by_key(
        plans.rebuild_progress(tables, world.progress_mart(spark), world.as_of()), PROGRESS_KEY
    )
    assert world.by_key(progress.snapshot(spark), PROGRESS_KEY) == {
        key: row for key, row in rebuilt.items() if key in learnings
    }
    rebuilt = world.by_key(
        plans.rebuild_enroll(tables, world.enroll_mart(spark), world.as_of()), ENROLL_KEY
    )
    assert world.by_key(enroll.snapshot(spark), ENROLL_KEY) == {
        key: row for key, row in rebuilt.items() if key in enrolments
    }
