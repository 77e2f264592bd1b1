import os

import pytest

import world
from martkeep.operators import LookupPolicy
from martkeep.schema import ENROLL_KEY, ENROLL_SCHEMA, PROGRESS_KEY, PROGRESS_SCHEMA
from martkeep.sinks import BatchLog, ParquetMart
from martkeep.sources import stream_text
from martkeep.streaming import MartUpkeep, UpkeepOptions


class Site:
    """Tables, marts and a message folder of one test."""

    def __init__(self, spark, folder, options=UpkeepOptions(), logged=False):
        self.spark, self.folder = spark, folder
        root = f"file:{folder}"
        self.log = BatchLog(f"{root}/batches") if logged else None
        known = {"buckets": 2, "log": self.log}
        self.progress = ParquetMart(f"{root}/progress", PROGRESS_SCHEMA, PROGRESS_KEY, name="progress", **known)
        self.enroll = ParquetMart(f"{root}/enroll", ENROLL_SCHEMA, ENROLL_KEY, name="enroll", **known)
        self.progress.create(spark)
        self.enroll.create(spark)
        self.write_tables()
        self.job = MartUpkeep(
            world.stored_tables(spark, folder / "tables"),
            self.progress,
            self.enroll,
            options,
            quarantine_path=f"{root}/quarantine",
            audit_path=f"{root}/audit",
            clock=world.as_of,
            log=self.log,
        )
        self.sent = 0

    def write_tables(self, **changes):
        world.stored_tables(self.spark, self.folder / "tables", **changes)

    def send(self, *messages):
        inbox = self.folder / "inbox"
        inbox.mkdir(exist_ok=True)
        file = inbox / f"{self.sent:04d}.txt"
        file.write_text("\n".join(messages) + "\n")
        # The source takes files in the order of their modification time.
        os.utime(file, (1_700_000_000 + self.sent,) * 2)
        self.sent += 1

    def run(self):
        raw = stream_text(self.spark, f"{self.folder}/inbox", max_files_per_trigger=1)
        self.job.run_available(raw, f"{self.folder}/checkpoint")

    def rows(self, name="progress"):
        key = PROGRESS_KEY if name == "progress" else ENROLL_KEY
        return world.by_key(getattr(self, name).snapshot(self.spark), key)

    def written(self, name):
        return self.spark.read.parquet(f"file:{self.folder}/{name}")


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def test_batches_keep_both_marts(site):
    site.send(world.enroll_message(1), "not json", "", '{"payload":{"__table":"X","__source_ts_ms":1}}')
    site.send(world.subject_message(21), world.subject_message(21), world.enroll_message("abc"))
    site.run()
    assert set(site.rows()) == {11, 12, 13, 21}
    assert site.rows()[11]["progress_ratio"] == 12.75
    assert set(site.rows("enroll")) == {1}
    rejected = {(r.batch_id, r.reason) for r in site.written("quarantine").collect()}
    assert rejected == {(0, "bad_json"), (1, "bad_key")}
    audit = {
        (r.batch_id, r.kind, r.name, r.reason): (r.n, r.n_keys) for r in site.written("audit").collect()
    }
    assert audit == {
        (0, "messages", "TBL_ENROLL", None): (1, None),
        (0, "messages", "other", "bad_json"): (1, None),
        (0, "messages", "other", None): (1, None),
        (0, "keys", "enroll", None): (1, 1),
        (0, "keys", "progress", None): (3, 3),
        (1, "messages", "TBL_LEARNING_SUBJECT", None): (2, None),
        (1, "messages", "TBL_ENROLL", "bad_key"): (1, None),
        (1, "keys", "progress", None): (2, 1),
    }


def test_later_batches_see_changed_tables_and_earlier_rows_stay(site):
    site.send(world.subject_message(11), world.subject_message(12))
    site.run()
    site.write_tables(course_run=[(100, "renamed", 1000)])
    assert {row["course_run_nm"] for row in site.rows().values()} == {"run a"}
    site.send(world.subject_message(12), world.subject_message(21))
    site.run()
    names = {key: row["course_run_nm"] for key, row in site.rows().items()}
    # 21 has lost its course run: no row, as before.
    assert names == {11: "run a", 12: "renamed"}


def test_a_restart_repeats_the_last_batch_without_trace(site):
    site.send(world.enroll_message(1))
    site.send(world.subject_message(11), world.enroll_message(2))
    site.run()
    before = site.rows(), site.rows("enroll"), sorted(map(str, site.written("audit").collect()))
    commits = site.folder / "checkpoint" / "commits"
    for path in (commits / "1", commits / ".1.crc"):
        path.unlink()
    site.run()
    assert (commits / "1").exists()
    after = site.rows(), site.rows("enroll"), sorted(map(str, site.written("audit").collect()))
    assert after == before


def test_messages_that_touch_nothing(site):
    site.send("not json", '{"payload":{"__table":"X","__source_ts_ms":1}}')
    site.send(world.subject_message(404))
    site.run()
    assert site.rows() == {} and site.rows("enroll") == {}
    assert site.written("quarantine").count() == 1


def test_fall_through_and_corrected_course_run(spark, tmp_path):
    options = UpkeepOptions(compat_fallthrough=True, course_run_from="enroll")
    site = Site(spark, tmp_path, options)
    site.send(world.enroll_message(7))
    site.run()
    runs = {key: row["course_run_seq"] for key, row in site.rows("enroll").items()}
    assert runs == {5: 100, 7: 300}
    assert set(site.rows()) == {5}


@pytest.mark.parametrize("last_only", [False, True])
def test_the_earlier_job(spark, tmp_path, last_only):
    site = Site(spark, tmp_path, UpkeepOptions(tombstones=True, last_only=last_only))
    site.send(world.enroll_message(1, "LMER02"), world.enroll_message(6, "LMER02"))
    site.send(world.enroll_message(1, None))
    site.run()
    blank = {key for key, row in site.rows().items() if row["course_run_nm"] is None}
    assert set(site.rows()) == {11, 12, 13, 41}
    assert blank == ({11, 12, 41} if last_only else {41})
    assert [r.reason for r in site.written("quarantine").collect()] == ["missing_status"]


def test_failing_on_bad_messages(spark, tmp_path):
    site = Site(spark, tmp_path, UpkeepOptions(on_error="fail"))
    site.send(world.subject_message(11), "not json")
    with pytest.raises(Exception, match="bad_json"):
        site.run()
    assert site.rows() == {}


def test_skipping_bad_messages(spark, tmp_path):
    site = Site(spark, tmp_path, UpkeepOptions(on_error="skip"))
    site.send(world.subject_message(11), "not json")
    site.run()
    assert set(site.rows()) == {11}
    assert not (tmp_path / "quarantine").exists()


def test_batches_run_adaptively(spark, site, monkeypatch):
    seen = []
    original = MartUpkeep._upsert_progress

    def spy(self, batch_id, keys, *rest):
        seen.append(keys.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return original(self, batch_id, keys, *rest)

    monkeypatch.setattr(MartUpkeep, "_upsert_progress", spy)
    site.send(world.subject_message(11))
    site.run()
    assert seen == ["true"]


def test_rebuild_and_reconcile(site):
    site.send(world.enroll_message(1))
    site.run()
    site.write_tables(course_run=[(100, "renamed", 1000), (200, "run b", 2000), (300, "run c", 3000)])
    differences = site.job.reconcile(site.spark)
    found = sorted((r.side, r.learning_seq) for r in differences["progress"].collect())
    assert found == [("mart", key) for key in (11, 12, 13)] + [
        ("rebuild", key) for key in (5, 11, 12, 13, 21)
    ]
    assert differences["enroll"].where("side = 'rebuild'").count() == 7
    site.job.rebuild(site.spark, next_batch=1)
    assert all(frame.count() == 0 for frame in site.job.reconcile(site.spark).values())
    assert site.rows()[11]["course_run_nm"] == "renamed"
    # The stream goes on from the rebuilt mart.
    site.write_tables()
    site.send(world.subject_message(11))
    site.run()
    names = {key: site.rows()[key]["course_run_nm"] for key in (11, 12)}
    assert names == {11: "run a", 12: "renamed"}


def test_a_start_time_skips_older_messages(spark, tmp_path):
    site = Site(spark, tmp_path, UpkeepOptions(start_time="20220928133000"))
    site.send(
        world.subject_message(11, ts=1664371799999), world.subject_message(12, ts=1664371800000), "not json"
    )
    site.run()
    assert set(site.rows()) == {12}
    assert site.written("quarantine").count() == 1


def test_a_new_checkpoint_goes_on_with_the_same_marts(site):
    site.send(world.enroll_message(1), "not json")
    site.run()
    before = site.rows()
    site.write_tables(course_run=[(100, "renamed", 1000), (200, "run b", 2000)])
    site.send(world.subject_message(12), "not json either")
    raw = stream_text(site.spark, f"{site.folder}/inbox", max_files_per_trigger=1)
    site.job.run_available(raw, f"{site.folder}/other-checkpoint")
    assert set(site.rows()) == set(before) and site.rows()[12]["course_run_nm"] == "renamed"
    assert site.rows()[12]["insert_date"] == before[12]["insert_date"]
    # The new run reads the first file again: its message is rejected once per run.
    assert site.written("quarantine").count() == 3
    assert site.written("audit").select("run_id").distinct().count() == 2


def test_learnings_beyond_int_are_kept(spark):
    from martkeep import operators as ops

    keys = ops.message_keys(ops.read_messages(world.raw(spark, world.enroll_message(1))))
    learning = spark.createDataFrame([(5, 1), (3_000_000_000, 1)], "learning_seq BIGINT, enroll_seq INT")
    assert {r.seq for r in ops.touched_keys(keys, learning).where("target = 'progress'").collect()} == {5, 3_000_000_000}


def test_keeping_bad_messages_needs_a_place(spark, tmp_path):
    with pytest.raises(ValueError, match="quarantine_path"):
        MartUpkeep(world.stored_tables(spark, tmp_path / "tables"))


def test_a_stop_between_two_marts_shows_the_old_pair(spark, tmp_path, monkeypatch):
    site = Site(spark, tmp_path, logged=True)
    site.send(world.enroll_message(1), "not json")
    site.run()
    before = site.rows(), site.rows("enroll")
    assert set(before[0]) == {11, 12, 13} and set(before[1]) == {1}
    site.send(world.enroll_message(2), "not json either")
    write = ParquetMart.apply

    def stopping(mart, *given):
        if mart.name == "enroll":
            raise RuntimeError("stopped between the marts")
        write(mart, *given)

    monkeypatch.setattr(ParquetMart, "apply", stopping)
    with pytest.raises(Exception, match="stopped between"):
        site.run()
    assert any("batch-" in p.name and p.name.endswith("-1") for p in (tmp_path / "progress").iterdir())
    pair = [world.by_key(f, k) for f, k in zip(site.log.snapshots(spark, site.progress, site.enroll), (PROGRESS_KEY, ENROLL_KEY))]
    assert tuple(pair) == before and (site.rows(), site.rows("enroll")) == before
    assert site.log.rows_of(spark, f"file:{tmp_path}/quarantine").count() == 1
    monkeypatch.undo()
    site.run()
    assert set(site.rows()) == {11, 12, 13, 21} and set(site.rows("enroll")) == {1, 2}
    assert site.log.rows_of(spark, f"file:{tmp_path}/quarantine").count() == 2
    assert len(site.log.records(spark)) == 2 and site.log.rows_of(spark, f"file:{tmp_path}/audit").count() > 2


def test_rows_are_made_again_when_another_writer_came_between(site, monkeypatch):
    spark, mart = site.spark, site.progress
    other = mart.begin(spark, "other", 0)
    write, calls = ParquetMart.apply, []

    def with_another(store, *given):
        if store.name == "progress" and not calls:
            calls.append(1)
            write(store, world.progress_mart(spark, (11, world.OLD, "N"), (999, world.OLD, "N")), other, ("other", 0))
        write(store, *given)

    monkeypatch.setattr(ParquetMart, "apply", with_another)
    site.send(world.subject_message(11))
    site.run()
    rows = site.rows()
    # The insert date the other writer gave is kept, and its other row is there.
    assert set(rows) == {11, 999} and rows[11]["insert_date"] == world.OLD and rows[11]["course_run_nm"] == "run a"


def test_vanished_rows_are_flagged_on_request(spark, tmp_path):
    site = Site(spark, tmp_path, UpkeepOptions(missing="flag"))
    site.send(world.enroll_message(1), world.enroll_message(2))
    site.run()
    site.write_tables(learning=[row for row in world.ROWS["learning"] if row[0] != 21], enroll=[row for row in world.ROWS["enroll"] if row[0] != 2])
    site.send(world.subject_message(21), world.enroll_message(2), world.subject_message(404))
    site.run()
    assert {key: row["delete_yn"] for key, row in site.rows().items()} == {11: "N", 12: "N", 13: "N", 21: "Y"}
    assert site.rows()[21]["course_run_nm"] == "run b"
    assert {key: row["delete_yn"] for key, row in site.rows("enroll").items()} == {1: "N", 2: "Y"}
    with pytest.raises(ValueError, match="missing"):
        MartUpkeep(world.stored_tables(spark, tmp_path / "tables"), options=UpkeepOptions(on_error="skip", missing="x"))


def test_a_tombstone_batch_reads_learning_once(spark, tmp_path, monkeypatch):
    from martkeep.sources.tables import FileTables

    site = Site(spark, tmp_path, UpkeepOptions(tombstones=True))
    reads = []
    load = FileTables.load

    class Counting:
        """Learning rows that pass by are counted by the task that reads them."""

        def load(self, session):
            tables = load(world.stored_tables(session, tmp_path / "tables"), session)
            seen = session.sparkContext.accumulator(0)
            reads.append(seen)

            def passing(batches):
                for batch in batches:
                    seen.add(batch.num_rows)
                    yield batch

            counted = tables.learning.mapInArrow(passing, tables.learning.schema)
            return type(tables)(counted, tables.course_run, tables.course, tables.enroll, tables.learning_subject)

    job = MartUpkeep(
        Counting(), site.progress, None, UpkeepOptions(tombstones=True, policy=LookupPolicy(pushdown_keys=0)),
        quarantine_path=f"file:{tmp_path}/quarantine", audit_path=f"file:{tmp_path}/audit", clock=world.as_of,
    )
    job.process(world.raw(spark, world.enroll_message(1, "LMER02"), world.enroll_message(6, "LMER02"), world.subject_message(21)), 0)
    assert [seen.value for seen in reads] == [len(world.ROWS["learning"])]
    blank = {key for key, row in site.rows().items() if row["course_run_nm"] is None}
    assert set(site.rows()) == {11, 12, 13, 21, 41} and blank == {41}
