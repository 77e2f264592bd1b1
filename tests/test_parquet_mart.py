import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

import world
from martkeep.operators import LookupPolicy
from martkeep.schema import PROGRESS_SCHEMA
from martkeep.sinks import BatchLog, ParquetMart
from martkeep.sinks.files import listed, put_if_absent, read_text

SCHEMA = "k INT, a STRING"


def rows(spark, *content):
    return spark.createDataFrame(list(content), SCHEMA)


def content(df):
    found = [tuple(row) for row in df.select("k", "a").collect()]
    assert len(found) == len({key for key, _ in found})
    return dict(found)


@pytest.fixture
def mart(spark, tmp_path):
    mart = ParquetMart(f"file:{tmp_path}/mart", SCHEMA, "k", buckets=3, fold_ratio=1e9)
    mart.create(spark, rows(spark, (1, "one"), (2, "two")))
    return mart


def test_upserts_and_earlier_states(spark, mart):
    assert content(mart.snapshot(spark)) == {1: "one", 2: "two"}
    mart.apply(rows(spark, (2, "2a"), (3, "3a")), 0)
    mart.apply(rows(spark, (3, "3b")), 1)
    mart.apply(rows(spark, (1, None)), 7)
    assert content(mart.snapshot(spark)) == {1: None, 2: "2a", 3: "3b"}
    assert content(mart.snapshot(spark, before=7)) == {1: "one", 2: "2a", 3: "3b"}
    assert content(mart.snapshot(spark, before=1)) == {1: "one", 2: "2a", 3: "3a"}
    assert content(mart.snapshot(spark, before=0)) == {1: "one", 2: "two"}


def test_a_repeated_batch_replaces_itself(spark, mart):
    mart.apply(rows(spark, (2, "first"), (3, "first")), 0)
    mart.apply(rows(spark, (2, "again")), 0)
    assert content(mart.snapshot(spark)) == {1: "one", 2: "again"}


def test_an_unfinished_batch_is_invisible(spark, mart, tmp_path):
    mart.apply(rows(spark, (2, "2a")), 0)
    (tmp_path / "mart" / "batch-000000000000" / "_SUCCESS").unlink()
    assert content(mart.snapshot(spark)) == {1: "one", 2: "two"}


def test_compaction_keeps_the_state(spark, mart):
    mart.apply(rows(spark, (2, "2a"), (3, "3a")), 0)
    mart.apply(rows(spark, (3, "3b")), 1)
    mart.compact(spark, before=2)
    assert [v.kind for v in mart.versions(spark)].count("full") == 2
    assert content(mart.snapshot(spark)) == {1: "one", 2: "2a", 3: "3b"}
    assert content(mart.snapshot(spark, before=1)) == {1: "one", 2: "2a", 3: "3a"}
    # A batch after the compaction may still repeat; it starts from the compacted state.
    for text in ("x", "y"):
        mart.apply(rows(spark, (1, text)), 2)
        assert content(mart.snapshot(spark)) == {1: text, 2: "2a", 3: "3b"}
    mart.compact(spark)
    mart.apply(rows(spark, (4, "4")), 3)
    assert content(mart.snapshot(spark)) == {1: "y", 2: "2a", 3: "3b", 4: "4"}


def test_old_versions_are_dropped(spark, mart):
    for batch in range(4):
        mart.apply(rows(spark, (batch, f"b{batch}")), batch)
        mart.compact(spark, before=batch + 1)
    kept = [(v.kind, v.number) for v in mart.versions(spark)]
    assert kept == [("batch", 3), ("full", 3), ("full", 4)] or kept == [
        ("full", 3), ("batch", 3), ("full", 4)
    ]
    assert content(mart.snapshot(spark)) == {0: "b0", 1: "b1", 2: "b2", 3: "b3"}


def test_overlays_outside_the_stream(spark, mart):
    mart.apply(rows(spark, (2, "2a")), 0)
    for text in ("v", "w", "x", "y", "z"):
        mart.overlay(rows(spark, (1, text), (7, text)), next_batch=1)
        assert content(mart.snapshot(spark)) == {1: text, 2: "2a", 7: text}
    mart.apply(rows(spark, (1, "later")), 1)
    assert content(mart.snapshot(spark)) == {1: "later", 2: "2a", 7: "z"}
    assert content(mart.snapshot(spark, before=1)) == {1: "z", 2: "2a", 7: "z"}


def test_folding_starts_when_batches_have_grown(spark, tmp_path):
    mart = ParquetMart(f"file:{tmp_path}/mart", SCHEMA, "k", buckets=2, max_batches=2, fold_ratio=1e9)
    mart.create(spark, rows(spark, (9, "nine")))
    for batch in range(3):
        mart.prepare(spark, batch)
        mart.apply(rows(spark, (batch, "x")), batch)
    assert ("layer", 2) in [(v.kind, v.number) for v in mart.versions(spark)]
    assert content(mart.snapshot(spark)) == {0: "x", 1: "x", 2: "x", 9: "nine"}
    greedy = ParquetMart(f"file:{tmp_path}/mart", SCHEMA, "k", buckets=2, fold_ratio=0.0)
    greedy.prepare(spark, 3)
    assert ("full", 3) in [(v.kind, v.number) for v in greedy.versions(spark)]
    assert content(greedy.snapshot(spark)) == {0: "x", 1: "x", 2: "x", 9: "nine"}


def test_a_new_session_finds_the_mart(spark, mart):
    mart.apply(rows(spark, (5, "5")), 0)
    for table in spark.catalog.listTables():
        if table.name.startswith("martkeep_"):
            spark.sql(f"DROP TABLE {table.name}")
    assert content(mart.snapshot(spark)) == {1: "one", 2: "two", 5: "5"}


def test_reading_does_not_shuffle_the_full_copy(spark, mart):
    mart.apply(rows(spark, (2, "2a")), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        snapshot = mart.snapshot(spark)
        plan = snapshot._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    anti = plan[plan.index("LeftAnti"):]
    base = anti[anti.index("FileScan"):]
    above_base = anti[: anti.index("FileScan")]
    assert "Exchange" not in above_base and "Bucketed: true" in base


def test_key_lists_prune_buckets(spark, mart):
    plan = mart.snapshot(spark).where("k IN (1)")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 3" in text and "In(k, [1])" in text or "EqualTo(k,1)" in text


def test_empty_mart_and_types(spark, tmp_path):
    mart = ParquetMart(f"file:{tmp_path}/mart", PROGRESS_SCHEMA, "learning_seq")
    assert mart.snapshot(spark).count() == 0
    mart.create(spark)
    wide = world.progress_mart(spark, (1, world.OLD, "N")).selectExpr(
        "CAST(learning_seq AS BIGINT) learning_seq",
        *[f"`{name}`" for name in world.PROGRESS_COLUMNS[1:]],
    )
    mart.apply(wide, 0)
    assert mart.snapshot(spark).dtypes[0] == ("learning_seq", "int")
    assert mart.snapshot(spark).first().insert_date == world.OLD


def test_a_new_run_goes_on_behind_the_last(spark, mart):
    for batch, text in enumerate(("a", "b")):
        number = mart.begin(spark, "run-one", batch)
        mart.apply(rows(spark, (batch, text)), number, ("run-one", batch))
    assert mart.begin(spark, "run-one", 1) == 1 and mart.begin(spark, "run-two", 0) == 2
    mart.compact(spark, before=2)
    number = mart.begin(spark, "run-two", 0)
    assert content(mart.snapshot(spark, before=number)) == {0: "a", 1: "b", 2: "two"}
    for text in ("first try", "second try"):
        assert mart.begin(spark, "run-two", 0) == number
        mart.apply(rows(spark, (1, text)), number, ("run-two", 0))
        assert content(mart.snapshot(spark)) == {0: "a", 1: text, 2: "two"}


def test_a_mart_without_a_complete_copy_is_not_empty(spark, mart, tmp_path):
    (full,) = (tmp_path / "mart").glob("full-*")
    (full / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError, match="no complete copy"):
        mart.snapshot(spark)


def test_a_quote_in_the_path(spark, tmp_path):
    mart = ParquetMart(f"file:{tmp_path}/it's", SCHEMA, "k", buckets=2)
    mart.create(spark, rows(spark, (1, "one")))
    mart.apply(rows(spark, (2, "two")), 0)
    for table in spark.catalog.listTables():
        if table.name.startswith("martkeep_"):
            spark.sql(f"DROP TABLE {table.name}")
    assert content(mart.snapshot(spark)) == {1: "one", 2: "two"}


def test_small_batches_never_rewrite_the_full_copy(spark, tmp_path):
    mart = ParquetMart(f"file:{tmp_path}/mart", SCHEMA, "k", buckets=2, max_batches=2, fold_ratio=1e9)
    mart.create(spark, rows(spark, (9, "nine")))
    want = {9: "nine"}
    for batch in range(9):
        mart.prepare(spark, batch)
        mart.apply(rows(spark, (batch % 3, f"b{batch}")), batch)
        want[batch % 3] = f"b{batch}"
        assert content(mart.snapshot(spark)) == want
    kinds = [v.kind for v in mart.versions(spark)]
    assert kinds.count("full") == 1 and kinds.count("layer") <= 2 and kinds.count("batch") <= 5
    mart.compact(spark)
    assert content(mart.snapshot(spark)) == want and mart.begin(spark, "r", 0) == 9


# --- several writers ------------------------------------------------------------------


def test_a_file_is_created_once(spark, tmp_path):
    path = f"file:{tmp_path}/folder/number"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, f"writer {i}"), range(16)))
    assert won.count(True) == 1 and read_text(spark, path) == f"writer {won.index(True)}"
    assert list(listed(spark, f"file:{tmp_path}/folder")) == ["number"] and listed(spark, f"file:{tmp_path}/none") == {}


def test_writers_that_begin_at_once_get_numbers_of_their_own(spark, mart):
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: mart.begin(spark, f"run-{i}", 0), range(8)))
    assert sorted(numbers) == list(range(8))
    assert [mart.begin(spark, f"run-{i}", 0) for i in range(8)] == numbers


@pytest.mark.parametrize("first", ["one", "two"])
def test_two_interleaved_writers_leave_one_row_per_key(spark, mart, first):
    numbers = {run: mart.begin(spark, run, 0) for run in ("one", "two")}
    second = {"one": "two", "two": "one"}[first]
    for run in (first, second):
        mart.prepare(spark, numbers[run])
        mart.apply(rows(spark, (1, run), (2 if run == "one" else 3, run)), numbers[run], (run, 0))
    assert content(mart.snapshot(spark)) == {1: "two", 2: "one", 3: "two"}


def test_nothing_is_folded_past_a_number_that_is_still_to_be_written(spark, tmp_path):
    mart = ParquetMart(f"file:{tmp_path}/mart", SCHEMA, "k", buckets=2, fold_ratio=0.0)
    mart.create(spark, rows(spark, (9, "nine")))
    slow = mart.begin(spark, "slow", 0)
    for batch in range(3):
        number = mart.begin(spark, "quick", batch)
        mart.prepare(spark, number)
        mart.apply(rows(spark, (1, f"quick {batch}")), number, ("quick", batch))
    mart.compact(spark)
    assert [v.number for v in mart.versions(spark) if v.kind == "full"] == [0]
    mart.apply(rows(spark, (1, "slow"), (2, "slow")), slow, ("slow", 0))
    assert content(mart.snapshot(spark)) == {1: "quick 2", 2: "slow", 9: "nine"}
    mart.compact(spark)
    assert [v.number for v in mart.versions(spark) if v.kind == "full"] == [0, 4]
    assert content(mart.snapshot(spark)) == {1: "quick 2", 2: "slow", 9: "nine"}


def test_a_number_that_lapsed_holds_nothing_up_and_is_refused(spark, tmp_path):
    mart = ParquetMart(f"file:{tmp_path}/mart", SCHEMA, "k", buckets=2, fold_ratio=0.0, lapse_hours=1)
    mart.create(spark, rows(spark, (9, "nine")))
    gone = mart.begin(spark, "gone", 0)
    number = mart.begin(spark, "here", 0)
    mart.apply(rows(spark, (1, "here")), number, ("here", 0))
    hours_ago = time.time() - 7200
    os.utime(tmp_path / "mart" / "_numbers" / f"{gone:012d}", (hours_ago, hours_ago))
    mart.compact(spark)
    assert content(mart.snapshot(spark)) == {1: "here", 9: "nine"}
    with pytest.raises(RuntimeError, match="lapsed"):
        mart.apply(rows(spark, (9, "late")), gone, ("gone", 0))
    assert mart.begin(spark, "gone", 0) == 2  # behind what was folded
    assert mart.begin(spark, "here", 0) == 3  # folded: a repetition goes on behind as well


def test_state_tells_of_another_writer(spark, mart):
    low, high = mart.begin(spark, "one", 0), mart.begin(spark, "two", 0)
    state = mart.state(spark, high)
    assert mart.state(spark, high) == state
    mart.apply(rows(spark, (1, "x")), low, ("one", 0))
    assert mart.state(spark, high) != state


def test_vacuum(spark, mart, tmp_path):
    root = tmp_path / "mart"
    failed = mart.begin(spark, "failed", 0)
    mart.apply(rows(spark, (1, "half")), failed, ("failed", 0))
    (root / f"batch-{failed:012d}-of-failed-0" / "_SUCCESS").unlink()
    kept = mart.begin(spark, "kept", 0)
    mart.apply(rows(spark, (2, "kept")), kept, ("kept", 0))
    assert mart.vacuum(spark) == []  # still young
    assert sorted(mart.vacuum(spark, older_than_hours=-1)) == [f"batch-{failed:012d}-of-failed-0", f"number {failed}"]
    assert not (root / f"batch-{failed:012d}-of-failed-0").exists()
    assert content(mart.snapshot(spark)) == {1: "one", 2: "kept"}
    assert mart.vacuum(spark, older_than_hours=-1) == []


# --- keyed reads ----------------------------------------------------------------------


def _files_read(frame):
    """Files that a frame's plan is bound to."""
    return set(frame.inputFiles())


@pytest.mark.parametrize("size", [None, 5000])
def test_thousands_of_keys_read_their_buckets_only(spark, tmp_path, size):
    mart = ParquetMart(f"file:{tmp_path}/mart", "k BIGINT, a STRING", "k", buckets=64, fold_ratio=1e9)
    mart.create(spark, spark.range(400_000).selectExpr("id AS k", "CAST(id AS STRING) AS a"))
    keys = spark.range(400_000).selectExpr("id AS k").where("pmod(hash(k), 64) IN (3, 17, 40)").limit(5000).cache()
    mart.apply(spark.createDataFrame([(keys.first()[0], "new"), (-1, "other")], "k BIGINT, a STRING"), 0)
    found = mart.lookup(spark, keys, size, policy=LookupPolicy())
    assert found.count() == 5000 and found.where("a = 'new'").count() == 1
    assert found.where("a <> 'new' AND a <> CAST(k AS STRING)").count() == 0
    full = {name.rsplit("_", 1)[1][:5] for name in map(os.path.basename, _files_read(found)) if "_000" in name}
    assert full == {"00003", "00017", "00040"} if size else len(full) == 64
    assert mart.lookup(spark, keys.limit(0), 0).count() == 0
    assert mart.lookup(spark, keys.limit(0), 2000).count() == 0


# --- one record for several marts -----------------------------------------------------


def test_batches_count_once_they_are_recorded(spark, tmp_path):
    log = BatchLog(f"file:{tmp_path}/log")
    marts = {
        name: ParquetMart(f"file:{tmp_path}/{name}", SCHEMA, "k", buckets=2, log=log, name=name) for name in ("left", "right")
    }
    for mart in marts.values():
        mart.create(spark, rows(spark, (1, "old")))
    for batch in range(3):
        numbers = {}
        for name, mart in marts.items():
            numbers[name] = mart.begin(spark, "Run-1", batch)
            mart.prepare(spark, numbers[name])
            mart.apply(rows(spark, (1, f"{name} {batch}"), (batch + 2, "x")), numbers[name], ("Run-1", batch))
            shown = [content(frame)[1] for frame in log.snapshots(spark, *marts.values())]
            assert shown == (["old", "old"] if not batch else [f"left {batch - 1}", f"right {batch - 1}"])
        assert log.record(spark, "Run-1", batch, numbers) and not log.record(spark, "Run-1", batch, numbers)
        assert [content(frame)[1] for frame in log.snapshots(spark, *marts.values())] == [f"left {batch}", f"right {batch}"]
    before = log.records(spark)
    log.fold(spark)
    log.fold(spark)
    assert log.records(spark) == before and len(listed(spark, f"file:{tmp_path}/log")) == 1
    assert [r.batch_id for r in before] == [0, 1, 2] and content(marts["left"].snapshot(spark))[1] == "left 2"
