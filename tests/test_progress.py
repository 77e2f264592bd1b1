import pytest

import world
from martkeep import operators as ops
from martkeep import plans
from martkeep.operators import LookupPolicy

POLICIES = {
    "pushed": (LookupPolicy(), True),
    "broadcast": (LookupPolicy(pushdown_keys=0), True),
    "shuffled": (LookupPolicy(pushdown_keys=0, broadcast_keys=0), True),
    "unknown": (LookupPolicy(), False),
}


def rows_of(spark, *keys, mart=(), changes={}, **options):
    touched = world.keys(spark, "learning_seq", *keys)
    options.setdefault("one_per_key", True)
    rows = plans.progress_rows(
        touched,
        world.tables(spark, **changes),
        world.progress_mart(spark, *mart),
        world.as_of(),
        **options,
    )
    assert tuple(rows.columns) == world.PROGRESS_COLUMNS
    return rows


@pytest.mark.parametrize("way", POLICIES)
@pytest.mark.parametrize("one", [True, False])
def test_every_way_of_looking_up_gives_the_same_rows(spark, way, one):
    policy, known = POLICIES[way]
    size = 5 if known else None
    rows = rows_of(
        spark, 11, 12, 13, 21, 31, mart=[(11, world.OLD, "N")], one_per_key=one, policy=policy, size=size
    ).collect()
    facts = sorted(
        (r.learning_seq, r.course_run_nm, r.course_id, r.learner_seq, r.learning_subject_seq or 0,
         r.progress_ratio or 0, r.insert_date, r.delete_yn)
        for r in rows
    )
    top = [
        (11, "run a", "C1", 901, 3, 12.75, world.OLD, "N"),
        (12, "run a", "C1", 902, 4, 0, world.NOW, "N"),
        (13, "run a", "C1", 903, 0, 0, world.NOW, "N"),
        (21, "run b", "C2", 904, 5, 1.5, world.NOW, "Y"),
    ]
    fanned = [
        (11, "run a", "C1", 901, 1, 10.0, world.OLD, "N"),
        (11, "run a", "C1", 901, 2, 99.0, world.OLD, "N"),
        (12, "run a", "C1", 902, 0, 50.0, world.NOW, "N"),
    ]
    assert facts == sorted(top if one else top + fanned)


@pytest.mark.parametrize("size", [None, 5])
def test_no_row_without_enrolment_run_or_course(spark, size):
    assert rows_of(spark, 31, 41, 51, 61, 404, size=size).collect() == []
    assert rows_of(spark, 404, size=size).collect() == []


def test_flag_is_y_for_null_codes(spark):
    assert rows_of(spark, 5).first().delete_yn == "Y"
    changes = {"enroll": [(1, 100, None)]}
    assert rows_of(spark, 11, changes=changes).first().delete_yn == "Y"


def test_missing_numbers(spark):
    row = rows_of(spark, 13).first()
    assert (row.progress_ratio, row.learning_subject_seq) == (None, None)
    row = rows_of(spark, 13, null_numbers_as_zero=True).first()
    assert (row.progress_ratio, row.learning_subject_seq) == (0.0, 0)


@pytest.mark.parametrize(
    ("rule", "known", "expected"),
    [
        ("keep", (world.OLD, "N"), world.OLD),
        ("keep", (world.OLD, "Y"), world.OLD),
        ("keep", (None, "N"), world.NOW),
        ("keep", None, world.NOW),
        ("revive", (world.OLD, "N"), world.OLD),
        ("revive", (world.OLD, None), world.OLD),
        ("revive", (world.OLD, "Y"), world.NOW),
        ("revive", (None, "N"), None),
        ("revive", None, world.NOW),
    ],
)
def test_insert_dates(spark, rule, known, expected):
    mart = [(11, *known)] if known else []
    row = rows_of(spark, 11, mart=mart, insert_dates=rule).first()
    assert (row.insert_date, row.update_date) == (expected, world.NOW)


def test_unknown_rules_are_refused(spark):
    with pytest.raises(ValueError):
        rows_of(spark, 11, insert_dates="maybe")


def test_clock_is_the_query_time_by_default(spark):
    tables, mart = world.tables(spark), world.progress_mart(spark)
    row = plans.progress_rows(world.keys(spark, "learning_seq", 11), tables, mart).first()
    assert row.insert_date == row.update_date and row.update_date > world.NOW


def test_a_hot_learning_fans_out_completely(spark):
    subjects = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 1, id) AS k", "id AS subject", "CAST(id AS DOUBLE) AS ratio"
    )
    rows = spark.range(2000).selectExpr("id - 5 AS k", "id AS payload")
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 0L AS payload"))
    joined = ops.fan_out_left_join(rows, subjects, "k")
    plain = rows.join(subjects, "k", "left").select(*joined.columns)
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0


def test_merged_mart(spark):
    mart = world.progress_mart(spark, (11, world.OLD, "Y"), (999, world.OLD, "N"), (31, world.OLD, "N"))
    touched = world.keys(spark, "learning_seq", 11, 21, 31)
    merged = plans.merged_progress(touched, world.tables(spark), mart, world.as_of())
    found = world.by_key(merged, "learning_seq")
    assert set(found) == {11, 21, 31, 999}
    assert found[11]["course_run_nm"] == "run a" and found[11]["insert_date"] == world.OLD
    assert found[999]["update_date"] == world.OLD
    # A learning whose joins miss yields no row, so its mart row stays as it was.
    assert found[31]["course_run_nm"] is None and found[31]["update_date"] == world.OLD


def test_rows_as_a_view_of_a_query(spark):
    tables = world.tables(spark)
    mart = world.progress_mart(spark, (11, world.OLD, "N"))
    touched = world.keys(spark, "learning_seq", 11, 12, 13, 21)
    rows = plans.progress_rows(touched, tables, mart, world.as_of())
    named = {f"view_{name}": getattr(tables, name) for name in world.SCHEMAS}
    named |= {"view_touched": touched, "view_mart": mart, "view_rows": rows}
    text = """SELECT l.learning_seq, r.course_run_nm, c.course_id, r.course_run_seq, l.learner_seq,
          s.progress_ratio, s.learning_subject_seq,
          coalesce(m.insert_date, TIMESTAMP '2024-06-01 00:00:00') AS insert_date,
          TIMESTAMP '2024-06-01 00:00:00' AS update_date,
          if(c.course_type_cd = 'LMCT01' AND e.confirm_status_cd = 'LMER01', 'N', 'Y') AS delete_yn
        FROM view_touched JOIN view_learning l USING (learning_seq)
        JOIN view_enroll e ON e.enroll_seq = l.enroll_seq AND e.course_run_seq = l.course_run_seq
        JOIN view_course_run r ON r.course_run_seq = l.course_run_seq
        JOIN view_course c ON c.course_seq = r.course_seq
        LEFT JOIN view_learning_subject s ON s.learning_seq = l.learning_seq
        LEFT JOIN view_mart m ON m.learning_seq = l.learning_seq"""
    expected = plans.query_views(spark, text, named).collect()
    assert sorted(map(str, expected)) == sorted(map(str, spark.table("view_rows").collect())) and len(expected) == 7


def test_vanished_learnings_are_flagged_on_request(spark):
    mart = world.progress_mart(spark, (11, world.OLD, "N"), (31, world.OLD, None), (41, world.OLD, "Y"), (404, world.OLD, "N"), (999, world.OLD, "N"))
    touched = world.keys(spark, "learning_seq", 11, 31, 41, 404, 500)
    merged = plans.merged_progress(touched, world.tables(spark), mart, world.as_of(), missing="flag")
    found = {key: (row["delete_yn"], row["update_date"]) for key, row in world.by_key(merged, "learning_seq").items()}
    assert found == {
        11: ("N", world.NOW), 31: ("Y", world.NOW), 404: ("Y", world.NOW), 41: ("Y", world.OLD), 999: ("N", world.OLD),
    }
    with pytest.raises(ValueError):
        plans.merged_progress(touched, world.tables(spark), mart, world.as_of(), missing="drop")


def test_learnings_at_hand_are_not_looked_up_again(spark):
    from martkeep.sources.tables import SourceTables

    messages = [world.enroll_message(1), world.subject_message(21), world.subject_message(404), world.subject_message(12)]
    keys = ops.message_keys(ops.read_messages(world.raw(spark, *messages)))
    tables, mart = world.tables(spark), world.progress_mart(spark, (11, world.OLD, "N"))
    for bounds in ({}, {"n_enrolments": 1, "n_named": 3}, {"n_enrolments": 2000, "n_named": 3000}):
        learnings = ops.touched_learnings(keys, tables.learning, **bounds)
        assert {r.learning_seq: (r.n_enroll, r.n_named) for r in learnings.collect()} == {
            11: (1, None), 12: (1, 1), 13: (1, None), 21: (None, 1)
        }
        without = SourceTables(None, tables.course_run, tables.course, tables.enroll, tables.learning_subject)
        for one in (True, False):
            rows = plans.progress_rows(None, without, mart, world.as_of(), one_per_key=one, learning=learnings)
            expected = rows_of(spark, 11, 12, 13, 21, mart=[(11, world.OLD, "N")], one_per_key=one)
            assert sorted(map(str, rows.collect())) == sorted(map(str, expected.collect()))


def _scans(frame, *columns):
    """How often the plan that ran reads a file with all of these columns."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    lines = [line for line in plan.splitlines() if "FileScan" in line]
    return sum(all(f"{name}:" in line.split("ReadSchema")[-1] for name in columns) for line in lines)


@pytest.mark.parametrize("tombstones", [False, True])
def test_learning_is_read_once(spark, tmp_path, tombstones):
    world.stored_tables(spark, tmp_path / "tables")
    tables = world.stored_tables(spark, tmp_path / "tables").load(spark)
    messages = [world.enroll_message(1, "LMER02"), world.subject_message(21)]
    keys = ops.message_keys(ops.read_messages(world.raw(spark, *messages)))
    mart = world.progress_mart(spark)
    if tombstones:
        rows = plans.earlier_progress_rows(keys, tables, mart, world.as_of())
    else:
        rows = plans.progress_rows(None, tables, mart, world.as_of(), learning=ops.touched_learnings(keys, tables.learning), one_per_key=True)
    assert _scans(rows, "learning_seq", "enroll_seq") == 1
    assert _scans(rows, "learning_seq") == 2  # and the subjects


def test_rebuild_and_reconcile(spark):
    tables = world.tables(spark)
    mart = world.progress_mart(spark, (11, world.OLD, "N"), (999, world.OLD, "N"))
    rebuilt = plans.rebuild_progress(tables, mart, world.as_of())
    assert set(world.by_key(rebuilt, "learning_seq")) == {11, 12, 13, 21, 5}
    rows = plans.progress_rows(
        world.keys(spark, "learning_seq", 12, 13, 21, 5), tables, mart, world.as_of(), one_per_key=True
    )
    merged = ops.fold(mart, rows, "learning_seq")
    compare = [name for name in world.PROGRESS_COLUMNS[1:] if not name.endswith("_date")]
    found = plans.reconcile(merged, rebuilt, "learning_seq", compare).collect()
    assert sorted((row.side, row.learning_seq) for row in found) == [
        ("mart", 11),
        ("mart", 999),
        ("rebuild", 11),
    ]
