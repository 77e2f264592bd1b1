import pytest

import world
from martkeep import plans
from martkeep.operators import LookupPolicy


def rows_of(spark, *keys, mart=(), **options):
    rows = plans.enroll_rows(
        world.keys(spark, "enroll_seq", *keys),
        world.tables(spark),
        world.enroll_mart(spark, *mart),
        world.as_of(),
        **options,
    )
    assert tuple(rows.columns) == world.ENROLL_COLUMNS
    return world.by_key(rows, "enroll_seq")


@pytest.mark.parametrize("size", [None, 3])
@pytest.mark.parametrize("pushdown", [0, 1000])
def test_new_and_known_enrolments(spark, size, pushdown):
    policy = LookupPolicy(pushdown_keys=pushdown)
    found = rows_of(spark, 1, 2, 404, mart=[(2, 777, world.OLD)], size=size, policy=policy)
    assert set(found) == {1, 2}
    assert found[1] == {
        "enroll_seq": 1,
        "course_run_seq": None,
        "insert_date": world.NOW,
        "update_date": world.NOW,
        "delete_yn": "N",
    }
    assert found[2]["course_run_seq"] == 777 and found[2]["insert_date"] == world.OLD


def test_course_run_from_the_enrolment(spark):
    found = rows_of(spark, 1, 2, mart=[(2, 777, world.OLD)], course_run_from="enroll")
    assert (found[1]["course_run_seq"], found[2]["course_run_seq"]) == (100, 200)
    with pytest.raises(ValueError):
        rows_of(spark, 1, course_run_from="elsewhere")


def test_merge_and_rebuild(spark):
    tables, mart = world.tables(spark), world.enroll_mart(spark, (2, 777, world.OLD), (404, 1, world.OLD))
    merged = plans.merged_enroll(world.keys(spark, "enroll_seq", 1), tables, mart, world.as_of())
    assert set(world.by_key(merged, "enroll_seq")) == {1, 2, 404}
    rebuilt = plans.rebuild_enroll(tables, mart, world.as_of())
    assert set(world.by_key(rebuilt, "enroll_seq")) == set(range(1, 9))


def test_rows_as_a_view_of_a_query(spark):
    tables, mart = world.tables(spark), world.enroll_mart(spark, (2, 777, world.OLD))
    touched = world.keys(spark, "enroll_seq", 1, 2)
    rows = plans.enroll_rows(touched, tables, mart, world.as_of())
    named = {"view_touched": touched, "view_enroll": tables.enroll, "view_mart": mart, "view_rows": rows}
    text = """SELECT e.enroll_seq, m.course_run_seq,
        coalesce(m.insert_date, TIMESTAMP '2024-06-01 00:00:00') AS insert_date,
        TIMESTAMP '2024-06-01 00:00:00' AS update_date, 'N' AS delete_yn
        FROM view_touched JOIN view_enroll e USING (enroll_seq) LEFT JOIN view_mart m USING (enroll_seq)"""
    expected = plans.query_views(spark, text, named).collect()
    assert sorted(map(str, expected)) == sorted(map(str, spark.table("view_rows").collect())) and len(expected) == 2


def test_vanished_enrolments_are_flagged_on_request(spark):
    mart = world.enroll_mart(spark, (2, 777, world.OLD), (404, 1, world.OLD), (405, 1, world.OLD))
    keys = world.keys(spark, "enroll_seq", 1, 404, 500)
    kept = plans.merged_enroll(keys, world.tables(spark), mart, world.as_of())
    assert world.by_key(kept, "enroll_seq")[404]["delete_yn"] == "N"
    flagged = world.by_key(plans.merged_enroll(keys, world.tables(spark), mart, world.as_of(), missing="flag"), "enroll_seq")
    assert {key: row["delete_yn"] for key, row in flagged.items()} == {1: "N", 2: "N", 404: "Y", 405: "N"}
    assert (flagged[404]["update_date"], flagged[404]["insert_date"], flagged[404]["course_run_seq"]) == (world.NOW, world.OLD, 1)
    with pytest.raises(ValueError):
        plans.merged_enroll(keys, world.tables(spark), mart, world.as_of(), missing="drop")
