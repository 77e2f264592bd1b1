import pytest

import world
from martkeep import operators as ops


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k INT, a STRING, b INT")


def content(df):
    return sorted(tuple(row) for row in df.select("k", "a", "b").collect())


def test_a_new_row_wins_as_a_whole(spark):
    mart = frame(spark, (1, "x", 1), (2, "y", 2))
    rows = frame(spark, (2, None, None), (3, "z", 3))
    expected = [(1, "x", 1), (2, None, None), (3, "z", 3)]
    for fold in (ops.fold, ops.fold_delta):
        once = fold(mart, rows, "k")
        assert once.columns == mart.columns
        result = {row[0]: tuple(row) for row in once.collect()}
        assert [result[key] for key in (1, 2, 3)] == expected
        twice = {row[0]: tuple(row) for row in fold(once, rows, "k").collect()}
        assert twice == result


def test_one_per_key_prefers_high_values_and_nulls_last(spark):
    rows = frame(
        spark, (1, "p", None), (1, "q", 5), (1, "r", 4), (2, "s", None), (3, "t", 7), (3, None, 7)
    )
    kept = ops.one_per_key(rows, "k", ("b", "a"))
    assert kept.columns == rows.columns
    assert content(kept) == [(1, "q", 5), (2, "s", None), (3, "t", 7)]


def test_top_subject_matches_the_choice_after_the_fan_out(spark):
    subjects = world.tables(spark).learning_subject
    order = ("learning_subject_seq", "progress_ratio")
    one = ops.one_per_key(subjects, "learning_seq", order)
    best = ops.top_subject(subjects)
    assert sorted(map(str, best.select(*one.columns).collect())) == sorted(map(str, one.collect()))


def test_subjects_are_chosen_by_hashing(spark):
    subjects = world.tables(spark).learning_subject
    plan = ops.top_subject(subjects)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    ties = spark.createDataFrame(
        [(1, 2, 5.0), (1, 2, 7.0), (2, None, 1.0), (2, None, 3.0), (3, 4, None), (4, None, None), (4, 1, None)],
        "learning_seq INT, learning_subject_seq INT, progress_ratio DOUBLE",
    )
    found = {r.learning_seq: (r.learning_subject_seq, r.progress_ratio) for r in ops.top_subject(ties).collect()}
    assert found == {1: (2, 7.0), 2: (None, 3.0), 3: (4, None), 4: (1, None)}


@pytest.mark.parametrize("name", ["merge_progress", "rebuild_progress", "lookup_top_subject"])
def test_mart_queries_do_not_sort_to_aggregate(spark, name):
    from checks.catalog import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
