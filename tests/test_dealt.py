"""Tables are dealt to as many tasks as their size asks for, whatever adaptive execution would join."""

import duckdb
import pytest

from checks import views
from martkeep import operators as ops


def write_lineitem(folder, rows):
    values = ", ".join("(" + ", ".join("NULL" if v is None else str(v) for v in row) + ")" for row in rows)
    sql = f"SELECT * FROM (VALUES {values}) AS t(l_orderkey, l_linenumber, l_discount)"
    sql = f"SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::INT AS l_linenumber, l_discount::DOUBLE AS l_discount FROM ({sql})"
    duckdb.sql(f"COPY ({sql}) TO '{folder}/lineitem.parquet' (FORMAT parquet)")


@pytest.fixture
def lineitem(tmp_path):
    rows = [(k // 3, k % 3, k % 7) for k in range(3000)]
    rows += [(7, 1, 9), (7, 1, 8), (None, 1, 5), (None, 1, 6), (8, None, 4), (8, None, 3), (None, None, None)]
    write_lineitem(tmp_path, rows)
    return tmp_path, rows


def subjects_of(spark, folder, monkeypatch, n_bytes):
    monkeypatch.setattr(views, "TASK_BYTES", n_bytes, raising=False)
    return views.subjects(spark, str(folder))


def test_subject_tasks_grow_with_the_table(spark, lineitem, monkeypatch):
    folder, _ = lineitem
    size = (folder / "lineitem.parquet").stat().st_size
    few = subjects_of(spark, folder, monkeypatch, size)
    assert few.rdd.getNumPartitions() == 1
    many = subjects_of(spark, folder, monkeypatch, size // 20)
    assert many.rdd.getNumPartitions() in (20, 21)
    # Choosing the top subject adds its maps to these tasks, and no shuffle of single subjects.
    plan = ops.top_subject(many)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and plan.count("Exchange hashpartitioning(") == 2


def test_the_number_of_tasks_changes_no_subject(spark, lineitem, monkeypatch):
    folder, rows = lineitem
    best = {}
    for learning, number, ratio in rows:
        known = best.get((learning, number))
        best[learning, number] = ratio if known is None else known if ratio is None else max(known, ratio)
    for n_bytes in (1 << 30, 500):
        found = subjects_of(spark, folder, monkeypatch, n_bytes).collect()
        assert len(found) == len(best)
        assert {(r[0], r[1]): r[2] for r in found} == best


def test_subject_tasks_grow_with_rows_that_compress_well(spark, tmp_path, monkeypatch):
    sql = "SELECT (i // 4)::BIGINT AS l_orderkey, (i % 4)::INT AS l_linenumber, 0.5::DOUBLE AS l_discount FROM range(20000) r(i)"
    duckdb.sql(f"COPY ({sql}) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet, COMPRESSION zstd)")
    monkeypatch.setattr(views, "TASK_ROWS", 1000, raising=False)
    subjects = views.subjects(spark, str(tmp_path))
    assert (tmp_path / "lineitem.parquet").stat().st_size < views.TASK_BYTES
    assert subjects.rdd.getNumPartitions() == 20
    assert subjects.count() == 20000


def test_rows_are_counted_anew_when_a_table_changes(spark, tmp_path):
    write_lineitem(tmp_path, [(1, 1, 1)])
    assert views.rows_of(spark, str(tmp_path), "lineitem") == 1
    write_lineitem(tmp_path, [(k, 1, 1) for k in range(50)])
    assert views.rows_of(spark, str(tmp_path), "lineitem") == 50
