"""JDBC is checked without a database server: options, statements and what they do.

The statements run in DuckDB, which knows ``ON CONFLICT`` and ``MERGE``; the MySQL form is
compared as text.
"""

import duckdb
import pytest

from martkeep.schema import ENROLL_SCHEMA, PROGRESS_SCHEMA
from martkeep.sinks.jdbc_mart import JdbcMart, create_statement, schema_problems, upsert_statement
from martkeep.sources import JdbcOptions, keyed_read
from martkeep.sources.jdbc import bounds_query, key_predicates, range_predicates, sample_query, splits_of, widths_of

OPTIONS = JdbcOptions("jdbc:mysql://db/x", "me", "secret", read_partitions=4)


def test_scan_options():
    plain = OPTIONS.reader_options("T")
    assert plain["dbtable"] == "T" and plain["user"] == "me" and "partitionColumn" not in plain
    split = OPTIONS.reader_options("T", "k", (1, 100))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"]) == ("k", "1", "100")
    assert split["numPartitions"] == "4"
    assert "partitionColumn" not in OPTIONS.reader_options("T", "k", (None, None))
    assert "partitionColumn" not in OPTIONS.reader_options("T", "k", (5, 5))
    assert bounds_query("T", "k") == "SELECT MIN(k) AS low, MAX(k) AS high FROM T"


def test_anonymous_connection():
    assert JdbcOptions("jdbc:x", driver="d").connection() == {"url": "jdbc:x", "driver": "d"}


def test_write_options_keep_the_table():
    options = OPTIONS.writer_options("S")
    assert options["truncate"] == "true" and options["dbtable"] == "S"


def test_mysql_statements():
    ddl = create_statement("M", ENROLL_SCHEMA, "enroll_seq")
    assert ddl == (
        "CREATE TABLE IF NOT EXISTS M (enroll_seq INT NOT NULL, course_run_seq INT,"
        " insert_date DATETIME(6) NULL, update_date DATETIME(6) NULL, delete_yn TEXT,"
        " PRIMARY KEY (enroll_seq))"
    )
    text = upsert_statement("M", "S", ("k", "a", "b"), "k")
    assert text == (
        "INSERT INTO M (k, a, b) SELECT k, a, b FROM (SELECT DISTINCT k, a, b FROM S) s"
        " ON DUPLICATE KEY UPDATE a = VALUES(a), b = VALUES(b)"
    )
    with pytest.raises(ValueError):
        upsert_statement("M", "S", ("k",), "k", "other")


@pytest.mark.parametrize("dialect", ["conflict", "merge"])
def test_statements_upsert(dialect):
    mart = JdbcMart(OPTIONS, "M", PROGRESS_SCHEMA, "learning_seq", dialect)
    db = duckdb.connect()
    db.execute(create_statement("M", mart.schema, mart.key, dialect))
    db.execute(create_statement(mart.staging, mart.schema, mart.key, dialect, True))
    db.execute("INSERT INTO M (learning_seq, course_id, delete_yn) VALUES (1, 'a', 'N'), (2, 'b', 'N')")
    db.execute(
        f"INSERT INTO {mart.staging} (learning_seq, course_id, progress_ratio)"
        " VALUES (2, 'c', 12.75), (3, 'd', NULL), (2, 'c', 12.75), (3, 'd', NULL)"
    )
    upsert = upsert_statement("M", mart.staging, mart.columns, mart.key, dialect)
    for _ in range(2):
        db.execute(upsert)
        found = db.execute(
            "SELECT learning_seq, course_id, progress_ratio, delete_yn FROM M ORDER BY 1"
        ).fetchall()
        assert found == [(1, "a", None, "N"), (2, "c", 12.75, None), (3, "d", None, None)]
    db.close()


def test_keyed_read_pushes_the_list(spark, tmp_path):
    spark.range(10).selectExpr("id AS k", "id AS v", "id AS w").write.parquet(f"{tmp_path}/t")
    read = keyed_read(spark.read.parquet(f"{tmp_path}/t"), "k", [3, 4], ["v"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(k, [3,4])]" in plan and "ReadSchema: struct<k:bigint,v:bigint>" in plan
    assert sorted(row.v for row in read.collect()) == [3, 4]


def test_types_and_staging_are_settable():
    types = {"string": "VARCHAR(600)", "delete_yn": "CHAR(1)"}
    ddl = create_statement("M", PROGRESS_SCHEMA, "learning_seq", types=types)
    assert "course_run_nm VARCHAR(600)" in ddl and "delete_yn CHAR(1)" in ddl and "255" not in ddl
    names = {JdbcMart(OPTIONS, "M", PROGRESS_SCHEMA, "learning_seq", writer=w).staging for w in ("", "a", "b-1")}
    assert names == {"M_staging", "M_staging_a", "M_staging_b_1"}


def test_a_snapshot_is_read_in_ranges_of_the_key(spark, monkeypatch):
    from martkeep.sinks import jdbc_mart

    asked = []
    monkeypatch.setattr(jdbc_mart, "key_bounds", lambda _, options, table, key: (1, 900))
    monkeypatch.setattr(jdbc_mart, "read_table", lambda *given: asked.append(given[2:]))
    mart = JdbcMart(OPTIONS, "M", PROGRESS_SCHEMA, "learning_seq")
    mart.snapshot(spark)
    assert asked == [("M", mart.columns, "learning_seq", (1, 900))]


def test_ranges_of_a_dense_stretch_hold_as_many_rows_each():
    db = duckdb.connect()
    # Half of all rows lie in a thousandth of the range of keys.
    db.execute("CREATE TABLE t AS SELECT range * 10 AS k FROM range(0, 200000) UNION ALL SELECT 1000001 + range FROM range(0, 200000) WHERE (1000001 + range) % 10 <> 0")
    n = db.execute("SELECT count(*) FROM t").fetchone()[0]
    text = sample_query("t", "k", n)
    sample = [row[0] for row in db.execute(text).fetchall()]
    assert 5_000 < len(sample) < 20_000
    conditions = range_predicates("k", splits_of(sample, 16))
    counts = [db.execute(f"SELECT count(*) FROM t WHERE {condition}").fetchone()[0] for condition in conditions]
    assert len(counts) == 16 and sum(counts) == n and max(counts) < 1.5 * n / 16
    widths = range_predicates("k", widths_of(range(0, 2_000_000), 16))
    assert max(db.execute(f"SELECT count(*) FROM t WHERE {condition}").fetchone()[0] for condition in widths) > 4 * n / 16
    db.execute("INSERT INTO t VALUES (NULL)")
    assert sum(db.execute(f"SELECT count(*) FROM t WHERE {condition}").fetchone()[0] for condition in conditions) == n + 1
    db.close()


def test_small_samples_and_tables():
    assert sample_query("t", "k", 19_999) is None and "MOD(k, 11)" in sample_query("t", "k", 100_000)
    assert splits_of([], 4) == [] and splits_of([5, 5, 5, 5], 4) == [] and splits_of([1, 2, 3, 4], 2) == [3]
    assert range_predicates("k", []) is None
    assert range_predicates("k", [5]) == ["k < 5 OR k IS NULL", "k >= 5"]
    assert widths_of(range(0, 100), 4) == [25, 50, 75]


def test_keys_are_looked_up_in_lists_of_a_thousand():
    conditions = key_predicates("k", [*range(2500), 7, -3])
    assert [condition.count(",") + 1 for condition in conditions] == [1000, 1000, 501]
    assert conditions[0].startswith("k IN (-3, 0, 1, ") and key_predicates("k", []) == []


def test_a_mart_is_looked_up_by_key(spark, monkeypatch):
    from martkeep.sinks import jdbc_mart

    asked = []
    monkeypatch.setattr(jdbc_mart, "key_bounds", lambda *_: (1, 900))
    monkeypatch.setattr(
        jdbc_mart, "read_table", lambda *given, **more: asked.append((given[2:], more)) or spark.createDataFrame([], PROGRESS_SCHEMA)
    )
    mart = JdbcMart(OPTIONS, "M", PROGRESS_SCHEMA, "learning_seq", lookup_keys=3000)
    keys = spark.range(2500).selectExpr("CAST(id AS INT) AS learning_seq")
    mart.lookup(spark, keys, 2500)
    mart.lookup(spark, keys, 4000)
    mart.lookup(spark, keys.limit(0), 0)
    (first, options), (second, _) = asked
    assert first == ("M", mart.columns) and [p.count(",") for p in options["predicates"]] == [999, 999, 499]
    assert second == ("M", mart.columns, "learning_seq", (1, 900))


def test_predicates_become_tasks():
    settings = OPTIONS.reader_options("T")
    assert settings["url"] == OPTIONS.url and settings["dbtable"] == "T" and settings["fetchsize"] == "10000"


def test_an_existing_table_is_checked():
    from pyspark.sql import types as T

    fine = T.StructType.fromDDL(
        "LEARNING_SEQ BIGINT, course_run_nm VARCHAR(60), course_id STRING, course_run_seq INT, learner_seq INT,"
        " progress_ratio DOUBLE, learning_subject_seq INT, insert_date TIMESTAMP_NTZ, update_date TIMESTAMP, delete_yn CHAR(1), more INT"
    )
    assert schema_problems(fine, PROGRESS_SCHEMA) == []
    poor = T.StructType.fromDDL("enroll_seq SMALLINT, course_run_seq DECIMAL(10,0), insert_date DATE, delete_yn STRING")
    assert schema_problems(poor, ENROLL_SCHEMA) == [
        "column enroll_seq is smallint, not int", "column course_run_seq is decimal(10,0), not int",
        "column insert_date is date, not timestamp", "no column update_date",
    ]
