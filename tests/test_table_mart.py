import pytest

from martkeep.sinks import TableMart
from martkeep.sources import CatalogTables
import world


def test_a_merge_needs_a_format_that_has_it(spark):
    """No such format is at hand, so only the request itself can be checked."""
    spark.sql("CREATE TABLE merge_target (k INT, a STRING) USING parquet")
    try:
        mart = TableMart("merge_target", "k")
        mart.prepare(spark, 0)
        assert mart.snapshot(spark).columns == ["k", "a"]
        rows = spark.createDataFrame([(1, "x")], "k INT, a STRING")
        with pytest.raises(Exception, match="MERGE"):
            mart.apply(rows, 0)
    finally:
        spark.sql("DROP TABLE merge_target")


def test_catalog_tables_are_read_anew(spark):
    names = {name: f"src_{name}" for name in world.SCHEMAS}
    try:
        for name, frame in world.frames(spark).items():
            frame.write.saveAsTable(names[name])
        source = CatalogTables(names)
        assert source.load(spark).course_run.count() == 4
        spark.sql("INSERT INTO src_course_run VALUES (500, 'run e', 1000)")
        assert source.load(spark).course_run.count() == 5
        assert source.load(spark).key_type("learning", "learning_seq") == "int"
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
