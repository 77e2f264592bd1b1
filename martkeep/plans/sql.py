"""SQL over the package's results: frames published as temporary views.

A view over a plan reads the tables at execution, so a query on it sees them as they stand.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def query_views(spark: SparkSession, text: str, views: Mapping[str, DataFrame]) -> DataFrame:
    """Register ``views`` as temporary views and run ``text``."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(text)
