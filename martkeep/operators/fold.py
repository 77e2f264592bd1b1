"""One row per key, stamping with dates, and folding new rows into a mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeep.functions.dates import insert_date


def top_subject(subjects: DataFrame) -> DataFrame:
    """The subject row a learning is shown with: highest number, then highest ratio.

    Aggregated before any join, so a learning with very many subjects is reduced on the
    map side and never multiplies rows. First the best ratio per subject, then the subject:
    both by hashing, where a struct as a maximum would sort every subject row.
    """
    per_subject = subjects.groupBy("learning_seq", "learning_subject_seq").agg(
        F.max("progress_ratio").alias("progress_ratio")
    )
    # A learning may have only a subject without number, which the maximum would not see.
    number = F.coalesce(F.col("learning_subject_seq").cast("bigint"), F.lit(-(2**63)))
    return per_subject.groupBy("learning_seq").agg(
        F.max("learning_subject_seq").alias("learning_subject_seq"),
        F.max_by("progress_ratio", number).alias("progress_ratio"),
    )


def one_per_key(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """Keep one row per ``key``: the greatest in ``order``, NULLs last."""
    rest = [name for name in rows.columns if name != key and name not in order]
    ordered = F.struct(*order, *rest)
    kept = rows.groupBy(key).agg(F.max(ordered).alias("_kept"))
    return kept.select(key, "_kept.*").select(*rows.columns)


def stamp(
    rows: DataFrame,
    mart: DataFrame,
    key: str,
    as_of: Column,
    rule: str = "keep",
) -> DataFrame:
    """Look up each row's mart entry and add ``insert_date`` and ``update_date``."""
    wanted = [F.col(key).alias("_mart_key"), F.col("insert_date").alias("_known")]
    flag = None
    if rule == "revive":
        wanted.append(F.col("delete_yn").alias("_known_flag"))
        flag = F.col("_known_flag")
    joined = rows.join(mart.select(*wanted), F.col(key) == F.col("_mart_key"), "left")
    first = insert_date(
        F.col("_known"), as_of, rule, present=F.col("_mart_key").isNotNull(), known_flag=flag
    )
    return (
        joined.withColumn("insert_date", first)
        .withColumn("update_date", as_of)
        .drop("_mart_key", "_known", "_known_flag")
    )


def fold(mart: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The mart after an upsert of ``rows`` (one per key): a new row wins.

    A full outer join, so ``rows`` is computed once and each side shuffled once.
    """
    columns = mart.columns
    new = rows.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    old = mart.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    joined = old.join(new, F.col("_old_key") == F.col("_key"), "full")
    fresh = F.col("_key").isNotNull()
    return joined.select(
        *(
            F.when(fresh, F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}")).alias(name)
            for name in columns
        )
    )


def flag_missing(rows: DataFrame, known: DataFrame, key: str, as_of: Column) -> DataFrame:
    """``rows`` (one per key) and, of the mart rows ``known``, those that got none, flagged as deleted.

    ``known`` holds the mart rows of the touched keys. A row that has gone keeps its columns
    but for ``delete_yn`` and ``update_date``; one that is flagged already is left alone. One
    join, so ``rows`` is computed once.
    """
    columns = rows.columns
    new = rows.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    gone = [
        {"delete_yn": F.lit("Y"), "update_date": as_of}.get(name, F.col(name))
        .cast(rows.schema[name].dataType).alias(name)
        for name in columns
    ]
    old = known.select(F.col(key).alias("_old_key"), F.struct(*gone).alias("_old"), (F.col("delete_yn") == "Y").alias("_flagged"))
    joined = old.join(new, F.col("_old_key") == F.col("_key"), "full")
    joined = joined.where("_key IS NOT NULL OR NOT coalesce(_flagged, false)")
    return joined.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def fold_delta(mart: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """:func:`fold` for ``rows`` that are stored already and small beside the mart.

    An anti join leaves the mart where it is whenever the keys can be broadcast or the
    mart is bucketed by key; ``rows`` is read twice.
    """
    kept = mart.join(rows.select(key), key, "left_anti")
    return kept.select(*mart.columns).unionByName(rows.select(*mart.columns))
