"""Documents through quality rules, toxicity, near duplicates, mixing and encoding."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkeep.llm import bpe, jaccard, mixing, quality, toxicity
from martkeep.llm.common import BATCH, SMALL_GROUPS, staged, table
from martkeep.llm.queries import word_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows that a task reads at once: whole texts, and Spark's 4096 are arrays of many MB that make an executor's heap grow for good.
READ = {"spark.sql.parquet.columnarReaderBatchSize": "256"}


def small_batches(stage: Stage) -> Stage:
    """``stage`` with the batches of its session bounded; they count when its result is read, so they stay."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in (BATCH | READ).items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return bounded


@small_batches
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.judge_quality(docs).where("kept").select(*DOCUMENTS)


@small_batches
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labels, does not call toxic."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train_toxicity(docs, labels)
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(*DOCUMENTS)


#: So many kept rows, 16 bytes each, are sent to the tasks that read the texts.
BROADCAST_ROWS = 1_000_000
#: So many units of the mix, some 60 bytes each; more are shuffled, and the texts with them.
BROADCAST_UNITS = 500_000


@small_batches
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingles 80 % alike: that of the lowest doc_id.

    Of several rows of a group under that doc_id one stays, whichever text it has; a group
    under the same doc_id but of other texts keeps a row of its own. Rows without doc_id or
    without words, which the join compares with nothing, all stay.
    """
    row = F.xxhash64(*DOCUMENTS)
    groups = jaccard.jaccard_groups(docs, width=5, percent=80, row=row).where("node IS NOT NULL")
    rows = groups.groupBy("node", "doc_id", "row").agg(F.count("*").alias("n"))
    first = rows.groupBy("node").agg(F.min(F.struct("doc_id", "row", "n")).alias("first")).select("first.*")
    first = staged(first.select(F.col("doc_id").alias("first_id"), F.col("row").alias("first_row"), "n"), "pipeline-chosen")
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    kept = docs.select(*DOCUMENTS).join(first, (F.col("doc_id") == F.col("first_id")) & (row == F.col("first_row")))
    once = kept.where("n = 1").select(*DOCUMENTS)
    again = kept.where("n > 1").groupBy("first_id", "first_row").agg(F.first(F.struct(*DOCUMENTS)).alias("whole")).select("whole.*")
    apart = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(mixing.WORDS), F.lit(False))
    return once.unionByName(again).unionByName(docs.where(apart).select(*DOCUMENTS))


@small_batches
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, or up to three times."""
    sized = docs.select(*DOCUMENTS).withColumn("size", mixing.size_of("text"))
    units = mixing.mix_units(sized.select("doc_id", "source", "size")).where("copies > 0")
    taken = staged(units.select(*[F.col(c).alias(f"u_{c}") for c in ("doc_id", "source", "size")], "copies"), "pipeline-taken")
    if taken.count() <= BROADCAST_UNITS:  # else all texts would be sorted for the join
        taken = F.broadcast(taken)
    same = [F.col(c).eqNullSafe(F.col(f"u_{c}")) for c in ("doc_id", "source", "size")]
    mixed = sized.join(taken, same).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return mixed.select(*DOCUMENTS)


@small_batches
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to what the tokens spell.

    The ids are written in between: in one pass each task would have two Python workers at
    once, and both stay with the executor.
    """
    path = word_tokenizer()
    encoded = bpe.encode(docs.select("doc_id", "source", "lang", "text"), path).drop("text")
    encoded = staged(encoded, "pipeline-encoded", SMALL_GROUPS)
    return bpe.decode(encoded, path).select(
        "doc_id", "source", "lang", bpe.n_tokens().alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

#: Learned scores and token ids are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; each stage reads what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
