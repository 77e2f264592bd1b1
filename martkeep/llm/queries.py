"""The registered queries of this subpackage: thin, each through its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkeep.llm import alignment, bpe, brown, chat, fingerprint, jaccard, mixing, quality, sharding, toxicity, urls, warc, whitening
from martkeep.llm.common import fold, table
from martkeep.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_tokenizer() -> str:
    return vocabulary("word_bpe_49k.json")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = word_tokenizer()
    encoded = bpe.encode(docs, path).select("doc_id", "ids")
    return bpe.decode(encoded, path).select(
        "doc_id",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge_quality(docs).drop("text", "lang", "source", "n_lines")


RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge_urls(pages.select("page_id", "url"), RULES, urls.page_links(pages))


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


@query
def op6_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    model = brown.train_brown(docs.where(~F.col("held_out")).select("text"))
    return brown.score_texts(docs, model)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"), width=4, percent=85).drop("node", "row")


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    records = warc.read_archives(spark, folder, blocks=False)
    return warc.page_report(warc.assemble_captures(records))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train_toxicity(docs, labels.where(fold("doc_id", 5) != 0))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
        "patterns",
    )


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.component_table(table(spark, sf_dir, "embeddings"))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return alignment.align_corpus(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return sharding.assign_shards(docs, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
