"""Sharding by proportional stratified interleaving, in SQL functions only.

Rows are shuffled within their source by a seeded hash and ranked. A row's place in the whole
is its fractional rank within its source, so that any stretch of the whole holds every source
in proportion. Equal cuts of the whole are the shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkeep.llm.common import staged

#: Rows that one window sorts, on average, and buckets that one running sum goes over.
BUCKET_ROWS, BUCKETS_AT_ONCE = 256, 1024
HASH_BITS = 60  # 15 hexadecimal digits of a digest
IDENTITY = ("stratum", "shuffled", "doc_id", "size", "text_crc32", "row_hash")


def _digits(value: Column, n: int) -> Column:
    """The first ``n`` hexadecimal digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(value), 1, n), 16, 10).cast("long")


def identity(docs: DataFrame, seed: int, prefix: str = "") -> list[Column]:
    """What places a row, without its text: :data:`IDENTITY`, each name after ``prefix``."""
    text = F.col("text").cast("string")
    doc_id = F.col("doc_id").cast("long")
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit(":"), text), F.lit("")))
    return [
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias(f"{prefix}stratum"),
        _digits(said, 15).alias(f"{prefix}shuffled"),
        doc_id.alias(f"{prefix}doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias(f"{prefix}size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias(f"{prefix}text_crc32"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias(f"{prefix}row_hash"),
    ]


def rows_before(counts: DataFrame, by: list[str]) -> DataFrame:
    """``counts`` (by, bucket, n) with ``before``: the sum of n over lower buckets of its group.

    In two steps, so that no window goes over all buckets of a group: within stretches of
    :data:`BUCKETS_AT_ONCE` buckets, and over the stretches.
    """
    cut = counts.withColumn("stretch", F.floor(F.col("bucket") / BUCKETS_AT_ONCE))
    within = Window.partitionBy(*by, "stretch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*by).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = cut.groupBy(*by, "stretch").agg(F.sum("n").alias("total"))
    stretches = stretches.withColumn("ahead", F.coalesce(F.sum("total").over(over), F.lit(0))).drop("total")
    inner = cut.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return inner.join(stretches, [*by, "stretch"]).select(*by, "bucket", (F.col("ahead") + F.col("inner")).alias("before"))


def assign_shards(docs: DataFrame, shards: int = 8, seed: int = 13) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, stratum, rank, fraction, shard, slot.

    ``docs`` has doc_id, text and source. rank is a row's place among the rows of its source,
    shuffled by a hash of seed, doc_id and text; fraction is (rank - 1 + u) / rows of the
    source, with u in [0, 1) drawn by a hash of the source, so that small sources do not all
    meet in the middle. Rows in the order of fraction (then source, rank) are cut into
    ``shards`` stretches whose counts differ by one at most; slot counts from 0 within each.
    A shard holds its share of each source to within two rows and the error of its cuts.

    Ranks and places come from counts of buckets of about :data:`BUCKET_ROWS` rows, in the
    order of the hash or fraction, and windows within buckets: no task holds a source. Texts
    are read once and not shuffled.

    Missing and empty texts have size 1 and crc 0. A NULL source is a source of its own; NULL
    doc_ids are allowed. Rows alike in all columns are one entry with a count until they are
    ranked, hence a hot one is not gathered; they get ranks, and so places, next to each
    other in their source. Reruns agree, whatever the partitions. An empty table gives none.
    Columns other than the three only tell rows apart. Columns of a map type are not allowed.
    """
    rows = staged(docs.select(*identity(docs, seed)), "sharding-rows").groupBy(*IDENTITY).agg(F.count("*").alias("n"))
    strata = staged(rows.groupBy("stratum").agg(F.sum("n").alias("stratum_rows")), "sharding-strata")
    total, largest = strata.agg(F.coalesce(F.sum("stratum_rows"), F.lit(0)), F.coalesce(F.max("stratum_rows"), F.lit(0))).first()
    bits = max(0, (largest // BUCKET_ROWS).bit_length())
    rows = staged(rows.withColumn("bucket", F.shiftright("shuffled", HASH_BITS - bits)), "sharding-buckets")
    before = rows_before(rows.groupBy("stratum", "bucket").agg(F.sum("n").alias("n")), ["stratum"])
    start = Window.partitionBy("stratum", "bucket").orderBy(*IDENTITY[1:]).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("start", F.coalesce(F.sum("n").over(start), F.lit(0))).join(before, ["stratum", "bucket"])
    ranked = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    offset = _digits(F.concat(F.lit(f"{seed}:"), F.col("stratum")), 13).cast("double") / F.lit(float(16**13))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("start") + F.col("copy")).join(strata, "stratum")
    ranked = ranked.withColumn("fraction", ((F.col("rank") - 1).cast("double") + offset) / F.col("stratum_rows"))
    buckets = max(1, total // BUCKET_ROWS)
    placed = staged(
        ranked.select(*IDENTITY, "copy", "rank", "fraction", F.floor(F.col("fraction") * buckets).alias("bucket")), "sharding-ranks"
    )
    counts = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    before = rows_before(counts.withColumn("all", F.lit(0)), ["all"]).drop("all")
    order = Window.partitionBy("bucket").orderBy("fraction", "stratum", "rank")
    place = placed.withColumn("nth", F.row_number().over(order)).join(before, "bucket")
    place = place.withColumn("place", F.col("before") + F.col("nth") - 1)
    place = place.withColumn("shard", F.expr(f"place * {shards}L div {max(1, total)}L"))
    first = F.expr(f"(shard * {max(1, total)}L + {shards - 1}L) div {shards}L")
    return place.select(
        "doc_id", "size", "text_crc32", "stratum", "rank", "fraction",
        F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"),
        "shuffled", "row_hash", "copy",
    )


def write_shards(docs: DataFrame, folder: str, shards: int = 8, seed: int = 13, files: int = 64) -> None:
    """Whole rows of ``docs`` as Parquet below ``folder``, one folder per shard, in the order of slot.

    About ``files`` files in all, cut by ranges of (shard, slot), so a shard is not one task.
    Rows alike in all columns are looked up once and written as often as they occur.
    """
    places = assign_shards(docs, shards, seed).select(*[F.col(c).alias(f"place_{c}") for c in IDENTITY], "shard", "slot")
    own = [f"row_{c}" for c in IDENTITY]
    with_key = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), *identity(docs, seed, "row_"))
    once = with_key.groupBy(*own).agg(F.first("whole").alias("whole"))
    same = [F.col(f"row_{c}").eqNullSafe(F.col(f"place_{c}")) for c in IDENTITY]
    rows = once.join(places, same).select("whole", "shard", "slot")
    rows = rows.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").parquet(folder)
