"""Mixing sources to target weights by pivotal dependent rounding, in SQL functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkeep.llm.common import staged

#: Words are runs of anything but \x20 and \x09-\x0D.
WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
CHUNK = 64  # units that one fold sees, on average
BROADCAST_ROWS = 100_000  # sources sent to all executors; more are joined by a shuffle


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target): weights as shares of all words, at most 3 times a source.

    A source stops at MOST_COPIES times its size and the excess is shared out by weight
    again; where that ends, the others stand at one common level times their weight. That
    level follows from one pass over the sources in the order in which they fill up.
    There is one row per source, so this window is small beside the rows.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = per_source.withColumn("weight", F.element_at(weights, ((rank - 1) % len(WEIGHTS) + 1).cast("int")))
    cap = (MOST_COPIES * F.col("source_size")).cast("double")
    whole = Window.partitionBy(F.lit(0))
    filling = whole.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)

    def before(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(filling), F.lit(0.0))

    level = (F.sum("source_size").over(whole) - before(cap)) / (F.sum("weight").over(whole) - before(F.col("weight")))
    full = ranked.withColumn("full", cap / F.col("weight") <= level)
    left = F.sum("source_size").over(whole) - F.sum(F.when(F.col("full"), cap).otherwise(0.0)).over(whole)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(whole)
    return full.select(
        "source", "source_size", "rows",
        F.when(F.col("full"), cap).otherwise(F.least(cap, F.col("weight") * F.try_divide(left, open_weight))).alias("target"),
    )


def _pair(done_with: Column, kept: Column, p: Column, take: int, done: Column) -> Column:
    """The state after a pairing: one unit decided, the other left with probability ``p``."""
    decided = F.struct(done_with["doc_id"].alias("doc_id"), done_with["size"].alias("size"), done_with["n"].alias("n"), F.lit(take).alias("take"))
    left = F.struct(
        kept["mass"].alias("mass"), kept["u"].alias("u"), kept["doc_id"].alias("doc_id"), kept["size"].alias("size"),
        kept["n"].alias("n"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p"),
    )
    return F.struct(left.alias("left"), F.array_append(done, decided).alias("done"))


def _pivot(state: Column, b: Column) -> Column:
    """Move mass between the unit left over and the next one until one is at 0 or 1.

    The two directions are chosen with the odds that leave both expectations as they were,
    and what one unit gains in words the other loses.
    """
    a, done = state["left"], state["done"]
    room_a, room_b = (1 - a["p"]) * a["mass"], (1 - b["p"]) * b["mass"]
    mass_a, mass_b = a["p"] * a["mass"], b["p"] * b["mass"]
    to_a, to_b = F.least(room_a, mass_b), F.least(mass_a, room_b)
    chosen_a = b["u"] < F.coalesce(F.try_divide(to_b, to_a + to_b), F.lit(2.0))
    return (
        F.when(chosen_a & (room_a <= mass_b), _pair(a, b, b["p"] - to_a / b["mass"], 1, done))
        .when(chosen_a, _pair(b, a, a["p"] + to_a / a["mass"], 0, done))
        .when(mass_a <= room_b, _pair(a, b, b["p"] + to_b / b["mass"], 0, done))
        .otherwise(_pair(b, a, a["p"] - to_b / a["mass"], 1, done))
    )


def _uniform(*key: Column | str) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def _fold(open_units: DataFrame, chunks: Column, seed: int) -> DataFrame:
    """One level of the reduction tree: a fold per (source, chunk) that leaves one unit.

    The largest units come first: like meets like and is soon decided, so what is left in
    the end, and by how much a source can miss its target, is small.
    """
    element = "struct<mass:double,u:double,doc_id:bigint,size:bigint,n:bigint,p:double>"
    decided = "array<struct<doc_id:bigint,size:bigint,n:bigint,take:int>>"
    dealt = open_units.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), chunks))
    gathered = dealt.groupBy("source", "chunk").agg(
        F.sort_array(
            F.collect_list(
                F.struct("mass", _uniform("doc_id", "size", F.lit(seed + 1)).alias("u"), "doc_id", "size", "n", "p").cast(element)
            ),
            asc=False,
        ).alias("units")
    )
    start = F.struct(F.col("units")[0].alias("left"), F.array().cast(decided).alias("done"))
    rest = F.slice("units", F.lit(2), F.greatest(F.size("units") - 1, F.lit(0)))
    return gathered.select("source", F.aggregate(rest, start, _pivot).alias("state"))


def mix_units(sized: DataFrame, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, n, copies, source_size, target) per distinct (doc_id, source, size).

    ``sized`` has these three columns. n counts equal rows, which are taken alike.
    """
    sized = staged(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "mixing-units")
    wanted = staged(
        targets(sized.select("source", (F.col("size") * F.col("n")).alias("size"))).withColumnRenamed("source", "t_source"),
        "mixing-targets",
    )
    count = wanted.agg(F.count("*"), F.max("rows")).first()
    if count[0] <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    ratio = F.least(F.lit(float(MOST_COPIES)), F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    units = (
        sized.join(wanted, F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("base", F.floor(ratio).cast("int"))
        .withColumn("p", ratio - F.floor(ratio))
        .withColumn("mass", (F.col("size") * F.col("n")).cast("double"))
    )
    open_unit = (F.col("p") > 0) & (F.col("size") > 0)
    decided = [units.where(~open_unit).select("doc_id", "source", "size", "n", F.lit(0).alias("take"))]
    rows, left, level = count[1] or 0, units.where(open_unit), 0
    per_source = F.greatest(F.ceil(F.col("rows") / CHUNK), F.lit(1))
    while True:
        last = rows <= 1
        if last:
            take = (_uniform("doc_id", "size", F.lit(seed + 100)) < F.col("p")).cast("int")
            decided.append(left.select("doc_id", "source", "size", "n", take.alias("take")))
            break
        folded = staged(_fold(left, per_source, seed + 2 * level), f"mixing-level{level}")
        decided.append(folded.select("source", F.inline("state.done")).select("doc_id", "source", "size", "n", "take"))
        rows, level = -(-rows // CHUNK), level + 1
        left = folded.select("source", "state.left.*").join(
            wanted.select("t_source", F.ceil(F.col("rows") / CHUNK**level).alias("rows")),
            F.col("source").eqNullSafe(F.col("t_source")),
        )
    taken = reduce(DataFrame.unionByName, decided)
    return taken.join(wanted, F.col("source").eqNullSafe(F.col("t_source"))).select(
        "doc_id", "source", "size", "n",
        (F.when(F.col("size") > 0, F.floor(ratio)).otherwise(F.lit(0)) + F.col("take")).cast("long").alias("copies"),
        "source_size", "target",
    )


def size_of(text: str) -> Column:
    """Words of a text; 0 for a missing one."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of("text").alias("size")
    )


def mix_sources(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, copies, taken.

    Every document of a source has the same expected copies, target / source_size (at most
    3): the whole part is taken of each, the fractional part is a probability. Pivotal
    dependent rounding pairs two documents and moves words of expectation from one to the
    other until one is in or out. This is a fold over chunks of about 64 documents that
    leaves one undecided per chunk; those are chunked again, up a tree of log_64(n) levels,
    until one is left per source and drawn alone. So a source misses its target by at most
    one document. Random numbers are hashes of doc_id and size: reruns agree, whatever the
    partitions. Chunks are dealt by hash within a source, so a hot source is many chunks.

    Null and blank texts have size 0 and are not taken. A NULL source is a source, the last
    one. Rows that repeat doc_id, source and size are one unit and taken alike. NULL
    doc_ids are allowed. An empty table gives none. Other columns are not looked at.
    """
    mixed = mix_units(sized_documents(docs), seed)
    each = mixed.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
