"""Chat formatting: the dialogue once for every participant, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkeep.llm.common import staged

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def rotate_perspectives(turns: DataFrame, apart: tuple[str, ...] = ("system",)) -> DataFrame:
    """The segments of every dialogue, seen by each of its participants.

    For each conv_id and each speaker in it (roles in ``apart`` do not speak) all turns are
    rendered with that speaker as assistant and the others as users under their names:
    ``<|assistant|>\\n...<|end|>\\n`` or ``<|user NAME|>\\n...<|end|>\\n``; roles in
    ``apart`` keep their own. Returns conv_id, perspective, turn, role, name, segment,
    learn, mask_start, mask_chars: learn is 1 for segments of the assistant, of which the
    text and the end mark are learned (mask_chars code points from mask_start), headers
    never. A dialogue is its segments in the order of turn. They stay rows, for a
    conversation may hold any number of turns and is never gathered: turns meet the
    speakers of their conversation in an inner join that adaptive execution splits.

    A conversation whose roles are all apart has no perspective and no rows. NULL roles are
    the speaker ``unknown``; NULL texts are empty; NULL conv_ids are one conversation; NULL
    and equal turns are kept, equal ones in no order of their own. Repeated rows are
    rendered as often. An empty table gives none. Other columns are not looked at.
    """
    said = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("name"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    aside = F.col("name").isin(*apart) if apart else F.lit(False)
    speakers = staged(
        said.where(~aside).select(F.col("conv_id").alias("of"), F.col("name").alias("perspective")).distinct(), "chat-speakers"
    )
    seen = said.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
    role = F.when(aside, F.col("name")).when(F.col("name") == F.col("perspective"), "assistant").otherwise("user")
    named = F.when(F.col("role") == "user", F.concat(F.lit("user "), "name")).otherwise(F.col("role"))
    head = F.concat(F.lit(OPEN), named, F.lit(CLOSE))
    learn = F.when((F.col("role") == "assistant") & ~aside, 1).otherwise(0)
    return seen.withColumn("role", role).select(
        "conv_id", "perspective", "turn", "role", "name",
        F.concat(head, "text", F.lit(END)).alias("segment"),
        learn.alias("learn"),
        F.length(head).cast("long").alias("mask_start"),
        F.when(learn == 1, F.length("text") + len(END)).otherwise(0).cast("long").alias("mask_chars"),
    )
