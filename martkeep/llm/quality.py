"""Quality rules whose thresholds adapt to each language and source."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeep.llm.common import staged

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
COUNT_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more in the same text."""
    n = len(words)
    if n < 4:
        return 0
    place: dict[bytes, int] = {}
    ids = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, n)
    v = len(place)
    pairs = ids[:-1] * v + ids[1:]
    if v > 1_500_000:  # the triple would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    keys = pairs[:-1] * v + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """:data:`COUNTS` of one whole text; all 0 for a missing one."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    spaces = len(raw) - sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text) - spaces,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


@F.arrow_udf(COUNT_TYPE)
def _counts(texts: pa.Array) -> pa.Array:
    rows = np.array([text_counts(t) for t in texts.to_pylist()], np.int64).reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], list(COUNTS))


def rates(counts: str) -> dict[str, Column]:
    """What the thresholds are set on, by name; NULL where there is no word."""
    at = {name: F.col(f"{counts}.{name}") for name in COUNTS}
    some = at["n_words"] > 0
    return {
        "symbols": F.when(some, at["n_symbols"] / at["word_chars"]),
        "dup_lines": F.when(some, at["n_dup_lines"] / at["n_lines"]),
        "repeats": F.when(some, at["n_repeat_words"] / at["n_words"]),
        "word_length": F.when(some, at["word_chars"] / at["n_words"]),
    }


#: Added to every limit, so that sources whose texts are all alike admit small differences.
MARGINS = {"symbols": 0.01, "dup_lines": 0.10, "repeats": 0.05, "word_length": 0.6}
#: Rates that are 0 in most texts, and how far from the middle of a source's texts to its
#: 99 % point their limit lies. Texts full of symbols are a kind of their own, far from
#: prose, and make the point themselves; repeated lines and words only come by degrees.
REACH = {"symbols": 0.125, "dup_lines": 1.5, "repeats": 2.0}
#: So many thresholds (some 10 MB) are sent to all executors; more are shuffled.
BROADCAST_ROWS = 100_000
BASE_MIN_WORDS, BASE_REPEAT_PERCENT = 50, 50


def thresholds(rated: DataFrame, spread: float, least: int, k: int) -> DataFrame:
    """Limits per (lang, source) from mergeable quantile sketches of texts that pass the base rules.

    One KLL sketch per rate and (lang, source) is built where the rows are and merged; the
    sketches of a language are merged from those of its sources, without another pass.
    An upper limit is q3 + spread * (q3 - q1), word lengths have a lower one likewise. Rates
    that are 0 in most texts have no such quartiles: their limit is q50 + reach * (q99 - q50)
    at least, see :data:`REACH`. To all :data:`MARGINS` are added. The source's sketch is used where that
    has seen ``least`` texts and the language's otherwise. The limit of repeats stays below
    that of the base rules.
    """
    names = list(MARGINS)
    per_source = rated.groupBy("lang", "source").agg(
        F.count("symbols").alias("n"),
        *[F.kll_sketch_agg_double(name, k).alias(name) for name in names],
    )
    per_lang = per_source.where("n > 0").groupBy(F.col("lang").alias("of_lang")).agg(
        F.sum("n").alias("lang_n"),
        *[F.kll_merge_agg_double(name, k).alias(f"lang_{name}") for name in names],
    )
    both = per_source.where("n > 0").join(per_lang, F.col("lang").eqNullSafe(F.col("of_lang")))

    def quantiles(name: str, *at: float) -> list[Column]:
        sketch = F.when(F.col("n") >= least, F.col(name)).otherwise(F.col(f"lang_{name}"))
        return [F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in at]

    def limit(name: str) -> Column:
        q1, q2, q3, q90, q99 = quantiles(name, 0.25, 0.5, 0.75, 0.9, 0.99)
        most = q3 + spread * (q3 - q1)
        if name in REACH:
            most = F.greatest(most, q2 + REACH[name] * (q99 - q2))
        most = most + MARGINS[name]
        if name == "repeats":
            most = F.least(most, (q90 + BASE_REPEAT_PERCENT / 100) / 2)
        return most.alias(f"max_{name}")

    q1, q3 = quantiles("word_length", 0.25, 0.75)
    return both.select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *map(limit, names),
        (q1 - spread * (q3 - q1) - MARGINS["word_length"]).alias("min_word_length"),
    )


def judge_quality(
    docs: DataFrame, spread: float = 6.0, least: int = 200, sketch_k: int = 1000
) -> DataFrame:
    """``docs`` with its counts, ``base_failed`` and ``kept``; no row is lost or added.

    kept is false if base_failed (fewer than 50 words, or over half of the words in
    repeated three-word windows), else it says whether every rate is within the limits of
    the document's language and source. Thresholds are one row per (lang, source), counted
    and then broadcast; beyond :data:`BROADCAST_ROWS` they are joined by a shuffle whose
    left side adaptive execution splits. NULL languages and sources are groups of their own.

    Null or blank texts have counts of 0 and fail. Repeated rows are judged alike and all
    returned. Columns of ``docs`` that bear the name of an output are replaced; others
    pass through. Equal rates (ties) at a limit are within it. An empty table gives none.
    """
    outputs = [*COUNTS, "base_failed", "kept"]
    docs = docs.drop(*outputs, "quality_counts")
    # Not to be copied into filters above it: a task would count twice, in two Python workers.
    counted = docs.withColumn("quality_counts", _counts.asNondeterministic()(F.col("text").cast("string")))
    n_words = F.col("quality_counts.n_words")
    failed = (n_words < BASE_MIN_WORDS) | (
        100 * F.col("quality_counts.n_repeat_words") > BASE_REPEAT_PERCENT * n_words
    )
    of = rates("quality_counts")
    rated = counted.select(
        F.col("lang").cast("string"), F.col("source").cast("string"),
        *[F.when(~failed, c).alias(name) for name, c in of.items()],
    )
    limits = staged(thresholds(rated, spread, least, sketch_k), "quality-limits")
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    bounds = [c <= F.col(f"max_{name}") for name, c in of.items()] + [of["word_length"] >= F.col("min_word_length")]
    within = reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(True)) for c in bounds])
    joined = counted.join(
        limits,
        F.col("lang").cast("string").eqNullSafe(F.col("t_lang"))
        & F.col("source").cast("string").eqNullSafe(F.col("t_source")),
        "left",
    )
    return joined.select(
        *[F.col(f"`{name}`") for name in docs.columns],
        *[F.col(f"quality_counts.{name}").alias(name) for name in COUNTS],
        failed.alias("base_failed"),
        (~failed & within).alias("kept"),
    )
