"""Small tables with everything a column can hold, and brute-force forms of the operators."""

from __future__ import annotations

import random
from collections import defaultdict

DOC_TYPE = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of the input that bear names of outputs or of inner columns.
CLASHING = (
    "score", "kept", "base_failed", "n_words", "predicted", "patterns", "ids", "decoded", "fingerprint", "size", "taken", "copies", "row",
    "sid", "n", "component_id", "held_out", "n_tokens",
)


def prose(rnd: random.Random, words: int, vocabulary: int = 300) -> str:
    return " ".join(f"w{int(rnd.random() ** 2 * vocabulary)}" + ("." if rnd.random() < 0.1 else "") for _ in range(words))


def messy_rows(seed: int = 3) -> list[tuple]:
    """Nulls in every column, blank and long texts, copies, near copies, repeated rows, odd characters."""
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, rnd.choice((5, 60, 120, 200))), rnd.choice(("en", "fr", None)), rnd.choice(("a", "b", "c", None)), 1) for i in range(60)]
    base = prose(rnd, 150, 5000).split()
    for i in range(60, 90):
        copy = list(base)
        for _ in range(rnd.randrange(6)):
            copy[rnd.randrange(len(copy))] = f"edit{rnd.randrange(1000)}"
        rows.append((i, " ".join(copy), "en", "a", 1))
    rows += [(100 + i, rows[7][1], "en", "a", None) for i in range(5)]
    rows += [
        (200, None, "en", "a", 0), (201, "", "en", "a", 0), (202, " \n\t ", None, None, 0), (None, rows[3][1], "en", "b", 1), (None, None, None, None, None),
        (203, "one two three", "fr", "b", 1), (204, "ONE two THREE", "fr", "b", 1), (205, "Ünï çödé 日本語 \x1c x ½", "fr", "c", 1),
        (206, prose(rnd, 30_000, 20_000), "en", "a", 1), (207, "same " * 500, "en", "a", 1), (208, "x" * 50_000, "en", "c", 1),
    ]
    return rows + [rows[5]] * 3 + [(6, "another text under an id that is taken", "en", "a", 1)]


def documents(spark, rows=None, clashing: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(messy_rows() if rows is None else rows, DOC_TYPE)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING]) if clashing else df


def gram_set(text: str | None, width: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_groups(rows: list[tuple], width: int, percent: int) -> list[tuple]:
    """Sorted (doc_id, n, component) of (doc_id, text) rows by comparing all sets."""
    by_set = defaultdict(list)
    for i, text in rows:
        if i is not None and (s := gram_set(text, width)):
            by_set[s].append(i)
    sets = list(by_set)
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = {}
    for k, s in enumerate(sets):
        low[find(k)] = min(low.get(find(k), 1 << 60), *by_set[s])
    place = {s: k for k, s in enumerate(sets)}
    out = []
    for i, text in rows:
        s = gram_set(text, width)
        k = place.get(s) if i is not None else None
        out.append((i, len(s), i) if k is None else (i, len(s), low[find(k)]))
    return sorted(out, key=repr)
