"""I-Match fingerprints: hashes of randomised subsets of the terms in a band of frequencies."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeep.llm.common import ODD, Hasher, mix, signed

SUBSETS = 64  # lexicon subsets hashed at each rate
LEAST_COMMON = 20  # a term of fewer contexts is not common, however small the table
FEW = 16  # a text with fewer terms in the band gets its rarest common ones as well
LEAST_LEVEL = 6  # at the densest, every term is in one of the 64 subsets


class TermReader:
    """Sorted hashes of the distinct terms of a whole text (A-Z lower-cased)."""

    def __init__(self):
        self.hash = Hasher()

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        return np.unique(self.hash(list(set(words)))) if words else np.empty(0, np.uint64)


def _count_terms(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read, term, n = TermReader(), np.empty(0, np.uint64), np.empty(0, np.int64)
    for batch in rows:
        found = [read(text) for text in batch.column(0).to_pylist()]
        new, many = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
        every, at = np.unique(np.concatenate([term, new]), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, at, np.concatenate([n, many]))
        term, n = every, total
        if len(term) > 4_000_000:  # counts are summed anyway, so a task may send parts
            yield pa.RecordBatch.from_arrays([pa.array(signed(term)), pa.array(n)], ["term", "n"])
            term, n = term[:0], n[:0]
    yield pa.RecordBatch.from_arrays([pa.array(signed(term)), pa.array(n)], ["term", "n"])


def common_terms(texts: DataFrame, min_idf: float) -> np.ndarray:
    """Sorted hashes of the terms below the band: idf = ln(documents / document frequency).

    Frequencies are counted over all texts. A term outside is in more than exp(-min_idf) of
    them, so there are at most exp(min_idf) times as many as a text has terms on average:
    some ten thousand, however many texts there are. These go to the executors.
    """
    return _often(texts, math.exp(-min_idf) * texts.count())


def _often(texts: DataFrame, most: float) -> np.ndarray:
    """Sorted hashes of the terms of more than ``most`` texts."""
    counted = texts.select("text").mapInArrow(_count_terms, "term long, n long")
    often = counted.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    return np.sort(often.select("term").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))


def _contexts(terms: np.ndarray):
    """Of every text, the first use of each of ``terms`` with the words before and after it."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Hasher()
        for batch in rows:
            out = [np.empty((2, 0), np.uint64)]
            for text in batch.column(0).to_pylist():
                words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
                if not words:
                    continue
                line = np.concatenate([[ODD], code(words), [ODD]])
                found, first = np.unique(line[1:-1], return_index=True)
                first = first[terms[np.minimum(np.searchsorted(terms, found), len(terms) - 1)] == found]
                out.append(np.stack([line[first + 1], mix(line[first] * ODD + mix(line[first + 2]))]))
            pairs = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(signed(pairs[0].copy())), pa.array(signed(pairs[1].copy()))], ["term", "context"])

    return read


def widespread_terms(texts: DataFrame, min_idf: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the terms below the band, and in how many contexts each stands.

    As :func:`common_terms`, but over distinct texts, and a term counts once for texts that
    first use it between the same two words. Copies and near copies share nearly all of their
    contexts, so a family makes its own terms common only if others use them too. Contexts are
    counted by sketches, to about 3 %, and only of the terms that many rows have.
    """
    most = max(LEAST_COMMON, math.exp(-min_idf) * texts.select(F.xxhash64("text")).distinct().count())
    terms = _often(texts, most)
    if not len(terms):
        return terms, np.empty(0, np.int64)
    pairs = texts.select("text").mapInArrow(_contexts(terms), "term long, context long")
    counted = pairs.groupBy("term").agg(F.approx_count_distinct("context", 0.03).alias("n")).where(F.col("n") > most).toArrow()
    found = counted.column("term").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], counted.column("n").to_numpy().astype(np.int64)[order]


class Fingerprinter:
    """Fingerprints of texts under one lexicon band."""

    def __init__(self, common: np.ndarray, counts: np.ndarray | None = None):
        self.common, self.read = common, TermReader()
        self.counts = np.zeros(len(common), np.int64) if counts is None else counts

    def __call__(self, text: str | None) -> str:
        """``level:hashes:hashes``, 64 hashes of 16 bits at the text's rate and at half of it.

        At level l, 64 of 2^l random, disjoint parts of the lexicon are the subsets, where
        2^l is about the number of terms: a subset then holds a term or so, and survives
        edits elsewhere. A subset without terms hashes to 0000. Texts with less than
        :data:`FEW` terms in the band take their rarest others too; those without terms have ``0``.
        """
        terms = self.read(text)
        if len(self.common) and len(terms):
            at = np.minimum(np.searchsorted(self.common, terms), len(self.common) - 1)
            below = self.common[at] == terms
            lacking = FEW - int((~below).sum())
            if lacking > 0:
                others = np.flatnonzero(below)
                below[others[np.argsort(self.counts[at[others]], kind="stable")[:lacking]]] = False
            terms = terms[~below]
        if not len(terms):
            return "0"
        level = max(LEAST_LEVEL, (len(terms) - 1).bit_length())
        spread = mix(terms + ODD)
        parts = []
        for bits in (level, level + 1):
            part = spread & np.uint64((1 << bits) - 1)
            inside = part < SUBSETS
            total = np.zeros(SUBSETS, np.uint64)
            np.add.at(total, part[inside], mix(terms[inside]))
            digest = (mix(total) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
            digest[total == 0] = 0
            parts.append(digest.astype(">u2").tobytes().hex())
        return f"{level}:{parts[0]}:{parts[1]}"


def likeness(a: str, b: str) -> float:
    """Share of the subsets filled in either text whose hashes agree; 1 for equal fingerprints.

    Compared at the sparser text's rate; texts whose numbers of terms are further apart
    than that (about 2 to 4 times) have likeness 0.
    """
    if a == b:
        return 1.0
    if a == "0" or b == "0":
        return 0.0
    (la, *ha), (lb, *hb) = a.split(":"), b.split(":")
    level = max(int(la), int(lb))
    if level - min(int(la), int(lb)) > 1:
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(h[level - int(l)]), ">u2") for l, h in ((la, ha), (lb, hb)))
    either = (x > 0) | (y > 0)
    return float((x == y)[either].mean()) if either.any() else 0.0


def fingerprint(docs: DataFrame, min_idf: float = 3.0, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text; see :class:`Fingerprinter`.

    Terms are in the band if their inverse document frequency over all of ``docs``, copies
    and near copies damped (see :func:`widespread_terms`), is at least ``min_idf``; its upper
    end is the idf of a term of a single text. Null and empty texts have ``0``. Equal texts have equal fingerprints; repeated rows are all returned;
    a column named like ``out`` is replaced; an empty table gives none.
    """
    common, counts = widespread_terms(docs.select(F.col(text).cast("string").alias("text")), min_idf)

    @F.arrow_udf(T.StringType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        make = Fingerprinter(common, counts)
        for texts in batches:
            yield pa.array([make(t) for t in texts.to_pylist()], pa.string())

    return docs.withColumn(out, of(F.col(text).cast("string")))


# -- the edited neighbours of the query ------------------------------------------------------


def _bucket(bounds: list[int]) -> Column:
    """Number of (falling) bounds that a doc_id is below: 0 for the highest ids; NULL ids come last.

    Looked up in two steps, among every so many bounds and then among those between.
    """

    def below(edges: Column) -> Column:
        return F.size(F.filter(edges, lambda b: F.col("doc_id") < b))

    def listed(values: list[int]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<long>")

    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    coarse = below(listed([group[-1] for group in groups if len(group) == step]))
    fine = F.get(F.array(*map(listed, groups)), coarse) if groups else listed([])
    found = coarse * step + below(F.coalesce(fine, listed([])))
    return F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(found)


def fingerprint_edits(
    docs: DataFrame, min_idf: float = 3.0, per_bucket: int = 2000, most_buckets: int = 4096
) -> DataFrame:
    """Fingerprints of every text, of its edited form, and how like they are to each other.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as
    many of the next document in descending doc_id; the first follows the last. Ids are cut
    at quantiles into buckets of about ``per_bucket`` rows, and a bucket also gets the head
    of the one that follows, so texts are shuffled once and stream through tasks in order.
    There are at most ``most_buckets``, which then hold more rows; a task holds two texts.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. NULL doc_ids come last; rows with equal doc_id follow each other by text;
    null texts count as empty; a single row is followed by itself.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    common, counts = widespread_terms(texts, min_idf)
    rows = texts.count()
    shares = max(1, min(most_buckets, -(-rows // per_bucket)))
    cuts = texts.agg(F.percentile_approx("doc_id", [i / shares for i in range(1, shares)], 100 * shares)).first()[0] if shares > 1 else []
    dealt = texts.withColumn("bucket", _bucket(sorted(set(cuts or []), reverse=True)))
    heads = dealt.groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect()
    order = [h["bucket"] for h in heads]
    receiver = {h["bucket"]: order[i - 1] for i, h in enumerate(heads)}  # the bucket before; the last one's is the first
    known = [h for h in heads if h["head"] is not None]
    head_rows = dealt.where(F.col("doc_id").isin([h["head"] for h in known]) if known else F.lit(False))
    if any(h["head"] is None for h in heads):
        head_rows = head_rows.unionByName(dealt.where("doc_id IS NULL"))
    head_rows = head_rows.groupBy("bucket").agg(F.min("text").alias("text"))
    to = F.create_map(*[F.lit(x) for pair in receiver.items() for x in pair]) if receiver else F.create_map(F.lit(0), F.lit(0))
    extra = head_rows.select(F.lit(None).cast("long").alias("doc_id"), "text", to[F.col("bucket")].alias("bucket"), F.lit(1).alias("extra"))
    every = dealt.withColumn("extra", F.lit(0)).unionByName(extra)
    ordered = every.repartition("bucket").sortWithinPartitions("bucket", "extra", F.col("doc_id").desc_nulls_last(), "text")

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        make, held = Fingerprinter(common, counts), None
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in rows:
            out = []
            for doc_id, text, extra in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                mark = make(text)
                if held is not None:
                    before, its_text, its_mark = held
                    n = len(its_text)
                    edited = its_text[: n - n // 3] + text[: n // 3]
                    edited_mark = make(edited)
                    out.append((
                        before, n, sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), its_mark, edited_mark,
                        likeness(its_mark, edited_mark), likeness(its_mark, mark),
                    ))
                held = None if extra else (doc_id, text, mark)
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return ordered.mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
