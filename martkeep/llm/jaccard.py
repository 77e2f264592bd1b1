"""Exact n-gram Jaccard join: blocked sparse products over candidates that cannot miss."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkeep.llm.common import MASK, ODD, Hasher, hold, mix, release, shingles, signed, staged
from martkeep.llm.components import connected_components, local_roots

BLOCK_DOCS = 256
BLOCK_GRAMS = 500_000
BLOCK_SKETCHED = 12_000_000  # n-grams whose sketches, a byte for 4 to 8 of them, a block holds
CHUNK = 4096  # columns of a dense piece of the incidence matrix
HEAVY_LEAST = 64  # documents that make an n-gram common
HEAVY_MOST = 1 << 20  # common n-grams kept: 8 MB, whatever the corpus
FILTER_BITS = 1 << 24
BROADCAST_SETS = 500_000  # sets of clusters, some 60 bytes each, that all executors get
PIVOTS = 2  # sets that each set is compared with first; only spares work, any number gives the same components
RUN = 4096  # sets of a signature whose membership is compared with that of other signatures


class GramReader:
    """Distinct n-gram hashes of whole texts, sorted."""

    def __init__(self, width: int):
        self.width, self.hash = width, Hasher()

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        return np.unique(shingles(self.hash(words), self.width)) if words else np.empty(0, np.uint64)


def set_id(grams: np.ndarray) -> int:
    """A hash of a set of n-grams; 0 is kept for none."""
    with np.errstate(over="ignore"):
        return int(signed(mix(np.sum(mix(grams + ODD), keepdims=True) + np.uint64(len(grams))))[0]) or 1


# -- common n-grams -----------------------------------------------------------------------


def _count_grams(width: int):
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        read, texts, gram, n = GramReader(width), set(), np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting: list[np.ndarray] = []
        held = 0

        def merge() -> None:
            nonlocal gram, n, waiting, held
            new, many = np.unique(np.concatenate([np.empty(0, np.uint64), *waiting]), return_counts=True)
            every, at = np.unique(np.concatenate([gram, new]), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, at, np.concatenate([n, many]))
            few = 2 if len(every) > 1_500_000 else 1  # too many to hold: forget the rare
            gram, n = every[total >= few], total[total >= few]
            waiting, held = [], 0

        for batch in rows:
            for text in batch.column(0).to_pylist():
                key = hash(text)
                if text and key not in texts:  # a copy adds nothing to what is common
                    texts.add(key)
                    waiting.append(read(text))
                    held += len(waiting[-1])
                    if held > 1_000_000:
                        merge()
            if len(texts) > 200_000:
                texts.clear()
        merge()
        keep = n >= 3
        yield pa.RecordBatch.from_arrays([pa.array(signed(gram[keep])), pa.array(n[keep])], ["gram", "n"])
        del gram, n, texts
        release()

    return count


def heavy_grams(docs: DataFrame, width: int) -> np.ndarray:
    """N-grams that many texts share, at most :data:`HEAVY_MOST`, sorted.

    Only a help to keep candidates few: any set gives the same links.
    """
    counted = docs.select("text").mapInArrow(_count_grams(width), "gram long, n long")
    common = counted.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= HEAVY_LEAST)
    rows = common.orderBy(F.desc("n"), "gram").limit(HEAVY_MOST).select("gram").toArrow()
    return np.sort(rows.column(0).to_numpy().astype(np.int64).view(np.uint64))


# -- candidates ---------------------------------------------------------------------------


KINDS = 1 << 7  # schemes and kinds of signatures, told by their lowest bits


def schemes(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(scheme, largest symmetric difference of a linked pair in it, that of one with a set of n) for n n-grams.

    Sets of 2^c to 2^(c+1)-1 n-grams meet in scheme 2c; sets near a power of two also meet
    those beyond it, in the scheme 2c+1 of that power. Two sets a and b link if
    100 |a & b| >= percent |a | b|, so they differ in at most
    (100 - percent) (|a| + |b|) / (100 + percent) n-grams, and their sizes differ by percent.
    """

    def most(total: int) -> int:
        return (100 - percent) * total // (100 + percent)

    c, longest = n.bit_length() - 1, 100 * n // percent
    out = [(2 * c, most(2 * ((2 << c) - 1)), most(n + min(longest, (2 << c) - 1)))]
    for low, edge in ((c, 2 << c), (c - 1, 1 << c)):
        beyond = 100 * (edge - 1) // percent
        if low >= 0 and 100 * n >= percent * edge and n <= beyond:
            out.append((2 * low + 1, most(edge - 1 + beyond), most(n + (longest if n < edge else edge - 1))))
    return out


def kinds(grams: np.ndarray, heavy: np.ndarray, percent: int) -> list[tuple[int, int, np.ndarray]]:
    """(kind, how many of its signatures a linked set has at least, the signatures) of a set.

    A set is dealt into more parts than a linked pair has differing n-grams, so some part
    holds no difference and hashes alike. Common n-grams are dealt out only where a set
    has little else; then its parts of all n-grams are added. ``slack`` spare parts make
    up for empty ones; sets that still have more empty parts add those by number. Of a
    linked pair, either one set stays within the slack, and a part that is not empty
    agrees, or both add the next kind.

    Parts without a difference agree: all but as many as the set differs from a linked one.
    Of these the empty ones are no signatures. They are empty in both sets, so no more than
    the set's own empty parts, nor, as one of both stays within it, than the slack. So the
    linked sets of a set, each by one kind at least, have as many of its signatures as said.
    """
    out = []
    light = grams
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)
        light = grams[heavy[at] != grams]
    for scheme, differ, own in schemes(len(grams), percent):
        slack = 2 + differ // 8
        parts = differ + 1 + slack
        for kind, of in enumerate((light, grams)):
            seed = np.uint64((1 + 4 * scheme + 2 * kind) * int(ODD) & int(MASK))
            h = mix(of + seed)
            part = (h >> np.uint64(33)) % np.uint64(parts)
            total = np.zeros(parts, np.uint64)
            np.add.at(total, part, h)
            filled = np.bincount(part.astype(np.int64), minlength=parts) > 0
            number = np.arange(parts, dtype=np.uint64) * ODD + seed
            found, empty = mix(total + mix(number))[filled], parts - int(filled.sum())
            if kind and empty > slack:
                found = np.concatenate([found, mix(mix(number + ODD) ^ seed)[~filled]])
            name = 2 * scheme + kind
            out.append((name, parts - own - min(empty, slack), np.unique(found) & ~np.uint64(KINDS - 1) | np.uint64(name)))
            if empty <= slack:
                break
    return out


def signatures(grams: np.ndarray, heavy: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of which any two linked sets that differ share at least one (see :func:`kinds`)."""
    return np.unique(np.concatenate([found for _, _, found in kinds(grams, heavy, percent)]))


def _describe(width: int, percent: int, heavy: np.ndarray):
    def describe(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        read, seen = GramReader(width), set()
        for batch in rows:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            sizes, sets, sigs, sketches, spares = [], [], [], [], []
            for doc_id, text in zip(ids.to_pylist(), texts):
                grams = read(text)
                sizes.append(len(grams))
                sketches.append(sketch(grams))
                sets.append(set_id(grams) if len(grams) else None)
                if doc_id is None or not len(grams) or sets[-1] in seen:
                    sigs.append(None)  # a copy in this task has said it
                    spares.append(None)
                else:
                    seen.add(sets[-1])
                    of = kinds(grams, heavy, percent)
                    sigs.append(signed(np.concatenate([found for _, _, found in of])))
                    spares.append([(least - 1) * KINDS + kind for kind, least, _ in of])
            if len(seen) > 200_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(sizes, pa.int64()), pa.array(sets, pa.int64()),
                    pa.array(sigs, pa.list_(pa.int64())), pa.array(spares, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), batch.column(2),
                ],
                ["doc_id", "n", "sid", "sigs", "spares", "sketch", "row"],
            )
        release()

    return describe


def _by_signature(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(signatures, how many sets each has, whether those are more than :data:`RUN`, the sets) of rows sorted by (sig, sid).

    Runs of up to :data:`RUN` sets are whole and have each set once; longer ones come in pieces.
    """
    sig = sid = np.empty(0, np.int64)
    long = None  # a signature whose first sets went out before
    for batch in chain(rows, [None]):
        if batch is not None:
            sig = np.concatenate([sig, batch.column(0).to_numpy(zero_copy_only=False)])
            sid = np.concatenate([sid, batch.column(1).to_numpy(zero_copy_only=False)])
        if not len(sig):
            continue
        fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])])
        sig, sid = sig[fresh], sid[fresh]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        if batch is not None and len(sig) - starts[-1] <= RUN:  # the last run may go on
            done, starts = starts[-1], starts[:-1]
        else:
            done = len(sig)
        if done:
            sizes = np.diff(np.append(starts, done))
            open_run = (sizes > RUN) | (sig[starts] == long)
            yield sig[starts], sizes, open_run, sid[:done]
            long = int(sig[done - 1]) if done == len(sig) and open_run[-1] else long
        sig, sid = sig[done:], sid[done:]


def _often(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, sid, many) of signatures that several sets share, and how many: up to :data:`RUN`, or more."""
    for sig, sizes, open_run, sid in _by_signature(rows):
        out, many = np.repeat((sizes > 1) | open_run, sizes), np.where(open_run, RUN + 1, sizes)
        columns = [np.repeat(sig, sizes)[out], sid[out], np.repeat(many, sizes)[out].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "sid", "many"])


def _runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, sid) of signatures that several sets share, from rows sorted by (sig, sid).

    Near copies share many signatures. Of those that up to :data:`RUN` sets share, the name is
    replaced by a hash of the sets, so that signatures of the same sets become one group.
    Longer runs keep the signature's own name, as they come.
    """
    for sig, sizes, open_run, sid in _by_signature(rows):
        starts = np.cumsum(sizes) - sizes
        hashes = mix(np.add.reduceat(mix(sid.view(np.uint64) + ODD), starts) + sizes.astype(np.uint64))
        names, out = np.where(open_run, sig, signed(hashes)), np.repeat((sizes > 1) | open_run, sizes)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, sizes)[out]), pa.array(sid[out])], ["sig", "sid"])


def _telling(described: DataFrame) -> DataFrame:
    """(sig, sid) of the signatures by which sets are to meet: of every two linked sets that differ, one that both have.

    What says that two sets link is that they share many signatures, not one: a set and a linked
    one share ``least`` of a kind, :func:`kinds` says. In one order of all signatures, the
    commonest first, the last of these is behind ``least - 1`` others in either set. So the first
    ``least - 1`` of a set, among those that other sets have, are left out. A passage that many
    texts hold no longer brings them together.
    """
    postings = described.where("doc_id IS NOT NULL").select(F.explode("sigs").alias("sig"), "sid")
    often = postings.repartition("sig").sortWithinPartitions("sig", "sid").mapInArrow(_often, "sig long, sid long, many long")
    often = often.withColumn("kind", F.col("sig").bitwiseAND(KINDS - 1))
    spares = described.where("doc_id IS NOT NULL").select("sid", F.explode("spares").alias("spare"))
    spares = spares.select("sid", F.col("spare").bitwiseAND(KINDS - 1).alias("kind"), F.shiftright("spare", 7).alias("spare"))
    spares = spares.groupBy("sid", "kind").agg(F.max("spare").alias("spare"))  # alike for all copies; dealt as the join and the window are
    order = Window.partitionBy("sid", "kind").orderBy(F.desc("many"), "sig")
    placed = often.join(spares, ["sid", "kind"]).withColumn("place", F.row_number().over(order))
    return placed.where("place > spare").select("sig", "sid")


# -- sketches -----------------------------------------------------------------------------


def sketch(grams: np.ndarray) -> bytes:
    """How many n-grams of a set fall into each of 2^k bins, up to 255; about 4 to 8 per bin, 64 bins at least.

    Bins are ranges of hashes, so neighbours can be added up to compare with fewer bins.
    """
    k = min(max(len(grams).bit_length() - 3, 6), 16)
    return np.minimum(np.bincount((grams >> np.uint64(64 - k)).astype(np.int64), minlength=1 << k), 255).astype(np.uint8).tobytes()


def _bins(sketches: list[bytes], k: int) -> np.ndarray:
    """Sketches of one length as counts of 2^k bins."""
    counts = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), 1 << k, -1)
    return counts.sum(axis=2, dtype=np.int16)


def _possible(percent: int):
    """Spanning edges of the pairs that sizes and sketches leave possible.

    Bins that differ by d make the sets differ in d n-grams at least, so the sum over all
    bins is below the symmetric difference; the difference of the sizes is, too. Sizes of
    linked sets differ by less than half, hence the numbers of their bins by a factor of 2.
    """

    def product(sids: list[int], sides: list[int], payload: list[tuple[int, bytes]]) -> Iterator[tuple]:
        side, sid = np.array(sides), np.array(sids, np.int64)
        size = np.array([n for n, _ in payload], np.int64)
        level = np.array([len(raw).bit_length() - 1 for _, raw in payload])
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        two = two if len(two) else one
        for k, other in ((k, k + d) for k in np.unique(level[one]).tolist() for d in (-1, 0, 1)):
            a, b = one[level[one] == k], two[level[two] == other]
            if not len(b):
                continue
            least = min(k, other)
            left, right = (_bins([payload[i][1] for i in some.tolist()], least) for some in (a, b))
            step = max(1, (4 << 20) // (len(b) << least))
            for start in range(0, len(a), step):
                at = a[start : start + step]
                apart = np.abs(left[start : start + step, None] - right[None]).sum(axis=2, dtype=np.int32)
                apart = np.maximum(apart, np.abs(size[at][:, None] - size[b][None]))
                i, j = np.nonzero(apart <= (100 - percent) * (size[at][:, None] + size[b][None]) // (100 + percent))
                new = sid[at[i]] != sid[b[j]]
                node, root = local_roots(sid[at[i[new]]], sid[b[j[new]]])
                yield from ((int(x), int(y)) for x, y in zip(node, root) if x != y)

    def possible(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for group in _groups(rows, lambda n, raw: (n, raw)):
            found += product(*group)
            if len(found) > 50_000:
                yield _long_rows(found, ("a", "b"))
                found = []
        yield _long_rows(found, ("a", "b"))
        release()

    return possible


# -- products -----------------------------------------------------------------------------


def overlaps(left: list[np.ndarray], right: list[np.ndarray], need: np.ndarray) -> np.ndarray:
    """Overlap counts of two blocks of sets where they reach ``need``, else 0.

    The product of the two sparse document-by-n-gram matrices, accumulated over pieces of
    columns. A pair is given up when what its sets have left cannot reach its bound.
    """
    sizes = [len(g) for g in (*left, *right)]
    every = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, column, many = np.unique(every, return_inverse=True, return_counts=True)
    shared = many > 1  # an n-gram of one set alone adds to no product
    row, column = row[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    row, column, n = row[order], column[order], len(left)
    counts = np.zeros((n, len(right)), np.float32)
    rest = np.bincount(row, minlength=len(sizes)).astype(np.float32)
    for start in range(0, int(shared.sum()), CHUNK):
        lo, hi = np.searchsorted(column, [start, start + CHUNK])
        piece = np.zeros((len(sizes), CHUNK), np.float32)
        piece[row[lo:hi], column[lo:hi] - start] = 1
        counts += piece[:n] @ piece[n:].T
        rest -= piece.sum(axis=1)
        if not (counts + np.minimum(rest[:n, None], rest[None, n:]) >= need).any():
            break
    return np.where(counts >= need, counts, 0)


def _links(percent: int):
    """A spanning forest of the links between two blocks of sets, or within one."""

    def product(sids: list[int], sides: list[int], grams: list[np.ndarray]) -> Iterator[tuple]:
        side, sid = np.array(sides), np.array(sids, np.int64)
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        two = two if len(two) else one
        size = np.array([len(g) for g in grams])
        need = -(-percent * (size[one][:, None] + size[two][None, :]) // (100 + percent))
        i, j = np.nonzero(overlaps([grams[k] for k in one], [grams[k] for k in two], need))
        if len(i):
            node, root = local_roots(sid[one[i]], sid[two[j]])
            yield from ((int(a), int(b)) for a, b in zip(node, root) if a != b)

    def links(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for group in _groups(rows, lambda _, raw: np.frombuffer(raw, np.uint64)):
            found += product(*group)
            if len(found) > 50_000:
                yield _long_rows(found, ("a", "b"))
                found = []
        yield _long_rows(found, ("a", "b"))
        release()

    return links


# -- blocks -------------------------------------------------------------------------------

PAIR = ("cluster", "i", "j")


def _groups(rows: Iterator[pa.RecordBatch], read) -> Iterator[tuple[list, list, list]]:
    """(sids, sides, payloads) of each pair of blocks, of rows sorted by it; equal sets once."""
    key, sids, sides, payloads = None, [], [], []
    for batch in rows:
        for *pair, side, sid, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
            if pair != key:
                if key is not None:
                    yield sids, sides, payloads
                key, sids, sides, payloads = pair, [], [], []
            if not (sids and sids[-1] == sid and sides[-1] == side):
                sids.append(sid)
                sides.append(side)
                payloads.append(read(n, raw))
    if key is not None:
        yield sids, sides, payloads


def _long_rows(found: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*found) if found else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in columns], list(names))


def _placed(clusters: DataFrame, classes: DataFrame, block_grams: int, purpose: str) -> DataFrame:
    """Sets (sid, doc_id, n, cluster) with their ``block`` and the blocks to compare it with, ``others``.

    ``clusters`` has sid, cluster and component: sets of one component are tied already and
    need not be compared. So components that fill a block have blocks of their own, which
    are compared with all but each other; the rest shares blocks.
    """
    members = staged(clusters.join(classes, "sid"), f"{purpose}-members")
    size = F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / block_grams)).cast("int")
    own = members.groupBy("cluster", "component").agg(F.count("*").alias("sets"), F.sum("n").alias("grams"))
    own = own.where((F.col("sets") >= BLOCK_DOCS) | (F.col("grams") >= block_grams)).select("cluster", "component", F.col("component").alias("label"))
    labelled = staged(members.join(own, ["cluster", "component"], "left"), f"{purpose}-labelled")
    blocks = labelled.groupBy("cluster", "label").agg(size.alias("blocks"))
    before = Window.partitionBy("cluster").orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0)).cast("int"))
    blocks = blocks.withColumn("total", F.sum("blocks").over(Window.partitionBy("cluster")).cast("int"))
    blocks = blocks.select(F.col("cluster").alias("of"), F.col("label").alias("by"), "blocks", "first", "total")
    placed = labelled.join(blocks, (F.col("cluster") == F.col("of")) & F.col("label").eqNullSafe(F.col("by")))
    placed = placed.withColumn("block", F.col("first") + F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    apart = F.filter(
        F.sequence(F.lit(0), F.col("total") - 1),
        lambda b: F.col("label").isNull() | (b < F.col("first")) | (b >= F.col("first") + F.col("blocks")),
    )
    placed = placed.withColumn("others", apart).where(F.size("others") > 0)
    return staged(placed.select("sid", "doc_id", "n", "cluster", "block", "others"), f"{purpose}-placed")


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition(*PAIR).sortWithinPartitions(*PAIR, "side", "sid")


def _block_pairs(placed: DataFrame, payload: DataFrame) -> DataFrame:
    """Rows (cluster, i, j, side, sid, n, payload), those of a pair of blocks together.

    ``payload`` has sid and one more column, each set once.
    """
    (name,) = (c for c in payload.columns if c != "sid")
    if placed.count() <= BROADCAST_SETS:  # else the payload is shuffled once more for the join
        placed = F.broadcast(placed)
    pairs = placed.join(payload, "sid").withColumn("other", F.explode("others"))
    return _together(
        pairs.select(
            "cluster",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            "sid",
            "n",
            name,
        )
    )


def _pivot_pairs(pairs: DataFrame, classes: DataFrame, grams: DataFrame) -> DataFrame:
    """Rows like those of :func:`_block_pairs` that compare each set with its pivot.

    ``pairs`` has each sid and pivot once. The sets of a pivot are dealt into blocks,
    and the pivot's own n-grams go to each of them.
    """
    size = F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int")
    sized = pairs.join(classes.select("sid", "n"), "sid")
    blocks = staged(sized.groupBy("pivot").agg(size.alias("blocks")), "jaccard-pivots")
    members = pairs.join(blocks, "pivot").select(
        F.col("pivot").alias("cluster"), F.lit(0).alias("i"),
        (1 + F.pmod(F.xxhash64("sid"), F.col("blocks"))).cast("int").alias("j"), F.lit(1).alias("side"), "sid",
    )
    pivots = blocks.select(
        F.col("pivot").alias("cluster"), F.lit(0).alias("i"), F.explode(F.sequence(F.lit(1), F.col("blocks"))).alias("j"),
        F.lit(0).alias("side"), F.col("pivot").alias("sid"),
    )
    rows = members.unionByName(pivots).join(grams, "sid")
    return _together(rows.select(*PAIR, "side", "sid", F.octet_length("grams").alias("n"), "grams"))


# -- signatures that sets of several components share ---------------------------------------


def _mixed(shared: DataFrame, components: DataFrame | None, purpose: str) -> tuple[DataFrame, DataFrame]:
    """(``shared`` with components, the signatures whose sets are not of one component).

    The latter come with a pivot, their lowest set.
    """
    if components is None:
        labelled = shared.withColumn("component", F.col("sid"))
    else:
        known = components.select(F.col("node").alias("sid"), F.col("component").alias("of"))
        labelled = shared.join(known, "sid", "left").select("sig", "sid", F.coalesce("of", "sid").alias("component"))
        labelled = staged(labelled, f"{purpose}-labelled")
    groups = labelled.groupBy("sig").agg(
        F.min("sid").alias("pivot"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    return labelled, staged(groups.where("low <> high").select("sig", "pivot"), f"{purpose}-mixed")


def _meeting(left: DataFrame) -> DataFrame:
    """Rows (sid, component, cluster) of which those of a cluster are to be compared, from signatures with sets, components and pivots.

    What signatures tie together is a cluster, each set in it once, or each signature is one,
    whichever takes fewer rows for its pairs of blocks: signatures that tie set to set to set,
    each to few others, must not make all of these one cluster.
    """

    def rows(sets: Column) -> Column:
        return sets * F.ceil(sets / BLOCK_DOCS)

    tied = connected_components(left.select("sid", "pivot"), "jaccard-clusters").select(F.col("node").alias("sid"), F.col("component").alias("cluster"))
    tied = staged(left.select("sid", "component").distinct().join(tied, "sid"), "jaccard-clusters")
    whole = tied.groupBy("cluster").agg(rows(F.count("*")).alias("whole"), F.count("*").alias("sets"))
    whole = staged(whole.where(F.col("sets") > BLOCK_DOCS).select("cluster", "whole"), "jaccard-whole")
    if whole.isEmpty():  # in one block each set is one row
        return tied
    by_signature = left.groupBy("sig").agg(F.min("pivot").alias("sid"), rows(F.count("*")).alias("rows"))
    by_signature = by_signature.join(tied, "sid").groupBy("cluster").agg(F.sum("rows").alias("by_signature"))
    loose = staged(whole.join(by_signature, "cluster").where("by_signature < whole").select("cluster"), "jaccard-loose")
    if not (many := loose.count()):
        return tied
    if many <= BROADCAST_SETS:  # each has more sets than a block
        loose = F.broadcast(loose)
    apart = left.join(tied.join(loose, "cluster", "left_semi").select("sid"), "sid").select("sid", "component", F.col("sig").alias("cluster"))
    return tied.join(loose, "cluster", "left_anti").select("sid", "component", "cluster").unionByName(apart)


def _bits(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _bitmap(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros(FILTER_BITS, bool)
    for batch in rows:
        found[_bits(batch.column(0).to_numpy(zero_copy_only=False))] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(found).tobytes()], pa.binary())], ["bits"])


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size (2 MB) that has the bits of all ids; others may share them.

    It spares the texts of documents without candidates the shuffle. When there are so many
    ids that it fills up, more texts are shuffled and the join after it drops them.
    """
    parts = ids.coalesce(4).mapInArrow(_bitmap, "bits binary").collect()
    every = np.zeros(FILTER_BITS // 8, np.uint8)
    for part in parts:
        every |= np.frombuffer(part["bits"], np.uint8)
    return every


def _read_grams(width: int, wanted: np.ndarray):
    def read_grams(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        read = GramReader(width)
        for batch in rows:
            batch = batch.filter(batch.column(0).is_valid())
            bits = _bits(batch.column(0).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(wanted[bits >> 3] >> (7 - (bits & 7)) & 1 == 1))
            sets = [read(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([set_id(g) if len(g) else None for g in sets], pa.int64()),
                    pa.array([g.tobytes() for g in sets], pa.binary()),
                ],
                ["doc_id", "sid", "grams"],
            )
        release()

    return read_grams


def jaccard_groups(docs: DataFrame, width: int = 5, percent: int = 80, row: Column | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, node, row.

    Two documents link when 100 * |a & b| >= percent * |a | b| for their sets of distinct
    runs of ``width`` words (white space is \\x20 and \\x09-\\x0D, A-Z are lower-cased). A
    text of fewer words has its whole sequence as one run. component_id is the smallest
    doc_id that links reach, its own included; node is a hash that the rows of a component,
    and no others, have in common. The components are those of all links (n-grams and sets
    are told apart by 64-bit hashes).

    1. Equal sets become one. Each set is written as signatures of which linked sets share
       many (see :func:`kinds`). The commonest are left out, but so few that linked sets still
       share one (see :func:`_telling`); sets that share too few link with none.
    2. Pivots: every set is compared with those :data:`PIVOTS` sets that are the lowest of most of
       its signatures. That ties most of a family of near copies at a cost that grows with
       its sets, not with its pairs.
    3. Signatures that sets of several components still share form clusters, or are compared
       one by one where that is less (see :func:`_meeting`). Clusters are cut into
       blocks of some :data:`BLOCK_DOCS` sets. Pairs of blocks, other than those of one
       component, are ruled out by sketches, a fiftieth of the sets (see :func:`_possible`) or become
       families, whose pairs of blocks are multiplied as sparse matrices. So no pair that
       could link two components goes uncompared.
    4. Components of the links found, by joins. Only spanning forests leave a task.

    Null and empty texts have n_shingles 0, link with nothing and are their own component.
    Rows without doc_id are compared with nothing and have component_id NULL. Both have a
    NULL node. Repeated rows, also a doc_id with several texts, are all returned; the
    component of each is that of its text. An empty table gives none. Other columns are not
    looked at; ``row``, a long computed from them, is returned as it is (else 0).
    """
    mark = (F.lit(0) if row is None else row).cast("long").alias("row")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), mark)
    heavy = heavy_grams(texts, width)
    described = staged(
        texts.mapInArrow(_describe(width, percent, heavy), "doc_id long, n long, sid long, sigs array<long>, spares array<long>, sketch binary, row long"),
        "jaccard-sets",
    )
    known = described.where("doc_id IS NOT NULL AND sid IS NOT NULL")
    classes = staged(known.groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "jaccard-classes")
    runs = _telling(described).repartition("sig").sortWithinPartitions("sig", "sid").mapInArrow(_runs, "sig long, sid long")
    shared = staged(runs.dropDuplicates(["sig", "sid"]), "jaccard-shared")
    candidates = staged(shared.select("sid").distinct().join(classes, "sid").select("sid", "doc_id"), "jaccard-candidates")
    read = texts.mapInArrow(_read_grams(width, id_filter(candidates.select("doc_id"))), "doc_id long, sid long, grams binary")
    if candidates.count() <= BROADCAST_SETS:
        candidates = F.broadcast(candidates)
    grams = staged(read.join(candidates, ["doc_id", "sid"]).select("sid", "grams").dropDuplicates(["sid"]), "jaccard-grams")
    edges, components = [], None
    _, groups = _mixed(shared, None, "jaccard-first")
    if PIVOTS and not groups.isEmpty():
        often = shared.join(groups, "sig").where("sid <> pivot").groupBy("sid", "pivot").count()
        most = F.slice(F.sort_array(F.collect_list(F.struct("count", "pivot")), asc=False), 1, PIVOTS)
        pairs = staged(often.groupBy("sid").agg(most.alias("most")).select("sid", F.explode("most.pivot").alias("pivot")), "jaccard-pairs")
        edges.append(staged(_pivot_pairs(pairs, classes, grams).mapInArrow(_links(percent), "a long, b long"), "jaccard-links"))
        components = staged(connected_components(edges[0], "jaccard-tied"), "jaccard-tied")
    labelled, mixed = _mixed(shared, components, "jaccard-left")
    if not mixed.isEmpty():
        left = staged(labelled.join(mixed, "sig").select("sig", "sid", "component", "pivot"), "jaccard-left")
        clusters, apart = _meeting(left), [F.col("node").alias("sid"), F.col("component").alias("cluster")]
        sketches = known.join(classes.select("sid", "doc_id"), ["sid", "doc_id"], "left_semi").select("sid", "sketch").dropDuplicates(["sid"])
        possible = _block_pairs(_placed(clusters, classes, BLOCK_SKETCHED, "jaccard-clusters"), sketches).mapInArrow(_possible(percent), "a long, b long")
        possible = staged(possible, "jaccard-possible")  # else the next step adds a second Python worker to each task
        families = connected_components(possible, "jaccard-families").select(*apart).join(left.select("sid", "component").distinct(), "sid")
        placed = _placed(families, classes, BLOCK_GRAMS, "jaccard-families")
        edges.append(staged(_block_pairs(placed, grams).mapInArrow(_links(percent), "a long, b long"), "jaccard-links"))
        components = connected_components(reduce(DataFrame.unionByName, edges), "jaccard-components")
    of_class = classes.withColumn("node", F.col("sid"))
    if components is not None:
        linked = staged(components.join(classes.select(F.col("sid").alias("node"), "doc_id"), "node"), "jaccard-linked")
        lowest = linked.groupBy("component").agg(F.min("doc_id").alias("lowest"))
        linked = linked.join(lowest, "component").select(F.col("node").alias("sid"), "lowest", F.col("component").alias("node"))
        of_class = classes.join(linked, "sid", "left").select(
            "sid", F.coalesce("lowest", "doc_id").alias("doc_id"), F.coalesce("node", "sid").alias("node")
        )
    of_class = staged(of_class.select("sid", F.col("doc_id").alias("component_id"), "node"), "jaccard-result")
    # Rows without a set go past the join, so that NULLs do not gather in one task.
    matched = known.select("doc_id", "n", "sid", "row").join(of_class, "sid").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "node", "row"
    )
    alone = described.where("doc_id IS NULL OR sid IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("node"), "row"
    )
    return matched.unionByName(alone)
