"""Embedding whitening: eigenvectors of the covariance by QDWH spectral divide and conquer.

Rows are read in tasks; what comes together are sums and the d x d covariance. That is cut by
polar decompositions of its shifted form: the polar factor has eigenvalues -1 and 1, so half
of its sum with the identity projects on the eigenvectors above the shift. The covariance is
restricted to the two subspaces, and each is cut again until single components are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeep.llm.common import staged

SCALE, OFFSET = 64.0, 1_000_000
#: Beyond this the d x d matrices that tasks and the driver hold would pass 128 MB.
MOST_DIMENSIONS = 4096
WIDEST = 1 << 62
EPS = float(np.finfo(float).eps)


# -- the decomposition -----------------------------------------------------------------


def polar(x: np.ndarray) -> np.ndarray | None:
    """The orthogonal polar factor of a symmetric matrix by QDWH; None where it is singular.

    Dynamically weighted Halley steps: weights follow from a lower bound of the smallest
    singular value, so six steps or so do for any condition. Steps far from the end go by
    QR, which is stable there, the last ones by Cholesky.
    """
    n = len(x)
    x = x / np.linalg.norm(x)
    try:
        low = 0.9 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        return None
    if not low > 4 * EPS:
        return None
    low = min(low, 1.0)
    eye = np.eye(n)
    for _ in range(30):
        before, square = x, low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        a = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            x = b / c * x + (a - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            half = np.linalg.inv(np.linalg.cholesky(eye + c * (x.T @ x)))
            x = b / c * x + (a - b / c) * (x @ half.T @ half)
        x = (x + x.T) / 2
        low = min(1.0, low * (a + b * square) / (1 + c * square))
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) < 1e-10 * np.sqrt(n):
            break
    return x


def shifts(a: np.ndarray) -> Iterator[float]:
    """Where to cut a spectrum: the median of the diagonal, the mean, and places around it.

    Unless all eigenvalues are equal there are some on both sides of their mean.
    """
    yield float(np.median(np.diag(a)))
    mean = np.trace(a) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(len(a))) / np.sqrt(len(a))
    for step in (0, 0.1, -0.1, 0.23, -0.23, 0.37, -0.37, 0.53, -0.53, 0.71, -0.71):
        yield float(mean + step * spread)


def subspaces(a: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of ``a``, split at some shift."""
    n = len(a)
    random = np.random.default_rng(n)
    for shift in shifts(a):
        factor = polar(a - shift * np.eye(n))
        if factor is None:
            continue
        projector = (factor + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n or np.linalg.norm(projector @ projector - projector) > 1e-8 * n:
            continue
        start = random.standard_normal((n, k))
        for _ in range(3):
            q, _ = np.linalg.qr(projector @ start, mode="complete")
            above, below = q[:, :k], q[:, k:]
            if np.linalg.norm(below.T @ a @ above) <= 8 * EPS * n * size:
                return above, below
            start = above
        if np.linalg.norm(below.T @ a @ above) <= 1e-10 * size:
            return above, below
    return None


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Each vector's largest entry is positive. Blocks that are a multiple of the identity, to
    rounding, are not cut further: any basis of theirs will do.
    """
    a = (a + a.T) / 2
    size = float(np.linalg.norm(a))
    basis = np.eye(len(a))
    open_blocks, vectors = [basis], []
    while open_blocks:
        basis = open_blocks.pop()
        n = basis.shape[1]
        block = basis.T @ a @ basis
        block = (block + block.T) / 2
        if n > 1 and np.linalg.norm(block - np.trace(block) / n * np.eye(n)) > 4 * EPS * n * size:
            if (cut := subspaces(block, size)) is not None:
                open_blocks += [np.linalg.qr(basis @ part)[0] for part in cut]
                continue
        vectors.append(basis)
    q = np.linalg.qr(np.hstack(vectors))[0]
    values = np.einsum("ij,ij->j", q, a @ q)
    order = np.argsort(-values, kind="stable")
    values, q = np.maximum(values[order], 0.0), q[:, order]
    return values, q * np.where(q[np.abs(q).argmax(axis=0), np.arange(len(q))] < 0, -1.0, 1.0)


# -- in Spark --------------------------------------------------------------------------


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 of each entry; entries beyond +-2^62 stop there."""
    scaled = np.floor(vectors * SCALE)
    return np.clip(scaled, -float(WIDEST), float(WIDEST)).astype(np.int64) + OFFSET


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """The rows of a list column, all of one length and without nulls, as integers."""
    vectors = batch.column(column)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return integers(flat.reshape(len(vectors), -1) if len(vectors) else np.empty((0, 0)))


def _sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, n, widest, sums) of one task's vectors by their length; exact."""
    found: dict[int, list] = {}
    for batch in rows:
        sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes).tolist():
            x = matrix(batch.filter(pa.array(sizes == size)), "vector")
            state = found.setdefault(size, [0, 0, np.zeros(size, object)])
            state[0] += len(x)
            state[1] = max(state[1], abs(int(x.max())), abs(int(x.min())))
            exact = x if state[1] < WIDEST // max(1, len(x)) else x.astype(object)
            state[2] = state[2] + exact.sum(axis=0).astype(object)
    kind = pa.schema([("size", pa.int32()), ("n", pa.int64()), ("widest", pa.int64()), ("sums", pa.list_(pa.decimal128(38)))])
    for size, (n, widest, sums) in found.items():
        yield pa.RecordBatch.from_pylist([{"size": size, "n": n, "widest": widest, "sums": [Decimal(int(s)) for s in sums]}], kind)


@dataclass(frozen=True)
class Whitening:
    """What :func:`whiten` needs: the fit list's count and sums, components and their variances."""

    n: int
    sums: tuple[int, ...]
    widest: int  # largest absolute entry
    values: np.ndarray  # of all components, falling
    vectors: np.ndarray  # a column each
    components: int

    @property
    def explained(self) -> np.ndarray:
        total = float(self.values.sum())
        return self.values[: self.components] / total if total else np.zeros(self.components)

    @property
    def varies(self) -> np.ndarray:
        """Whether a component has any variance beyond rounding; others cannot be whitened."""
        values = self.values[: self.components]
        return values > 64 * EPS * len(self.values) * self.values[:1]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as 64-bit integers where these cannot overflow, else as Python's."""
        sums = np.array(self.sums, object)
        if 4 * self.n * self.widest < WIDEST:
            return self.n * x - sums.astype(np.int64)
        return self.n * x.astype(object) - sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.varies, self.values[: self.components], np.inf)
        return self.centred(x) @ (self.vectors[:, : self.components] / np.sqrt(scale))


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, not empty and free of null and non-finite entries; as array<double> ``vector``."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(entries, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    return vectors.select(
        entries.alias("vector"), *[F.col(f"`{c}`") for c in vectors.columns if c != "vector"]
    ).where((F.size("vector") > 0) & F.coalesce(finite, F.lit(False)))


def in_few_tasks(df: DataFrame) -> DataFrame:
    """``df`` in a few tasks per core: what they hand on is as large as a matrix, whatever they read."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def gram(df: DataFrame, rows_of, purpose: str) -> np.ndarray:
    """Sum over all vectors of the outer products of ``rows_of(x)`` with themselves.

    Each task adds up its own matrix and hands it on row by row; entries are summed by a
    shuffle and the one matrix comes to the driver: at most :data:`MOST_DIMENSIONS` squared.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                y = rows_of(matrix(batch.slice(start, 4096), "vector"))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            for i, row in enumerate(total):
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "entries": pa.array([row], pa.list_(pa.float64()))})

    parts = in_few_tasks(df).select("vector").mapInArrow(products, "i int, entries array<double>")
    entries = parts.select("i", F.posexplode("entries").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value"))
    rows = staged(entries.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "value"))).value.alias("row")), purpose)
    return np.array([r["row"] for r in rows.orderBy("i").collect()], float)


def fit_whitening(vectors: DataFrame, vector: str = "embedding", components: int = 32) -> Whitening | None:
    """The whitening of all usable rows of ``vectors``; None where there is none.

    Null vectors, and those that are empty or hold null or non-finite entries, are left out.
    If lengths differ, the most frequent one counts (of equally frequent ones the larger) and
    vectors of others are left out as well. Repeated rows count each time. Sums are exact;
    the covariance is added up from centred vectors. Two passes over the rows.
    """
    rows = usable(vectors, vector)
    sums = in_few_tasks(rows).select("vector").mapInArrow(_sums, "size int, n bigint, widest bigint, sums array<decimal(38,0)>")
    sums = staged(sums, "whitening-sums")
    sizes = sums.groupBy("size").agg(F.sum("n").alias("n"), F.max("widest").alias("widest"))
    best = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return None
    size, n = best["size"], best["n"]
    if size > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {size} entries; the covariance of more than {MOST_DIMENSIONS} is not held in one task")
    entries = sums.where(F.col("size") == size).select(F.posexplode("sums").alias("i", "s"))
    total = tuple(int(r["s"]) for r in entries.groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect())
    at = Whitening(n, total, best["widest"], np.empty(0), np.empty((0, 0)), 0)
    covariance = gram(rows.where(F.size("vector") == size), at.centred, "whitening-covariance") / n
    values, q = spectrum(covariance)
    return Whitening(n, total, best["widest"], values, q, min(components, size))


def whiten(vectors: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """The usable rows of ``vectors`` with ``whitened`` (array of doubles) and ``deviation``.

    whitened[k] is the row, less the mean, along component k over the root of that
    component's variance; 0 for a component without variance. deviation is the exact sum of
    squares of n * x - S, NULL where it does not fit a long. Columns of these names are
    replaced; without a model there are no rows.
    """
    size = len(model.sums) if model else 0
    rows = usable(vectors.drop("whitened", "deviation"), vector).where((F.size("vector") == size) & F.lit(model is not None))

    @F.arrow_udf(T.StructType([T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())]))
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = matrix(pa.RecordBatch.from_arrays([batch], ["vector"]), "vector").reshape(len(batch), size)
            off = model.deviations(x)
            safe = off.dtype != object and (not off.size or int(np.abs(off).max()) ** 2 * size < WIDEST)
            squares = ((off if safe else off.astype(object)) ** 2).sum(axis=1).tolist()
            white = model.whitened(x)
            ends = np.arange(len(x) + 1, dtype=np.int32) * model.components
            yield pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel())),
                    pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()),
                ],
                ["whitened", "deviation"],
            )

    out = rows.withColumn("projected", project("vector"))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns if c != "vector"], "projected.whitened", "projected.deviation")


def identity_error(vectors: DataFrame, model: Whitening | None, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, measured over all rows.

    Components without variance, which cannot be whitened, are not looked at.
    """
    if model is None or not model.varies.any():
        return 0.0
    rows = usable(vectors, vector).where(F.size("vector") == len(model.sums))
    second = gram(rows, model.whitened, "whitening-check") / model.n
    return float(np.abs(second - np.eye(model.components))[np.ix_(model.varies, model.varies)].max())


def component_table(vectors: DataFrame, vector: str = "embedding", components: int = 32) -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    model = fit_whitening(vectors, vector, components)
    error = identity_error(vectors, model, vector)
    shares: list[Column] = [F.lit(float(s)) for s in (model.explained if model else [])]
    rows = whiten(vectors.select("vec_id", vector), model, vector)
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        (F.element_at(F.array(*shares), F.col("at") + 1) if shares else F.lit(None)).cast("double").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
