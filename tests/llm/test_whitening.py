import numpy as np
import pytest

from martkeep.llm import whitening
from martkeep.llm.queries import QUERIES

FLOATS = "vec_id long, embedding array<float>, label string, whitened string, vector string, deviation string"


def frame(spark, vectors):
    rows = [(i, v, "clash", "clash", "clash", "clash") for i, v in vectors]
    return spark.createDataFrame(rows, FLOATS)


def brute(vectors, components=32):
    """{(vec_id, component): (deviation, whitened)} and explained, by numpy's eigenvectors."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    y = off.astype(float) / n
    covariance = y.T @ y / n
    values, q = np.linalg.eigh(covariance)
    values, q = values[::-1], q[:, ::-1]
    return n, (off**2).sum(axis=1), y @ q[:, :components] / np.sqrt(values[:components]), values[:components] / values.sum()


def matrices():
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    wide = rng.standard_normal((64, 100))
    thin = rng.standard_normal((40, 3))
    return {
        "full": wide @ wide.T, "identity": 3 * np.eye(20), "zero": np.zeros((5, 5)), "one": np.array([[2.0]]), "rank 3": thin @ thin.T,
        "equal values": turn @ np.diag([5.0] * 10 + [2.0] * 10 + [1e-6] * 10) @ turn.T, "diagonal": np.diag([1.0, 2.0, 3.0]),
        "wide range": turn @ np.diag(10.0 ** -np.arange(0, 15, 0.5)) @ turn.T, "symmetric about 0": np.diag([-1.0, 0.0, 1.0]) + 1.0 * np.eye(3),
    }


@pytest.mark.parametrize("name", matrices())
def test_components_are_eigenvectors(name):
    a = matrices()[name]
    values, q = whitening.spectrum(a)
    size = max(np.linalg.norm(a), 1e-300)
    assert np.abs(q.T @ q - np.eye(len(a))).max() < 1e-13
    assert np.linalg.norm(a @ q - q * values) <= 1e-13 * size
    assert np.abs(values - np.maximum(np.linalg.eigvalsh(a)[::-1], 0)).max() <= 1e-13 * size


def test_polar_factor():
    a = matrices()["full"] - 80 * np.eye(64)
    factor = whitening.polar(a)
    assert np.abs(factor @ factor - np.eye(64)).max() < 1e-12 and np.linalg.eigvalsh(factor @ a).min() > 0
    assert whitening.polar(np.zeros((3, 3)) + np.diag([1.0, 1.0, 0.0])) is None


def check(spark, vectors, tolerance=1e-9):
    out = whitening.component_table(frame(spark, vectors)).toPandas()
    n, deviation, white, explained = brute(vectors)
    count = white.shape[1]
    assert len(out) == n * count and (out.n == n).all()
    out = out.sort_values(["vec_id", "component"])
    got = out.whitened.to_numpy().reshape(n, count)
    assert np.abs(np.abs(got) - np.abs(white)).max() < tolerance
    for k in range(count):  # either sign, the same for all rows
        assert min(np.abs(got[:, k] - white[:, k]).max(), np.abs(got[:, k] + white[:, k]).max()) < tolerance
    assert [int(d) for d in out.deviation.to_numpy().reshape(n, count)[:, 0]] == [int(d) for d in deviation]
    assert np.allclose(out.explained.to_numpy().reshape(n, count)[0], explained, rtol=1e-9)
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-9


def test_against_eigh(spark):
    rng = np.random.default_rng(1)
    check(spark, [(i, (rng.standard_normal(40) * np.linspace(1, 3, 40)).tolist()) for i in range(300)])


def test_few_dimensions_and_a_hot_vector(spark):
    rng = np.random.default_rng(2)
    check(spark, [(i, ([0.5, 1.0, -2.0] if i % 3 == 0 else rng.standard_normal(3).tolist())) for i in range(90)])


def test_rows_that_are_left_out(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(4).tolist()) for i in range(20)] + [(3, [1.0, 2.0, 3.0, 4.0]), (None, [0.0, 1.0, 0.0, 1.0])]
    bad = [
        (100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan"), 0.0, 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0, 0.0]),
        (104, []), (105, [1.0, 2.0]), (106, [float("-inf")] * 4),
    ]
    out = whitening.component_table(frame(spark, good + bad)).toPandas()
    assert len(out) == len(good) * 4 and (out.n == len(good)).all() and not set(out.vec_id.dropna()) & set(range(100, 107))
    assert out.vec_id.isna().sum() == 4


def test_no_rows_one_row_and_no_variance(spark):
    assert whitening.component_table(frame(spark, [])).count() == 0
    assert whitening.component_table(frame(spark, [(1, None)])).count() == 0
    for vectors in ([(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        out = whitening.component_table(frame(spark, vectors)).collect()
        assert len(out) == 2 * len(vectors)
        assert all((r["whitened"], r["explained"], r["deviation"], r["identity_error"]) == (0.0, 0.0, 0, 0.0) for r in out)


def test_fewer_rows_than_dimensions(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.standard_normal(10).tolist()) for i in range(4)]
    out = whitening.component_table(frame(spark, vectors)).toPandas()
    assert len(out) == 40 and (out[out.component > 3].whitened == 0).all() and out.identity_error.iloc[0] < 1e-9
    assert abs(out[out.vec_id == 0].explained.sum() - 1) < 1e-9


def test_very_large_entries_are_exact(spark):
    vectors = [(0, [1e12, 0.0]), (1, [-1e12, 1.0]), (2, [0.0, 2.0])]
    out = whitening.component_table(frame(spark, vectors)).toPandas().drop_duplicates("vec_id").set_index("vec_id")
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in vectors]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    for i, w in enumerate(want):
        got = out.deviation[i]
        assert (np.isnan(got) if w >= 1 << 63 else int(got) == w), (i, got, w)


def test_whiten_keeps_columns(spark):
    vectors = frame(spark, [(i, [float(i), float(i * i % 7)]) for i in range(10)])
    model = whitening.fit_whitening(vectors)
    out = whitening.whiten(vectors, model)
    assert out.columns == ["vec_id", "embedding", "label", "whitened", "deviation"]
    assert whitening.whiten(vectors, None).count() == 0
    assert whitening.identity_error(vectors, model) < 1e-12


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    out = QUERIES["op11_whitening"](spark, folder).toPandas().sort_values(["vec_id", "component"])
    n, deviation, white, explained = brute([(r["vec_id"], r["embedding"]) for r in sorted(rows, key=lambda r: r["vec_id"])])
    assert np.abs(np.abs(out.whitened.to_numpy().reshape(white.shape)) - np.abs(white)).max() < 1e-9
    assert (out.deviation.to_numpy().reshape(white.shape)[:, 0] == deviation.astype(np.int64)).all()
    assert dict(out.dtypes.astype(str)) == {
        "vec_id": "int64", "component": "int32", "n": "int64", "deviation": "int64", "whitened": "float64", "explained": "float64", "identity_error": "float64",
    }
