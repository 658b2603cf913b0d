"""FEAST: inertia, eigenvectors against numpy, whitening against a plain version, hard cases."""
import numpy as np
import pytest

from wattgrid.llm import feast_whitening as W

SCHEMA = "vec_id long, embedding array<double>, n string, _v string"
RNG = np.random.default_rng(5)


def covariances():
    for d in (1, 2, 7, 64, 130):
        a = RNG.standard_normal((3 * d + 5, d)) * np.exp(RNG.standard_normal(d))
        yield a.T @ a / len(a), min(d, 32)
    q, _ = np.linalg.qr(RNG.standard_normal((40, 40)))
    yield q @ np.diag([5.0] * 10 + [3.0] * 25 + [1.0] * 5) @ q.T, 32  # equal eigenvalues
    yield np.eye(50) * 7, 32
    a = RNG.standard_normal((3, 30))
    yield a.T @ a, 3  # without full rank
    yield np.diag([1e8, 1.0, 1e-3, 0.0]), 3
    yield np.zeros((6, 6)), 0
    for rows in (3_000, 30_000):  # all eigenvalues close together
        a = np.floor(RNG.standard_normal((rows, 64)) * 8)
        yield a.T @ a / rows, 32


@pytest.mark.parametrize("case", range(12))
def test_eigenvectors(case):
    v, count = list(covariances())[case]
    true = np.linalg.eigvalsh(v)
    tri = W.tridiagonal(v)
    for shift in np.linspace(-0.5, true[-1] * 1.1, 9) + 0.0123:
        assert W.inertia(tri, [shift])[0] == (true < shift).sum()
    e, u = W.top_eigenvectors(v)
    assert len(e) == count and np.allclose(e, true[::-1][:count], rtol=1e-10, atol=true[-1] * 1e-13)
    assert np.abs(u.T @ u - np.eye(count)).max(initial=0) < 1e-10
    assert np.abs(v @ u - u * e).max(initial=0) <= 1e-11 * max(1, true[-1])


def test_an_eigenvalue_missed_is_an_error():
    v = np.diag([4.0, 3.0, 2.0, 1.0])
    with pytest.raises(ArithmeticError):
        W.feast(v, 2.5, 5.0, 3)


def plain(rows, components=32):
    """The contract, step by step."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * c)) + 1000000 for c in v] for _, v in ok]
    n = len(x)
    s = [sum(c) for c in zip(*x)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    c = np.array([[a - b / n for a, b in zip(r, s)] for r in x])
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return ok, n, dev, c @ u / np.sqrt(e), e / np.trace(v)


def check(got, rows, components=32):
    ok, n, dev, w, explained = plain(rows, components)
    k = len(explained)
    assert len(got) == len(ok) * k
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    sign = {}
    for (i, _), d, row, in zip(ok, dev, w):
        mine = sorted(by[i], key=lambda r: r["component"])[:k]
        assert [r["component"] for r in mine] == list(range(1, k + 1))
        for r, x, e in zip(mine, row, explained):
            assert r["n"] == n and r["deviation"] == d and abs(r["explained"] / e - 1) < 1e-9 and r["identity_error"] < 1e-9
            s = sign.setdefault(r["component"], 1 if abs(r["whitened"] - x) < 1e-6 else -1)
            assert abs(r["whitened"] * s - x) < 1e-6


def test_equals_plain_version(spark):
    base = RNG.standard_normal((400, 12)) * np.linspace(3, 0.2, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a third are copies
    bad = [(2000, None), (2001, [None] + [1.0] * 11), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + bad], SCHEMA).repartition(4)
    usable = W.vectors(df)
    got = W.whiten(usable, W.fit(usable)).collect()
    check(got, rows + bad)
    few = W.fit(usable, 3)
    check(W.whiten(usable, few).collect(), rows, 3)
    # other lengths, empty vectors, integers beyond doubles, repeated rows, a NULL id
    more = [(3000, []), (3001, [1.0] * 3), (3002, [1e300] * 12)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + more + [(None, [0.5] * 12)]], SCHEMA)
    usable = W.vectors(df)
    assert usable.count() == len(rows) + 1
    assert W.whiten(usable, W.fit(usable)).filter("vec_id IS NULL").count() == 12


def test_few_rows_and_none(spark):
    def run(rows):
        usable = W.vectors(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA))
        return W.fit(usable)
    assert run([]) is None and run([(1, [1.0, 2.0])]) is None and run([(1, [1.0]), (2, [1.0])]) is None
    two = run([(1, [0.0, 0.0]), (2, [1.0, 1.0])])
    assert len(two.explained) == 1 and abs(two.explained[0] - 1) < 1e-12


def test_wide_sums_are_exact():
    whole, rest = np.array([[3_000_000_000, -5]], np.int64), np.array([1, 2], np.int64)
    assert W._deviations(whole, rest, 1000).to_pylist() == [None]
    assert W._deviations(np.array([[7, -5]], np.int64), rest, 10).to_pylist() == [69 ** 2 + 52 ** 2]
    near = np.array([[3_037_000_499, 0]], np.int64)
    assert W._deviations(near, np.array([0, 0]), 1).to_pylist() == [3_037_000_499 ** 2]


def test_registered_query(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    check(W.op13_feast_whitening(spark, path).collect(), rows)
