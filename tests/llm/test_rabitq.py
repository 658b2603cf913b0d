"""One-bit codes: bounds, recall against brute force, hard cases."""
import numpy as np

from wattgrid.llm import rabitq as R

SCHEMA = "vec_id long, embedding array<float>, _far string, _v string"


def test_bounds_hold():
    rng = np.random.default_rng(0)
    v, q = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    centre = R.unit(v).mean(0)
    turn = R.rotation(64)
    assert turn.shape == (512, 64) and np.allclose(turn.T @ turn, np.eye(64))
    codes = R.Codes(*R.encode(v, centre, turn))
    got = [codes.bounds(R.Query(x, centre, turn)) for x in q]
    est, width = np.array([g[0] for g in got]), np.array([g[1] for g in got])
    true = R.unit(q) @ R.unit(v).T
    assert (np.abs(est - true) <= width).mean() > 0.995 and abs((est - true).mean()) < 0.005
    assert width.max() < 0.15


def test_bit_counts_give_the_product_of_the_rounded_query():
    rng = np.random.default_rng(3)
    v, q = rng.standard_normal((300, 70)), rng.standard_normal(70)
    centre, turn = R.unit(v).mean(0), R.rotation(70, bits=64)
    assert len(turn) == 128
    code, far, own, agree = R.encode(v, centre, turn)
    one = R.Query(q, centre, turn)
    level = sum(np.unpackbits(p.view(np.uint8).ravel()).astype(int) << j for j, p in enumerate(one.planes))
    rounded = one.low + one.step * level
    d = R.unit(q[None, :])[0] - centre
    assert np.abs(rounded - turn @ d).max() <= one.step / 2 + 1e-12
    signs = (np.unpackbits(code, axis=1).astype(float) * 2 - 1) / np.sqrt(128)
    want = signs @ rounded * far / agree + d @ centre + own
    assert np.allclose(R.Codes(code, far, own, agree).bounds(one)[0], want)


def test_few_vectors_are_compared_exactly(spark):
    """Whole table of SF 0.1: recall against brute force, and the share of exact comparisons."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = R.build_index(rows)
    queries = index[0].filter("_id % 50 = 0")
    found = R.candidates(index, queries, 5).toPandas()
    all_rows = index[0].select("_id", "_v").toPandas().sort_values("_id")
    ids, v = all_rows["_id"].to_numpy(), R.unit(np.array(all_rows["_v"].tolist()))
    hits = n = 0
    for q, g in found.groupby("query_id"):
        sims = v @ v[ids == q][0]
        sims[ids == q] = -2
        want = set(ids[np.lexsort((ids, -sims))[:5]])
        hits += len(want & set(g.sort_values(["score", "vec_id"], ascending=[False, True])["vec_id"][:5]))
        n += 5
    share = found["reranked"].sum() / (len(ids) * (n / 5))
    print(f"recall {hits / n:.4f}, exact comparisons {share:.4f}")
    assert hits >= 0.99 * n and share < 0.1


def test_huge_and_tiny_components(spark):
    rows = [(0, [1e200, 0.0, 1e200]), (1, [2e-200, 0.0, 2e-200]), (2, [1.0, 0.0, 1.0]), (3, [0.0, 1.0, 0.0]), (4, [5e-324, 0.0, 5e-324])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = R.build_index(df)
    got = [(r["vec_id"], round(r["score"], 9)) for r in R.search(index, index[0].filter("_id = 0"), 4).orderBy("rank").collect()]
    assert got == [(1, 1.0), (2, 1.0), (4, 1.0), (3, 0.0)]


def brute(rows, every, k):
    ok = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v) or len(v) != 16:
            continue
        ok[(i, tuple(v))] = np.array(v, np.float32).astype(float)
    out = {}
    for (i, key), q in ok.items():
        if i % every == 0:
            c = [(-float((a * q).sum() / (np.sqrt((a * a).sum()) * np.sqrt((q * q).sum()))), j) for (j, _), a in ok.items() if j != i]
            out[i] = sorted(c)[:k]
    return out


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((8, 16))
    rows = [(i, [float(x) for x in (base[i % 8] + 0.4 * rng.standard_normal(16)).astype(np.float32)]) for i in range(600)]
    hot = [float(x) for x in base[0].astype(np.float32)]
    rows += [(1000 + i, hot) for i in range(200)]  # one vector many times: ties by id
    rows += [(2000, None), (2010, [0.0] * 16), (2020, [None] + [1.0] * 15), (2030, [float("nan")] * 16), (2040, [float("inf")] * 16), (None, hot), (2050, [1.0] * 3), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    index = R.build_index(df, fit_rows=100)
    got = {}
    for r in R.search(index, index[0].filter("_id % 10 = 0"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    want = brute(rows, 10, 5)
    assert set(got) == set(want)
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.99 * 5 * len(want)
    assert [j for _, j in got[1000]] == [1001, 1002, 1003, 1004, 1005]
    for q in want:
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], atol=0.02)


def test_few_rows_and_none(spark):
    assert R.build_index(spark.createDataFrame([], SCHEMA)) is None
    one = R.build_index(spark.createDataFrame([(0, [1.0, 2.0], "", "")], SCHEMA))
    assert R.search(one, one[0], 5).count() == 0
    two = R.build_index(spark.createDataFrame([(0, [1.0, 2.0], "", ""), (1, [2.0, 1.0], "", "")], SCHEMA))
    assert [(r["query_id"], r["vec_id"], round(r["score"], 9)) for r in R.search(two, two[0], 5).orderBy("query_id").collect()] == [(0, 1, 0.8), (1, 0, 0.8)]
