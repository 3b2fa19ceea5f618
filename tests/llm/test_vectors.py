import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from variantloom.llm import centroids, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, x int, cluster string"
DATA = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "own") for i, v in rows], SCHEMA)


def whole(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def fixed(v):
    return [math.floor(64 * float(np.float32(c))) for c in v]


@pytest.mark.parametrize("kind", ["random", "tight", "equal", "low rank", "steep", "one"])
def test_leading_components_like_a_dense_solver(kind):
    rng, d = np.random.default_rng(3), 1 if kind == "one" else 40
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"random": rng.random(d) * 9, "tight": 1 + 1e-9 * np.arange(d), "equal": np.repeat([4.0, 2.0], d // 2), "low rank": np.r_[np.ones(7), np.zeros(d - 7)] if d > 7 else [], "steep": 10.0 ** -np.linspace(0, 12, d), "one": np.array([3.0])}[kind]
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, u = whitening.leading(v, 32)
    assert len(e) == {"low rank": 7, "one": 1}.get(kind, 32)
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1][: len(e)], rtol=0, atol=1e-13 * values.max())
    assert np.abs(v @ u - u * e).max() < 1e-13 * values.max() and np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13


def test_counts_of_inertia():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((12, 12))
    v = a + a.T
    t, e = whitening.tridiagonal(v), np.linalg.eigvalsh(v)
    shifts = np.r_[e - 1e-9, e + 1e-9, -99, 99]
    assert whitening.counts(t, shifts).tolist() == [int((e >= s).sum()) for s in shifts]
    for low, high, first, last in whitening.isolate(t, 50.0, 1e-12):
        assert first == last and low <= e[::-1][first - 1] < high and ((e >= low) & (e < high)).sum() == 1


def test_whitening_by_brute_force(spark):
    rng = np.random.default_rng(0)
    mix = rng.standard_normal((8, 8))
    rows = [(i, (rng.standard_normal(8) @ mix).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (None, rows[1][1]), (301, None), (302, [1.0] * 7 + [math.nan]), (303, [1.0] * 7 + [None]), (304, [math.inf] + [0.0] * 7), (305, []), (306, [1.0, 2.0])]
    kept = [(i, v) for i, v in rows if whole(v) and len(v) == 8]
    x = np.array([fixed(v) for _, v in kept], dtype=object) + 1_000_000
    n, s = len(x), x.sum(0)
    off = n * x - s
    cov = (off / n).astype(float)
    cov = cov.T @ cov / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    got = whitening.whiten(table(spark, rows), components=5).collect()
    assert len(got) == 5 * n and sorted({str(r.vec_id) for r in got}) == sorted({str(i) for i, _ in kept})
    want = {}
    for (i, _), o in zip(kept, off, strict=True):
        want.setdefault(i, ((o * o).sum(), (o / n).astype(float) @ u / np.sqrt(e)))
    sign = {}
    for r in got:
        far, w = want[r.vec_id]
        c = r.component - 1
        sign.setdefault(c, np.sign(r.whitened * w[c]))
        assert r.n == n and r.deviation == far and abs(r.whitened * sign[c] - w[c]) < 1e-9
        assert abs(r.explained / (e[c] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [math.nan])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # no spread
    one = whitening.whiten(table(spark, [(1, [0.0, 0.0]), (2, [1e16, 0.0]), (3, [1e16, 0.0])])).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation) for r in one} == {(i, 1, 3, None) for i in (1, 2, 3)}  # beyond 64 bits
    assert abs(one[0].explained - 1) < 1e-12 and one[0].identity_error < 1e-9


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for most in (10, 1 << 24, 1 << 40):
        d = rng.integers(-most, most, (50, 3))
        assert (whitening.products(d) == d.astype(object).T @ d.astype(object)).all()
    assert vectors.exact_sum(np.full((4, 2), 1 << 61)).tolist() == [1 << 63] * 2


def clustered(rows, k, rounds, d):
    """(vec_id, vector) -> what cluster returns, by comparing all centres."""
    x = [(i, fixed(v)) for i, v in rows if whole(v) and len(v) == d]
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(x, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in x]
        own = [[v for (_, v), o in zip(x, of, strict=True) if o == j] for j in range(len(centres))]
        centres = [[sum(col) // len(vs) for col in zip(*vs, strict=True)] if vs else c for c, vs in zip(centres, own, strict=True)]
    got = [(i, *near(v)[::-1]) for i, v in x]
    sums = [sum(s for _, c, s in got if c == j) for j in range(len(centres))]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, s, sums[c], sum(sums), name[c]) for i, c, s in got), key=repr)


def test_clustering_by_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(0, 4, 6) / 8 + rng.integers(0, 3)).astype(np.float32).tolist()) for i in range(400)]  # many ties
    rows += [(i, rows[0][1]) for i in range(400, 520)] + [(7, [9.0] * 6), (7, [-9.0] * 6), (None, [0.5] * 6), (600, None), (601, [1.0] * 5), (602, [1.0] * 5 + [math.nan]), (603, [1.0] * 5 + [None]), (604, [])]
    for k, rounds, pivots in ((16, 3, 8), (5, 1, 2), (3, 0, 1)):
        got = centroids.cluster(table(spark, rows), k, rounds, 6, pivots)
        assert sorted(map(tuple, got.collect()), key=repr) == clustered(rows, k, rounds, 6)


def test_clustering_of_the_table_and_of_odd_ones(spark):
    found = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    got = centroids.cluster(spark.read.parquet(f"{DATA}/embeddings.parquet"))
    assert sorted(map(tuple, got.collect()), key=repr) == clustered([(r.vec_id, r.embedding) for r in found], 16, 3, 64)
    assert centroids.cluster(table(spark, [])).collect() == [] and centroids.cluster(table(spark, [(1, None)])).collect() == []
    few = [(1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [1e12, 0.0])]
    assert sorted(map(tuple, centroids.cluster(table(spark, few), 16, 3, 2).collect()), key=repr) == clustered(few, 16, 3, 2)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 20), st.integers(1, 9), st.sampled_from([3, 50, 10**6, 10**12]), st.integers(1, 5))
def test_no_nearest_centre_is_ruled_out(seed, k, pivots, size, d):
    rng = np.random.default_rng(seed)
    x, centres = rng.integers(-size, size + 1, (80, d)), rng.integers(-size, size + 1, (k, d))
    simplex = centroids.choose_pivots(rng.integers(-size, size + 1, (12, d)), pivots)
    apex = centroids.apexes(np.column_stack([centroids.squares(x, p[None, :]) for p in simplex.pivots]), simplex)
    best, near, looked = centroids.assign(x, apex, centres, simplex)
    far = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in centres] for v in x], dtype=object)
    assert best.tolist() == [int(min(range(k), key=lambda j: (f[j], j))) for f in far] and near.tolist() == [min(f) for f in far]
    assert looked <= x.shape[0] * k


def test_most_centres_are_ruled_out():
    rng = np.random.default_rng(8)
    centres = rng.integers(-1000, 1000, (16, 10))
    x = np.repeat(centres, 20, 0) + rng.integers(-20, 21, (320, 10))
    simplex = centroids.choose_pivots(centres, 8)
    apex = centroids.apexes(np.column_stack([centroids.squares(x, p[None, :]) for p in simplex.pivots]), simplex)
    assert centroids.assign(x, apex, centres, simplex)[2] < 2 * len(x)  # of 16
