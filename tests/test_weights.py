"""Fitted annotation weights: planted ones, a plain numpy fit, keys, and odd tables."""

import numpy as np
import pytest

from variantloom.operators import weights


def planted(n, seed, intercept=-2.0, w=(1.5, -0.8)):
    """log Bayes factors of z scores, where SNPs are causal by two annotations."""
    rng = np.random.default_rng(seed)
    a = rng.random((n, 2)) < (0.3, 0.5)
    causal = rng.random(n) < 1 / (1 + np.exp(-(intercept + a @ np.array(w))))
    nv = 20.0
    z = rng.standard_normal(n) * np.where(causal, np.sqrt(1 + nv), 1.0)  # so that exp(log_bf) is the true ratio
    return a.astype(int), -0.5 * np.log(1 + nv) + 0.5 * z * z / (1 / nv + 1)


def em(a, log_bf, ridge, offset=None, rounds=4000):
    """Plain EM: responsibilities, then a logistic regression on them by Newton steps to its end."""
    x = np.column_stack([np.ones(len(a)), a]) if offset is None else np.asarray(a, float)
    offset = np.zeros(len(a)) if offset is None else offset
    pen = np.array([0.0] + [ridge] * a.shape[1])[-x.shape[1]:]
    theta = np.zeros(x.shape[1])
    for _ in range(rounds):
        q, old = 1 / (1 + np.exp(-(offset + x @ theta + log_bf))), theta.copy()
        for _ in range(50):
            p = 1 / (1 + np.exp(-(offset + x @ theta)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pen), x.T @ (q - p) - pen * theta)
            theta = theta + step
            if np.abs(step).max() < 1e-12:
                break
        if np.abs(theta - old).max() < 1e-11:
            break
    eta = offset + x @ theta
    return theta, (np.logaddexp(0, eta + log_bf) - np.logaddexp(0, eta)).sum() - 0.5 * (pen * theta**2).sum()


def frame(spark, a, log_bf, *more, names=""):
    rows = [(int(x), int(y), float(v), *(m[i] for m in more)) for i, ((x, y), v) in enumerate(zip(a, log_bf, strict=True))]
    return spark.createDataFrame(rows, "dhs int, vep int, log_bf double" + names)


def test_planted_weights_come_back(spark):
    a, log_bf = planted(20_000, 1)
    fit, history = weights.fit_weights(frame(spark, a, log_bf), ["dhs", "vep"])
    row = fit.collect()
    assert len(row) == 1 and row[0].converged and row[0].intercept == pytest.approx(-2, abs=0.2) and row[0].dhs == pytest.approx(1.5, abs=0.2) and row[0].vep == pytest.approx(-0.8, abs=0.2)
    seen = [r.log_likelihood for r in history.orderBy("round").collect()]
    assert all(b > a - 1e-6 for a, b in zip(seen, seen[1:])) and len(seen) == row[0].n_rounds < 30


def test_as_plain_em_for_each_key(spark):
    parts = [planted(400, 2), planted(600, 3, -1.0, (0.5, 0.5)), planted(300, 4, -1.5, (0.0, 2.0))]
    a, log_bf = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    key = ["one"] * 400 + [None] * 600 + ["three"] * 300
    for most in (100_000, 0):  # states sent to all tasks, and joined
        fit, _ = weights.fit_weights(frame(spark, a, log_bf, key, names=", theta string"), ["dhs", "vep"], "theta", ridge=0.01, max_broadcast=most)
        got = {r.theta: r for r in fit.collect()}
        assert got.keys() == {"one", None, "three"}
        for (x, y), k in zip(parts, ("one", None, "three"), strict=True):
            theta, ll = em(x, y, 0.01)
            assert [got[k].intercept, got[k].dhs, got[k].vep] == pytest.approx(theta.tolist(), abs=1e-4) and got[k].log_likelihood == pytest.approx(ll, abs=1e-6)


def test_given_share_instead_of_an_intercept(spark):
    a, log_bf = planted(800, 5)
    pi = [0.1 if i % 2 else 0.2 for i in range(800)]
    snps = frame(spark, a, log_bf, pi, names=", pi double")
    row = weights.fit_weights(snps, ["dhs", "vep"], pi="pi")[0].first()
    theta, _ = em(a, log_bf, 1e-3, np.log(np.array(pi) / (1 - np.array(pi))))
    assert row.intercept is None and [row.dhs, row.vep] == pytest.approx(theta.tolist(), abs=1e-4)
    squashed = weights.fit_weights(snps, ["dhs", "vep"], pi="pi", squash=True)[0].first()
    assert squashed.dhs == pytest.approx(1 / (1 + np.exp(-theta[0])), abs=1e-4)


def test_odd_tables(spark):
    a, log_bf = planted(300, 6)
    plain = frame(spark, a, log_bf)
    want = weights.fit_weights(plain, ["dhs", "vep"])[0].first()
    odd = plain.unionByName(spark.createDataFrame([(1, 1, None), (1, 0, float("nan")), (0, 1, float("inf"))], plain.schema)).replace(0, None, ["dhs"])
    got = weights.fit_weights(odd, ["dhs", "vep"])[0].first()
    assert [got.intercept, got.dhs, got.vep] == pytest.approx([want.intercept, want.dhs, want.vep], abs=1e-6)
    assert weights.fit_weights(plain.limit(0), ["dhs"])[0].collect() == []
    twin = weights.fit_weights(plain.withColumn("twin", plain.dhs).withColumn("none", plain.dhs * 0), ["dhs", "twin", "none", "vep"])[0].first()
    assert twin.dhs == pytest.approx(twin.twin, abs=1e-3) and twin.none == pytest.approx(0, abs=1e-9) and twin.converged  # equal columns share their weight
    hopeless = weights.fit_weights(plain.withColumn("log_bf", plain.log_bf * 0 - 1), ["dhs"])[0].first()
    assert hopeless.intercept <= -10 and abs(hopeless.dhs) < 1  # nothing is causal: the share goes to its bound
