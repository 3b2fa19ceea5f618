"""Annotation weights and the share of causal SNPs, fitted to the SNPs of all loci."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tables import stored


def _softplus(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def _sums(snps: DataFrame, k: int, groups: list[str], state: DataFrame, small: bool) -> DataFrame:
    """One pass over the SNPs: for each group its log-likelihood, its gradient, and the two information matrices, that of
    expected (EM) and that of observed data (Newton), all as plain sums."""
    now = state.select(*groups, "theta")
    at = snps.join(F.broadcast(now) if small else now, groups)
    x, eta = [F.col(f"x{j}") for j in range(k)], F.col("offset")
    for j in range(k):
        eta = eta + x[j] * F.col("theta")[j]
    at = at.withColumn("eta", eta).withColumns({"p": 1 / (1 + F.exp(-F.col("eta"))), "q": 1 / (1 + F.exp(-F.col("eta") - F.col("log_bf")))})
    p, q = F.col("p"), F.col("q")
    every = [(i, j) for i in range(k) for j in range(i, k)]
    both = lambda w: F.array(*(F.sum(x[i] * x[j] * w) for i, j in every))
    out = at.groupBy(*groups).agg(F.sum(_softplus(F.col("eta") + F.col("log_bf")) - _softplus(F.col("eta"))).alias("ll"), F.array(*(F.sum(c * (q - p)) for c in x)).alias("gradient"),
                                  both(p * (1 - p)).alias("expected"), both(p * (1 - p) - q * (1 - q)).alias("observed"))
    return out.join(state, groups)


def _matrices(flat: np.ndarray, k: int, penalty: np.ndarray) -> np.ndarray:
    out, at = np.zeros((len(flat), k, k)), np.triu_indices(k)
    out[:, at[0], at[1]] = out[:, at[1], at[0]] = flat
    return out + np.diag(penalty)


def next_step(got: pd.DataFrame, penalty: np.ndarray, tol: float, bound: float) -> pd.DataFrame:
    """Sums of groups at theta, and base, the last point that was taken -> base, base_ll, delta, size, theta (where to look
    next), step (what was done: newton, em, or half where the likelihood fell) and done."""
    k, wide = len(penalty), lambda c: np.array(got[c].to_list(), float).reshape(len(got), -1)
    theta, base, delta, size, base_ll = wide("theta"), wide("base"), wide("delta"), got["size"].to_numpy(float), got["base_ll"].to_numpy(float)
    ll = got["ll"].to_numpy(float) - 0.5 * (penalty * theta * theta).sum(axis=1)
    better = ll >= base_ll - 1e-10 * (1 + np.abs(ll))  # sums in another order differ by as much
    gradient = wide("gradient") - penalty * theta
    value, vector = np.linalg.eigh(_matrices(wide("observed"), k, penalty))
    newton = value[:, 0] > 1e-9 * np.abs(value[:, -1])
    other = np.linalg.eigh(_matrices(wide("expected"), k, penalty))
    value, vector = np.where(newton[:, None], value, other[0]), np.where(newton[:, None, None], vector, other[1])
    value = np.maximum(value, np.maximum(1e-9 * value[:, -1:], 1e-300))
    new = np.einsum("nij,nj->ni", vector, np.einsum("nji,nj->ni", vector, gradient) / value)
    base, delta = np.where(better[:, None], theta, base), np.where(better[:, None], new, delta)
    size = np.where(better, 1.0, size / 2)
    best = np.where(better, ll, base_ll)
    ahead = np.clip(base + size[:, None] * delta, -bound, bound)
    gain = np.abs(np.where(better, ((ahead - base) * gradient).sum(axis=1), np.inf))
    done = (gain <= tol * (1 + np.abs(best))) | (np.abs(ahead - base).max(axis=1) <= 1e-12)
    step = np.where(better, np.where(newton, "newton", "em"), "half")
    lists = {"theta": ahead, "base": base, "delta": delta}
    return got.assign(base_ll=best, size=size, step=step, done=done, n=got["n"] + 1, **{c: v.tolist() for c, v in lists.items()})


def fit_weights(snps: DataFrame, names: list[str], *keys: str, pi: str | None = None, ridge: float = 1e-3, rounds: int = 100, tol: float = 1e-11, start: float = 0.01, bound: float = 30.0,
                squash: bool = False, max_broadcast: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """SNPs (log_bf, annotations as numeric columns `names`, more columns) -> (weights, history), over all SNPs or for each
    of the keys.

    Each SNP is causal with probability p = logistic(intercept + weights x annotations), and its data are then exp(log_bf)
    times as likely: what is maximised is the sum of ln(1 - p + p BF), less ridge / 2 times the squared weights. With pi, a
    column of probabilities (1 / members, say), logit(pi) takes the place of the intercept, which is then null.

    A round is one pass: the E step gives each SNP its responsibility, and sums of these make the M step, one Newton step
    on the observed information, or on the expected one (EM) where that is not positive definite; a step that lowers the
    likelihood is halved. Only the sums and the state (a row a key) leave the pass, and states are written tables.

    weights: keys, intercept, `names`, log_likelihood (less the penalty), n_rounds, converged. history: keys, round, log_likelihood, step, point (the array of intercept and weights).
    SNPs whose log_bf, or pi, is null or not finite (pi not between 0 and 1) are left out, unknown annotations are 0, keys
    may be null. Without SNPs there are no rows. With squash the weights are given as 1 / (1 + exp(-weight)).
    """
    k = len(names) + (pi is None)
    groups = [f"g{i}" for i in range(len(keys))] or ["g0"]
    finite = F.col("log_bf").isNotNull() & (F.abs(F.col("log_bf")) < float("inf"))
    offset = F.lit(0.0) if pi is None else F.ln(F.col(pi)) - F.ln(1 - F.col(pi))
    cols = ([F.lit(1.0)] if pi is None else []) + [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names]
    # keys of a group are kept as one text apart from themselves, so that null joins null
    own = [F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) for c in keys] or [F.lit("all")]
    table = snps.where(finite if pi is None else finite & F.col(pi).between(1e-300, 1 - 1e-16))
    table = stored(table.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)), *(g.alias(n) for g, n in zip(own, groups, strict=True)), F.col("log_bf").cast("double").alias("log_bf"),
                                offset.alias("offset"), *(c.alias(f"x{j}") for j, c in enumerate(cols))), "snps")
    first = np.zeros(k)
    if pi is None:
        first[0] = np.log(start / (1 - start))
    zero, begin = F.array(*[F.lit(0.0)] * k), F.array(*(F.lit(float(v)) for v in first))
    named = table.groupBy(*groups).agg(F.count("*").alias("m"), *(F.first(f"k{i}").alias(f"k{i}") for i in range(len(keys))))
    state = stored(named.select(*groups, *(f"k{i}" for i in range(len(keys))), begin.alias("theta"), begin.alias("base"), F.lit(float("-inf")).alias("base_ll"), zero.alias("delta"), F.lit(1.0).alias("size"),
                                F.lit("").alias("step"), F.lit(False).alias("done"), F.lit(0).alias("n")), "state")
    penalty = np.array(([0.0] if pi is None else []) + [ridge] * len(names))
    fields, kinds = state.columns, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema.fields)

    def advance(batches):
        for b in batches:
            if len(b):
                yield next_step(b, penalty, tol, bound)[fields]

    every, left = None, state.count()
    for _ in range(rounds):
        state = stored(_sums(table, k, groups, state, left <= max_broadcast).mapInPandas(advance, kinds), "state")
        every = state if every is None else every.unionByName(state)
        state = state.where("not done")
        left = state.count()
        if not left:
            break
    back = [F.col(f"k{i}").alias(c) for i, c in enumerate(keys)]
    last = every.groupBy(*groups).agg(F.max_by(F.struct(*(c for c in every.columns if c not in groups)), "n").alias("s")).select("s.*")
    weight = lambda j: 1 / (1 + F.exp(-F.col("base")[j])) if squash else F.col("base")[j]
    shift = int(pi is None)
    intercept = F.col("base")[0] if shift else F.lit(None).cast("double")
    weights = last.select(*back, intercept.alias("intercept"), *(weight(j + shift).alias(c) for j, c in enumerate(names)), F.col("base_ll").alias("log_likelihood"), F.col("n").alias("n_rounds"), F.col("done").alias("converged"))
    return weights, every.select(*back, F.col("n").alias("round"), F.col("base_ll").alias("log_likelihood"), "step", F.col("base").alias("point"))
