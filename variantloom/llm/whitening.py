"""Whitening of embeddings: leading components of the covariance by spectrum slicing."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import stored
from .vectors import as_long, exact_sum, integers, matrix, totals

EPS = np.finfo(float).eps
BASE = 1_000_000


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of T = Q' V Q, by Householder reflections. V - s I and T - s I have the same inertia."""
    a = v.copy()
    for i in range(len(a) - 2):
        x = a[i + 1 :, i].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(x)
        if length == 0:
            continue
        u = x / length
        p = 2 * (a[i + 1 :, i + 1 :] @ u)
        p -= (p @ u) * u
        a[i + 1 :, i + 1 :] -= np.outer(p, u) + np.outer(u, p)
        a[i + 1 :, i] -= 2 * u * (u @ a[i + 1 :, i])
    return a.diagonal().copy(), a.diagonal(-1).copy()


def counts(t: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """For each shift s how many eigenvalues of T are s or more: the pivots of T - s I = L D L' that are not negative, by
    the law of inertia. A pivot next to zero is taken as a small negative one."""
    diagonal, off = t
    tiny = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0)))
    pivot = diagonal[0] - shifts
    out = np.zeros(len(shifts), np.int64)
    for i in range(len(diagonal)):
        if i:
            pivot = diagonal[i] - shifts - off[i - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        out += pivot >= 0
    return out


def isolate(t: tuple[np.ndarray, np.ndarray], radius: float, apart: float) -> list[tuple[float, float, int, int]]:
    """Slices (low, high, first, last) of the spectrum, in falling order: the eigenvalues number first to last are in
    [low, high), no others are. All slices are halved at once and counted, until each holds one eigenvalue and is 16 times
    as far from its neighbours as it is wide, or is no wider than `apart` (it can then hold several)."""
    low, high = np.array([-radius]), np.array([radius])
    first, last = np.array([1]), np.array([len(t[0])])
    while True:
        gap = np.r_[np.inf, low[:-1] - high[1:], np.inf]
        near = np.minimum(gap[:-1], gap[1:])
        done = ((first == last) & (near >= 16 * (high - low))) | (high - low <= apart)
        if done.all():
            return list(zip(low.tolist(), high.tolist(), first.tolist(), last.tolist(), strict=True))
        middle = (low + high) / 2
        above = np.where(done, last, np.clip(counts(t, middle), first - 1, last))
        upper = [high, np.where(done, low, middle), first, above]
        lower = [middle, low, above + 1, last]
        both = np.array([np.column_stack(x).ravel() for x in zip(upper, lower, strict=True)])
        high, low, first, last = both[:, both[2] <= both[3]]
        first, last = first.astype(np.int64), last.astype(np.int64)


def rayleigh(v: np.ndarray, low: float, high: float, others: np.ndarray, seed: int) -> tuple[float, np.ndarray]:
    """The eigenpair of v in [low, high), with a vector orthogonal to the columns of `others`. Inverse iteration at the middle
    of the slice leads to it; from there the Rayleigh quotient is the shift, which converges cubically. As long as the
    quotient is outside the slice the middle stays the shift."""
    d, norm = len(v), np.abs(v).sum(1).max()
    best, x = (np.inf, 0.0, np.zeros(d)), np.random.default_rng(seed).standard_normal(d)
    shift, close = (low + high) / 2, False
    for _ in range(40):
        for _ in range(2):
            x = x - others @ (others.T @ x)
        x /= np.linalg.norm(x)
        rho = float(x @ v @ x)
        residual = float(np.linalg.norm(v @ x - rho * x))
        inside = low <= rho < high
        if inside and residual < best[0]:
            best = residual, rho, x
        if inside and residual <= d**0.5 * EPS * norm:
            break
        close = inside and residual <= high - low
        shift = rho if close else (low + high) / 2
        try:
            y = np.linalg.solve(v - shift * np.eye(d), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (shift + 2 * EPS * norm) * np.eye(d), x)
        x = y / np.abs(y).max()
    return best[1], best[2]


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the `most` largest eigenvalues of a covariance that are positive beyond
    rounding, by falling value; the largest entry of a vector is positive. Counts certify their numbers: from just below
    eigenvalue k on there are at least k, from just above on fewer than k. An error if they don't."""
    d, norm = len(v), float(np.abs(v).sum(1).max(initial=0))
    if norm == 0:
        return np.zeros(0), np.zeros((d, 0))
    slack = 16 * d * EPS * norm
    t = tridiagonal(v)
    values, vectors = [], np.zeros((d, 0))
    for low, high, first, last in isolate(t, norm * (1 + 16 * d * EPS), slack / 4):
        if first > most or high <= slack:
            break
        group = np.zeros((d, 0))
        for k in range(first, last + 1):
            _, x = rayleigh(v, low - slack, high + slack, np.column_stack([vectors, group]), k)
            group = np.column_stack([group, x])
        inner, turn = np.linalg.eigh(group.T @ v @ group)  # of one number, but for eigenvalues that no shift tells apart
        values, vectors = values + inner[::-1].tolist(), np.column_stack([vectors, group @ turn[:, ::-1]])
    k = min(most, sum(e > slack for e in values))
    found = np.array(values[:k])
    if not ((counts(t, found + slack) < np.arange(1, k + 1)) & (counts(t, found - slack) >= np.arange(1, k + 1))).all():
        raise ArithmeticError("the counts do not certify the numbers of the eigenvalues")
    picked = vectors[:, :k]
    return found, picked * np.sign(picked[np.abs(picked).argmax(0), np.arange(k)])


class Whitening(NamedTuple):
    """n vectors, the integer shift m and the exact sums s of x - m, eigenvalues, eigenvectors and the trace of V."""

    n: int
    m: np.ndarray
    s: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact: 64-bit integers where those hold it, Python's otherwise."""
    d = x - model.m
    s = np.array(model.s, dtype=object)
    if max(int(np.abs(d).max(initial=0)) * model.n, *(abs(v) for v in model.s), 0) < 1 << 62:
        return d * np.int64(model.n) - s.astype(np.int64)
    return d.astype(object) * model.n - s


def products(d: np.ndarray) -> np.ndarray:
    """D' D of integers, exact: in parts that 53 bits hold, or by Python's integers."""
    most = int(np.abs(d).max(initial=0))
    rows = (1 << 53) // max(most * most, 1)
    if not rows:
        return d.astype(object).T @ d.astype(object)
    total = np.zeros((d.shape[1],) * 2, dtype=object)
    for i in range(0, len(d), rows):
        part = d[i : i + rows].astype(float)
        total = total + (part.T @ part).astype(np.int64)
    return total


def fit_whitening(x: DataFrame, d: int, components: int = 32) -> Whitening | None:
    """The model of all rows of (x array<long> of length d); None without rows. Two passes, the sums and the products of
    centred integers, so that n^2 V is an exact integer matrix, rounded once. The driver holds matrices of d rows."""
    *sums, n = totals(x.select("x"), d + 1, lambda b: np.r_[exact_sum(matrix(b)), len(b)]).tolist()
    if not n:
        return None
    m = np.array([(2 * v + n) // (2 * n) for v in sums], np.int64)
    s = [v - n * c for v, c in zip(sums, m.tolist(), strict=True)]
    half = np.triu_indices(d)
    found = totals(x.select("x"), len(half[0]), lambda b: products(matrix(b) - m)[half])
    exact = [c * n - s[i] * s[j] for c, i, j in zip(found.tolist(), *half, strict=True)]
    v = np.zeros((d, d))
    v[half] = v.T[half] = [c / (n * n) for c in exact]
    values, vectors = leading(v, components)
    trace = sum(c for c, i, j in zip(exact, *half, strict=True) if i == j) / (n * n)
    return Whitening(n, m, s, values, vectors, trace)


def whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (centred(x, model).astype(float) / model.n) @ model.vectors / np.sqrt(model.values)


def identity_error(x: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened rows minus the identity, measured on all rows."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            if len(b):
                w = whitened(matrix(b), model)
                first, second = first + w.sum(0), second + w.T @ w
        flat = np.r_[first, second.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["at", "v"])

    got = np.zeros(k + k * k)
    for r in x.select("x").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        got[r.at] = r.v / model.n
    cov = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
    return float(np.abs(cov - np.eye(k)).max(initial=0))


def whiten(embeddings: DataFrame, components: int = 32) -> DataFrame:
    """(vec_id, embedding) -> vec_id, component (from 1, by falling eigenvalue), n, deviation (sum of (n x - S)^2 over the
    dimensions, exact; null if beyond 64 bits), whitened, explained, identity_error; a row per vector and component.

    x is floor(64 * entry) + 1000000. All vectors that are left by `vectors.integers` are the fit list. If they differ in
    length, those of the most common length (of equal ones the longest) are, and the others are dropped. Components whose
    eigenvalue is zero to rounding can't be scaled and are left out: none for one vector or equal ones. An empty table
    gives no rows. Repeated rows and ids, null ids and other columns change nothing: each row is a vector.
    """
    x = integers(embeddings)
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not lengths:
        return embeddings.sparkSession.createDataFrame([], schema)
    x = stored(x.where(F.size("x") == lengths[0].d).select("vec_id", F.transform("x", lambda c: c + BASE).alias("x")), "vectors")
    model = fit_whitening(x, lengths[0].d, components)
    error, k = identity_error(x, model), len(model.values)
    share = model.values / model.trace if k else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = len(b)
            if not rows or not k:
                continue
            c = matrix(b)
            off = centred(c, model)
            if off.dtype != object and int(np.abs(off).max(initial=0)) ** 2 * off.shape[1] >= 1 << 63:
                off = off.astype(object)
            ids = b.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k)))
            far = as_long((off * off).sum(1)).take(pa.array(np.repeat(np.arange(rows), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n)), far, pa.array(whitened(c, model).ravel()),
                 pa.array(np.tile(share, rows)), pa.array(np.full(rows * k, error))], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, schema)
