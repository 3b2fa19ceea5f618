"""Centroid clustering in exact integers; an n-simplex projection tells which centroids need a look."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import stored
from .vectors import as_long, exact_sum, integers, matrix, totals

#: Differences below this give sums of squares that 64 bits hold, for up to 2048 dimensions.
SAFE = 1 << 26


def _cluster_sql(k: int = 16, rounds: int = 3, seed: int = 1) -> str:
    """The rows of op13 in SQL: a row per vector and dimension, all centres compared."""
    nearest = """a{r} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, (s, c)) AS c, min(s) AS s
  FROM (SELECT vec_id, c{p}.c, sum((v.x - c{p}.x) * (v.x - c{p}.x)) AS s FROM v JOIN c{p} USING (dim) GROUP BY vec_id, c{p}.c) GROUP BY vec_id)"""
    moved = """c{r} AS MATERIALIZED (
  SELECT c{p}.c, dim, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c{p}.x) AS x
  FROM c{p} LEFT JOIN (SELECT c, dim, sum(x) AS s, count(*) AS n FROM v JOIN a{r} USING (vec_id) GROUP BY c, dim) m USING (c, dim))"""
    steps = [x.format(r=r, p=r - 1) for r in range(1, rounds + 1) for x in (nearest, moved)] + [nearest.format(r=rounds + 1, p=rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS dim, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, dim, x FROM v JOIN first USING (vec_id)),
{", ".join(steps)},
name AS (SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(s AS BIGINT) AS distance, CAST(sum(s) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(s) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds + 1} JOIN name USING (c)"""


CLUSTER_SQL = _cluster_sql()


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of a to rows of b (of equal shape, or one row), exact."""
    d = a - b
    if int(np.abs(d).max(initial=0)) >= SAFE:
        d = d.astype(object)
    return (d * d).sum(1)


class Simplex(NamedTuple):
    """Pivots, and their own coordinates: pivot i has zeros from place i on. With the first pivot at the origin, the
    coordinates of a point at given distances from all pivots follow one by one, as the inner product with a pivot is
    half of |point|^2 + |pivot|^2 - their distance^2."""

    pivots: np.ndarray
    corner: np.ndarray


def choose_pivots(points: np.ndarray, most: int, flat: float = 0.1) -> Simplex:
    """Up to `most` of the points as pivots: each the one with the greatest height over the simplex so far. Points that
    rise less than `flat` of the largest distance above it are not taken: they would make the coordinates unsure."""
    first = points[:1]
    base = (points - first).astype(float)
    taken, axes, size = [0], np.zeros((0, points.shape[1])), np.sqrt((base**2).sum(1).max(initial=0))
    while len(taken) < min(most, len(points)):
        rest = base - base @ axes.T @ axes
        height = np.sqrt((rest**2).sum(1))
        k = int(height.argmax())
        if height[k] <= flat * size or not size:
            break
        taken.append(k)
        axes = np.vstack([axes, rest[k] / height[k]])
    return Simplex(points[taken], base[taken] @ axes.T)


def apexes(distances: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Squared distances to the pivots (a row a point) -> apex coordinates: one a pivot, the last the height over the
    simplex of the pivots, which is not negative."""
    corner, n = simplex.corner, distances.shape[1]
    out = np.zeros((len(distances), n))
    own = distances[:, 0].astype(float)
    for i in range(1, n):
        inner = (own + (corner[i] ** 2).sum() - distances[:, i]) / 2
        out[:, i - 1] = (inner - out[:, : i - 1] @ corner[i, : i - 1]) / corner[i, i - 1]
    out[:, -1] = np.sqrt(np.maximum(own - (out[:, :-1] ** 2).sum(1), 0))
    return out


def candidates(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(points, centres) apexes -> which centres may be nearest. Two apexes are as far apart as their points at least,
    when both heights are on one side; at most, with the heights on opposite sides. A centre whose least distance is
    above the smallest largest one of a point is out; the slack covers rounding, so that ties stay in."""
    flat = ((points[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(2)
    low = flat + (points[:, None, -1] - centres[None, :, -1]) ** 2
    high = flat + (points[:, None, -1] + centres[None, :, -1]) ** 2
    slack = 1e-6 * ((points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] + 1)
    return low - slack <= (high + slack).min(1, keepdims=True)


def assign(x: np.ndarray, apex: np.ndarray, centres: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, int]:
    """Vectors with their apexes -> number of the nearest centre (of equally near ones the smallest), squared distance, and
    how many exact distances that took."""
    to_pivots = np.column_stack([squares(centres, p[None, :]) for p in simplex.pivots])
    maybe = candidates(apex, apexes(to_pivots, simplex))
    best = np.zeros(len(x), np.int64)
    near = None
    for k in range(len(centres)):
        at = np.flatnonzero(maybe[:, k])
        if near is None:
            near = np.full(len(x), -1, dtype=object if int(np.abs(x).max(initial=0)) + int(np.abs(centres).max(initial=0)) >= SAFE else np.int64)
        if len(at):
            far = squares(x[at], centres[k][None, :])
            win = (near[at] < 0) | (far < near[at])
            best[at[win]], near[at[win]] = k, far[win]
    return best, near, int(maybe.sum())


def _first(x: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of "seed:vec_id" (a null id as empty text), by hash, then by vector."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r.x for r in x.select(key.alias("h"), "x").orderBy("h", "x").limit(k).collect()], np.int64)


def with_apexes(x: DataFrame, simplex: Simplex) -> DataFrame:
    """(vec_id, x) -> with apex: the distances to the pivots are computed once, and serve every round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                rows = matrix(b)
                apex = apexes(np.column_stack([squares(rows, p[None, :]) for p in simplex.pivots]), simplex)
                width = apex.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, apex.size + 1, width, dtype=np.int32)), pa.array(apex.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("x"), lists], ["vec_id", "x", "apex"])

    return x.mapInArrow(run, "vec_id long, x array<long>, apex array<double>")


def _moved(rows: DataFrame, centres: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centres after one round: floor(sum / count) of their vectors, exact; those without vectors stay."""
    k, d = centres.shape

    def sums(b: pa.RecordBatch) -> np.ndarray:
        x, out = matrix(b), np.zeros((k, d + 1), dtype=object)
        best, _, _ = assign(x, matrix(b, "apex"), centres, simplex)
        for c in np.unique(best):
            own = x[best == c]
            out[c] = np.r_[exact_sum(own), len(own)]
        return out.ravel()

    found = totals(rows, k * (d + 1), sums).reshape(k, d + 1).tolist()
    return np.array([[v // n for v in s] if n else old for (*s, n), old in zip(found, centres.tolist(), strict=True)], np.int64)


def cluster(embeddings: DataFrame, k: int = 16, rounds: int = 3, dimensions: int = 64, pivots: int = 8, seed: int = 1) -> DataFrame:
    """(vec_id, embedding) -> vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256; one row per
    vector of `dimensions` entries that are neither null nor non-finite (see vectors.integers), others are dropped.

    Vectors are integers floor(64 * entry). The first centres are the k vectors that a hash of seed and vec_id puts first
    (all of them if there are fewer; vectors of one id by their entries). Each round assigns every vector to the nearest
    centre, the smaller number winning ties, and moves every centre that has vectors to the floor of their mean. Repeated
    rows count each. Null ids hash as an empty text. A distance or sum beyond 64 bits is null. An empty table gives no
    rows; other columns are ignored. Two equal first centres are both kept: the second stays empty.

    Distances to `pivots` pivots, chosen among the first centres, are computed once and become apex coordinates; in every
    round these rule out most centres, and exact distances to the others decide.
    """
    x = integers(embeddings).where(F.size("x") == dimensions)
    first = _first(x, k, seed)
    schema = "vec_id long, cluster int, distance long"
    if not len(first):
        return embeddings.sparkSession.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    simplex = choose_pivots(first, pivots)
    rows = stored(with_apexes(x, simplex), "apexes")
    centres = first
    for _ in range(rounds):
        centres = _moved(rows, centres, simplex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                best, near, _ = assign(matrix(b), matrix(b, "apex"), centres, simplex)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(best.astype(np.int32)), as_long(near)], ["vec_id", "cluster", "distance"])

    found = stored(rows.mapInArrow(run, schema), "assigned")
    spark = embeddings.sparkSession
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    fits = lambda v: v if v is not None and v < 1 << 63 else None
    total = fits(sum(int(r.s or 0) for r in sums))
    names = spark.createDataFrame([(r.cluster, fits(int(r.s or 0)), total, ",".join(map(str, centres[r.cluster].tolist()))) for r in sums], "cluster int, cluster_inertia long, inertia long, centroid string")
    return found.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"))
