"""Linkage disequilibrium by tiles: stretches of a chromosome as bit matrices, counted and scored in whole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sites of a block: a block by a block of counts fits the cache.
BLOCK = 192
COUNTS = [f"n{i}{j}" for i in range(3) for j in range(3)]
STATS = ["n", "r2", "d_prime", "r"]
SCHEMA = f"lead string, rsid string, chrom string, pos bigint, {', '.join(f'{c} int' for c in COUNTS)}, n int, r2 double, d_prime double, r double"


class Block(NamedTuple):
    """Sites in order of position: names, positions, whether they are the first site of pairs here, whether they are leads,
    and masks (3, sites, words): heterozygous, two alternative alleles, called."""

    rsid: np.ndarray
    pos: np.ndarray
    own: np.ndarray
    lead: np.ndarray
    masks: np.ndarray


def masks_of(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    m = []
    for d in range(3):
        column = batch.column(f"m{d}")
        m.append(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
    return np.stack([m[1], m[2], m[0] | m[1] | m[2]]).view(np.uint64)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(rows of a, rows of b): samples in both masks, a word at a time over the whole block; many words at once where
    there are few rows."""
    out = np.zeros((len(a), len(b)), np.int32)
    if (few := len(a) * len(b)) <= 512:
        step = 2**16 // max(1, few)
        for w in range(0, a.shape[1], step):
            out += np.bitwise_count(a[:, None, w : w + step] & b[None, :, w : w + step]).sum(2, dtype=np.int32)
        return out
    for w in range(a.shape[1]):
        out += np.bitwise_count(a[:, w, None] & b[None, :, w])
    return out


def pair_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Masks of two blocks -> (3, 3, sites of a, sites of b): samples with i alternative alleles at one and j at the other.
    Where no call is missing, four products and the counts of the sites themselves give the other five."""
    het_a, alt_a, all_a = a
    het_b, alt_b, all_b = b
    n = np.zeros((3, 3, a.shape[1], b.shape[1]), np.int32)
    n[1, 1], n[1, 2], n[2, 1], n[2, 2] = _shared(het_a, het_b), _shared(het_a, alt_b), _shared(alt_a, het_b), _shared(alt_a, alt_b)
    if a.shape[1] and b.shape[1] and (all_a == all_a[:1]).all() and (all_b == all_a[:1]).all():
        of = lambda m: np.bitwise_count(m).sum(1, dtype=np.int32)
        rows, cols, both = (of(het_a)[:, None], of(alt_a)[:, None]), (of(het_b)[None, :], of(alt_b)[None, :]), of(all_a[:1])[0]
    else:
        rows, cols = (_shared(het_a, all_b), _shared(alt_a, all_b)), (_shared(all_a, het_b), _shared(all_a, alt_b))
        both = _shared(all_a, all_b)
    for i in (1, 2):
        n[i, 0] = rows[i - 1] - n[i, 1] - n[i, 2]
        n[0, i] = cols[i - 1] - n[1, i] - n[2, i]
    n[0, 0] = both - n.sum((0, 1))
    return n


def _kinds(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks (3, sites, words) -> a site of each kind of calls, and the kind of each site."""
    kind: dict[bytes, int] = {}
    of = np.array([kind.setdefault(masks[:, i].tobytes(), len(kind)) for i in range(masks.shape[1])], np.int64)
    return np.unique(of, return_index=True)[1], of


def scores(n: np.ndarray, rounds: int = 100) -> dict[str, np.ndarray]:
    """Pair counts (3, 3, pairs) -> n (haplotypes), r2, d_prime, r; the same values as ld.ld_stats, NaN for its nulls."""
    c = n.astype(float)
    same, none, first, second, het = 2 * c[2, 2] + c[1, 2] + c[2, 1], 2 * c[0, 0] + c[1, 0] + c[0, 1], 2 * c[2, 0] + c[1, 0] + c[2, 1], 2 * c[0, 2] + c[1, 2] + c[0, 1], c[1, 1]
    theta, at = np.full(c.shape[2], 0.5), np.flatnonzero(het)
    for _ in range(rounds):
        if not len(at):
            break
        t, h = theta[at], het[at]
        apart = (first[at] + t * h) * (second[at] + t * h)
        total = apart + (same[at] + (1 - t) * h) * (none[at] + (1 - t) * h)
        theta[at] = new = np.divide(apart, total, out=np.full(len(at), 0.5), where=total != 0)
        at = at[np.abs(new - t) > 1e-4]
    with np.errstate(divide="ignore", invalid="ignore"):
        haplotypes = same + none + first + second + 2 * het
        sa, sb = 2 * c[2].sum(0) + c[1].sum(0), 2 * c[:, 2].sum(0) + c[:, 1].sum(0)
        fa, fb = sa / haplotypes, sb / haplotypes
        d = (same + (1 - theta) * het) / haplotypes - fa * fb
        v = fa * fb * (1 - fa) * (1 - fb)
        r2 = np.where(v > 0, np.minimum(1, d * d / v), np.where(haplotypes > 0, 0.0, np.nan))
        most = np.where(d < 0, -np.minimum(fa * fb, (1 - fa) * (1 - fb)), np.minimum(fa * (1 - fb), (1 - fa) * fb))
        d_prime = np.where(haplotypes > 0, np.where(most != 0, np.minimum(1, d / most), 0.0), np.nan)
        half, product = haplotypes / 2, 4 * c[2, 2] + 2 * (c[1, 2] + c[2, 1]) + c[1, 1]
        spread = (half * (4 * c[2].sum(0) + c[1].sum(0)) - sa * sa) * (half * (4 * c[:, 2].sum(0) + c[:, 1].sum(0)) - sb * sb)
        r = np.where(spread > 0, np.clip((half * product - sa * sb) / np.sqrt(spread), -1, 1), np.nan)
    return {"n": haplotypes.astype(np.int32), "r2": r2, "d_prime": d_prime, "r": r}


def _scored(a: Block, b: Block, rows: np.ndarray, cols: np.ndarray, wanted: np.ndarray, least_r2: float | None) -> tuple | None:
    """Of the pairs rows x cols of two blocks the wanted ones -> their places in a and b, counts and scores."""
    if not wanted.any():
        return None
    x, y = a.masks[:, rows], b.masks[:, cols]
    (p, kind_a), (q, kind_b) = _kinds(x), _kinds(y)  # sites with the same calls are counted once
    n = pair_counts(x[:, p], y[:, q])
    i, j = np.nonzero(wanted)
    n, i, j = n[:, :, kind_a[i], kind_b[j]], rows[i], cols[j]
    found = scores(n)
    good = np.flatnonzero((a.rsid[i] != b.rsid[j]) & (found["r2"] >= least_r2 if least_r2 is not None else True))
    return i[good], j[good], n[:, :, good], {k: v[good] for k, v in found.items()}


def _between(a: Block, b: Block, reach: int, least_r2: float | None) -> Iterator[tuple]:
    """Pairs of an own site of a with a later site of b (of a itself, if it is b) that is at most `reach` away; at least one
    of them is a lead."""
    own = np.flatnonzero(a.own & (a.pos >= b.pos[0] - reach))
    for rows, cols in ((own[a.lead[own]], np.arange(len(b.pos))), (own[~a.lead[own]], np.flatnonzero(b.lead))):
        if len(rows) and len(cols):
            wanted = b.pos[None, cols] - a.pos[rows, None] <= reach
            if a is b:
                wanted &= cols[None, :] > rows[:, None]
            found = _scored(a, b, rows, cols, wanted, least_r2)
            if found is not None:
                yield found


def _rows(chrom: str, a: Block, b: Block, i: np.ndarray, j: np.ndarray, n: np.ndarray, found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Scored pairs as rows, under each end that is a lead."""
    for x, y, p, q, counts in ((a, b, i, j, n), (b, a, j, i, n.transpose(1, 0, 2))):
        at = np.flatnonzero(x.lead[p])
        if len(at):
            p, q = p[at], q[at]
            cols = [pa.array(x.rsid[p], pa.string()), pa.array(y.rsid[q], pa.string()), pa.array([chrom] * len(at), pa.string()), pa.array(y.pos[q])]
            cols += [pa.array(counts[u, v][at]) for u in range(3) for v in range(3)]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(found[s][at], from_pandas=True) for s in STATS], ["lead", "rsid", "chrom", "pos", *COUNTS, *STATS])


def _dealt(sites: DataFrame, lanes: DataFrame | None, width: int, reach: int) -> DataFrame:
    """Sites under the tile they lie in, and under the one before if they are within reach of it; in a crowded tile under
    each of its lanes, of which one has them as first sites of pairs."""
    x = sites.withColumn("x", F.explode(F.expr(
        f"filter(array(named_struct('tile', floor(pos / {width}), 'own', true), named_struct('tile', floor(pos / {width}) - 1, 'own', false)), s -> s.own or pmod(pos, {width}) < {reach})")))
    x = x.select("chrom", "x.tile", "x.own", "pos", "kind", "rsid", "m0", "m1", "m2")
    if lanes is None:
        return x.withColumn("lane", F.lit(0))
    x = x.join(F.broadcast(lanes), ["chrom", "tile"], "left").withColumn("lane", F.explode(F.expr("sequence(0, coalesce(lanes, 1) - 1)")))
    return x.withColumn("own", F.expr("own and pmod(xxhash64(rsid), coalesce(lanes, 1)) = lane")).drop("lanes")


def tile_pairs(leads: DataFrame, panel: DataFrame, reach: int, least_r2: float | None = None, most: int = 20_000) -> DataFrame:
    """Each lead (rsid) with each other site of the packed panel (rsid, chrom, pos, m0, m1, m2) at most `reach` bases away:
    lead, rsid, chrom, pos (of the site), n00 .. n22, n, r2, d_prime, r as in ld.ld_stats; with least_r2 only those pairs.

    A chromosome is cut into tiles of four times the reach. A tile is read in order of position; a block of sites meets
    itself and the blocks within reach before it, each pair once, and is given out under both ends where both are leads.
    Only sites within reach of the tile before (a quarter, spread evenly) are sent twice, and a task holds no more than
    the sites within reach. Tiles of over `most` sites are split into lanes: each lane pairs its share of the sites with
    all of the tile. Leads off the panel have no rows; a pair of sites with one rsid is left out.
    """
    width = 4 * reach
    panel = panel.select("rsid", "chrom", F.col("pos").cast("bigint").alias("pos"), "m0", "m1", "m2")
    crowds = panel.groupBy("chrom", F.expr(f"floor(pos / {width})").alias("tile")).agg(F.expr(f"cast(ceil(count(*) / {most}) as int)").alias("lanes")).where("lanes > 1")
    lanes = crowds if crowds.limit(1).count() else None  # one row per `most` sites at most
    # a lead is told by a row without masks, just before its site: its own row is too wide to be joined
    marks = panel.select("rsid", "chrom", "pos").join(leads.select("rsid").distinct(), "rsid", "left_semi")
    marks = marks.select("rsid", "chrom", "pos", *[F.lit(None).cast("array<bigint>").alias(f"m{d}") for d in range(3)], F.lit(0).alias("kind"))
    rows = _dealt(marks.unionByName(panel.withColumn("kind", F.lit(1))), lanes, width, reach)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, leading = None, [], set()
        for batch in batches:
            if not len(batch):
                continue
            keys = list(zip(batch.column("chrom").to_pylist(), batch.column("tile").to_pylist(), batch.column("lane").to_pylist(), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if keys[start] != key:
                    key, held, leading = keys[start], [], set()
                part = batch.slice(start, stop - start)
                mark = part.column("kind").to_numpy() == 0
                leading.update(part.column("rsid").filter(pa.array(mark)).to_pylist())
                sites = part.filter(pa.array(~mark))
                for at in range(0, len(sites), BLOCK):
                    s = sites.slice(at, BLOCK)
                    rsid = s.column("rsid").to_numpy(zero_copy_only=False)
                    b = Block(rsid, s.column("pos").to_numpy(), s.column("own").to_numpy(zero_copy_only=False), np.array([x in leading for x in rsid]), masks_of(s))
                    held = [a for a in held if a.pos[-1] >= b.pos[0] - reach]
                    for a in [*held, b]:
                        for found in _between(a, b, reach, least_r2):
                            yield from _rows(key[0], a, b, *found)
                    held.append(b)

    order = ["chrom", "tile", "lane"]
    parts = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number of its own, as the work is by pairs and not by bytes
    dealt = rows.select("chrom", "tile", "lane", "pos", "kind", "rsid", "own", "m0", "m1", "m2").repartition(parts, *order).sortWithinPartitions(*order, "pos", "kind", "rsid")
    return dealt.mapInArrow(run, SCHEMA)


def block_pairs(sites: DataFrame, block: int) -> DataFrame:
    """Sites of clusters (cluster_id, rsid, m0, m1, m2), once each -> cluster_id, rsid_a, rsid_b (a < b), r2, d_prime, r of
    all pairs of a cluster. Its sites are dealt into blocks of about `block`, and each pair of blocks is a key of its own."""
    count = sites.groupBy("cluster_id").agg(F.expr(f"cast(ceil(count(*) / {block}) as int)").alias("blocks"))
    x = sites.select("cluster_id", "rsid", "m0", "m1", "m2").join(count, "cluster_id").withColumn("own", F.expr("cast(pmod(xxhash64(rsid), blocks) as int)"))
    x = x.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    x = x.select("cluster_id", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), F.expr("own > other").alias("second"), "rsid", "m0", "m1", "m2")

    def done(key: tuple, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        rsid, second, masks = table.column("rsid").to_numpy(), table.column("second").to_numpy(), masks_of(table.to_batches()[0])
        block = Block(rsid, np.zeros(len(rsid), np.int64), ~second, ~second, masks)
        left, right = np.flatnonzero(~second), np.flatnonzero(second) if key[1] != key[2] else np.arange(len(rsid))
        for start in range(0, len(left), BLOCK):
            rows = left[start : start + BLOCK]
            wanted = np.ones((len(rows), len(right)), bool) if key[1] != key[2] else rsid[rows][:, None] < rsid[None, :]
            found = _scored(block, block, rows, right, wanted, None)
            if found is not None:
                i, j, _, got = found
                swap = rsid[i] > rsid[j]
                ends = [pa.array(np.where(swap, rsid[j], rsid[i]), pa.string()), pa.array(np.where(swap, rsid[i], rsid[j]), pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(i), pa.string()), *ends, *[pa.array(got[s], from_pandas=True) for s in ("r2", "d_prime", "r")]], ["cluster_id", "rsid_a", "rsid_b", "r2", "d_prime", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            if not len(batch):
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cluster_id", "lo", "hi")), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if keys[start] != key and parts:
                    yield from done(key, parts)
                    parts = []
                key = keys[start]
                parts.append(batch.slice(start, stop - start))
        if parts:
            yield from done(key, parts)

    order = ["cluster_id", "lo", "hi"]
    parts = int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return x.repartition(parts, *order).sortWithinPartitions(*order).mapInArrow(run, "cluster_id string, rsid_a string, rsid_b string, r2 double, d_prime double, r double")
