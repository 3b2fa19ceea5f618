"""Linkage disequilibrium between pairs of sites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tables import stored
from . import shared
from .shared import SharedPanel
from .tiles import block_pairs, tile_pairs

WORD = 63


def pack_genotypes(geno: DataFrame, n_samples: int) -> DataFrame:
    """Calls (rsid, chrom, pos, sample_id from 0 to n_samples - 1, dosage 0 to 2) -> one row a site: rsid, chrom, pos and
    m0, m1, m2: for each dosage the samples that have it, as bits of an array of integers. A missing call is in none."""
    words = max(1, -(-n_samples // WORD))
    bit = F.expr(f"shiftleft(1L, cast(sample_id % {WORD} as int))")
    masks = [F.bit_or(F.when(F.col("dosage") == d, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"m{d}") for d in range(3)]
    by_word = geno.groupBy("rsid", "chrom", "pos", F.expr(f"cast(floor(sample_id / {WORD}) as int)").alias("w")).agg(*masks)
    at = by_word.groupBy("rsid", "chrom", "pos").agg(F.map_from_entries(F.collect_list(F.struct("w", F.struct("m0", "m1", "m2")))).alias("m"))
    dense = lambda d: F.expr(f"transform(sequence(0, {words - 1}), w -> coalesce(try_element_at(m, w).m{d}, 0L))").alias(f"m{d}")
    return at.select("rsid", "chrom", "pos", *[dense(d) for d in range(3)])


def genotype_pair_counts(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs with packed sites in struct columns a and b -> adds n00 .. n22, the samples with each pair of dosages."""
    both = "cast(aggregate(zip_with({a}.m{i}, {b}.m{j}, (x, y) -> bit_count(x & y)), 0, (s, n) -> s + n) as int)"
    return pairs.withColumns({f"n{i}{j}": F.expr(both.format(a=a, b=b, i=i, j=j)) for i in range(3) for j in range(3)})


def _haplotypes() -> tuple[Column, ...]:
    n = {f"{i}{j}": F.col(f"n{i}{j}") for i in range(3) for j in range(3)}
    return (2 * n["22"] + n["12"] + n["21"], 2 * n["00"] + n["10"] + n["01"], 2 * n["20"] + n["10"] + n["21"], 2 * n["02"] + n["12"] + n["01"])


def ld_stats(counts: DataFrame, rounds: int = 100, least_r2: float | None = None) -> DataFrame:
    """Pair counts n00 .. n22 -> adds n (haplotypes), r2, d_prime and r; with least_r2 only pairs of that r2 or more.

    theta, the share of double heterozygotes in opposite phase, is estimated by expectation maximisation from 0.5 until
    it moves by at most 1e-4. r2 and d_prime come from D and are capped at 1; r is Pearson's of the dosages, in -1 .. 1,
    null for a site without variation. Pairs without a shared sample have nulls.
    """
    ab_, xx, ax, xb = _haplotypes()
    base = counts.withColumns({"_ab": ab_.cast("double"), "_xx": xx.cast("double"), "_ax": ax.cast("double"), "_xb": xb.cast("double")})
    base = base.withColumns({"n": F.expr("cast(_ab + _xx + _ax + _xb + 2 * n11 as int)"), "_h": F.col("n11").cast("double")})
    step = ("aggregate(sequence(1, {k}), named_struct('t', 0.5D, 'p', 2.0D), (s, i) -> if(abs(s.t - s.p) <= 1e-4D, s, named_struct('t', "
            "coalesce(try_divide((_ax + s.t * _h) * (_xb + s.t * _h), (_ab + (1 - s.t) * _h) * (_xx + (1 - s.t) * _h) + (_ax + s.t * _h) * (_xb + s.t * _h)), 0.5D), 'p', s.t)))")
    # A filter on r2 after the fact would be pushed below these columns and evaluate them all twice: a generator is not.
    theta = base.withColumn("_t", F.expr(f"if(n11 = 0, 0.5D, ({step.format(k=rounds)}).t)"))
    sums = ("named_struct('t', _t, 'sa', 2 * (n20 + n21 + n22) + n10 + n11 + n12, 'sb', 2 * (n02 + n12 + n22) + n01 + n11 + n21, 'qa', 4 * (n20 + n21 + n22) + n10 + n11 + n12, "
            "'qb', 4 * (n02 + n12 + n22) + n01 + n11 + n21, 'p', 4 * n22 + 2 * (n12 + n21) + n11)")
    # each step is bound to a name in a one-element array, so that what several formulas use is computed once a row
    freq = "named_struct('d', try_divide(_ab + (1 - s.t) * _h, n) - try_divide(s.sa, n) * try_divide(s.sb, n), 'fa', try_divide(s.sa, n), 'fb', try_divide(s.sb, n), 's', s)"
    most = "named_struct('f', f, 'v', f.fa * f.fb * (1 - f.fa) * (1 - f.fb), 'm', if(f.d < 0, -least(f.fa * f.fb, (1 - f.fa) * (1 - f.fb)), least(f.fa * (1 - f.fb), (1 - f.fa) * f.fb)))"
    out = ("named_struct('r2', if(n < 1, null, if(g.v > 0, least(1.0D, g.f.d * g.f.d / g.v), 0.0D)), 'd_prime', if(n < 1, null, least(1.0D, coalesce(try_divide(g.f.d, g.m), 0.0D))), "
           "'r', try_divide(n / 2 * g.f.s.p - g.f.s.sa * g.f.s.sb, sqrt((n / 2 * g.f.s.qa - g.f.s.sa * g.f.s.sa) * (n / 2 * g.f.s.qb - g.f.s.sb * g.f.s.sb))))")
    one = f"transform(transform(transform(array({sums}), s -> {freq}), f -> {most}), g -> {out})"
    keep = "" if least_r2 is None else f" o.r2 >= {least_r2}D"
    found = theta.withColumn("_o", F.expr(f"explode(filter({one}, o -> {keep}))") if keep else F.expr(f"{one}[0]"))
    done = found.withColumns({"r2": F.col("_o.r2"), "d_prime": F.col("_o.d_prime"), "r": F.expr("if(_o.r is null, null, greatest(-1.0D, least(1.0D, _o.r)))")})
    return done.drop(*[c for c in done.columns if c.startswith("_")])


def prune_weak(stats: DataFrame, least_haplotypes: int = 40, r2: float = 0.05) -> DataFrame:
    return stats.where((F.col("n") >= least_haplotypes) & (F.col("r2") >= r2))


def _site(alias: str) -> Column:
    return F.struct("rsid", "chrom", "pos", "m0", "m1", "m2").alias(alias)


def band_pairs(leads: DataFrame, packed: DataFrame, reach: int) -> DataFrame:
    """Each lead (rsid) with each packed site at most `reach` bases away, as structs a and b.

    Sites lie in bins of `reach` bases. The leads, the smaller side, are repeated for three bins."""
    a = packed.join(leads.select("rsid").distinct(), "rsid", "left_semi")
    a = a.select("chrom", _site("a"), F.explode(F.expr(f"sequence(floor(pos / {reach}) - 1, floor(pos / {reach}) + 1)")).alias("bin"))
    b = packed.select("chrom", _site("b"), F.expr(f"floor(pos / {reach})").alias("bin"))
    return a.join(b, ["chrom", "bin"]).where(F.abs(F.col("a.pos") - F.col("b.pos")) <= reach).select("a", "b")


def near_pairs(leads: DataFrame, packed: DataFrame | SharedPanel, reach: int, least_r2: float | None = None) -> DataFrame:
    """tiles.tile_pairs, or the same rows from a panel of few kinds of calls."""
    if isinstance(packed, SharedPanel) and packed.few:
        return shared.near_pairs(leads, packed, reach, least_r2)
    return tile_pairs(leads, _unshared(packed), reach, least_r2)


def _unshared(packed: DataFrame | SharedPanel) -> DataFrame:
    return packed.packed() if isinstance(packed, SharedPanel) else packed


def ld_window(leads: DataFrame, packed: DataFrame | SharedPanel, window: int = 500_000, r2: float = 0.7) -> DataFrame:
    """lead, rsid, chrom, pos, r2: the sites within window / 2 of each lead (rsid, chrom, pos) with r2 or more to it.

    A lead is always in its own set, with r2 1, also if the panel lacks it."""
    near = near_pairs(leads, packed, window // 2, r2).select("lead", "rsid", "chrom", "pos", "r2")
    own = leads.select(F.col("rsid").alias("lead"), "rsid", "chrom", "pos", F.lit(1.0).alias("r2")).distinct()
    return near.unionByName(own)


def pairwise_ld(members: DataFrame, packed: DataFrame | SharedPanel, block: int = 256) -> DataFrame:
    """cluster_id, rsid_a, rsid_b (a < b, or equal with r = r2 = 1), r2, d_prime, r; members off the panel are left out.

    A cluster's members are dealt into blocks of about `block`, and each pair of blocks meets under a key of its own."""
    few, one = isinstance(packed, SharedPanel) and packed.few, F.lit(1.0)
    own = members.select("cluster_id", "rsid").distinct()
    site = own.join(packed.sites.select("rsid") if few else _unshared(packed).select("rsid", "m0", "m1", "m2"), "rsid")
    same = site.select("cluster_id", F.col("rsid").alias("rsid_a"), F.col("rsid").alias("rsid_b"), one.alias("r2"), one.alias("d_prime"), one.alias("r"))
    return (shared.cluster_pairs(own, packed) if few else block_pairs(site, block)).unionByName(same)


def ld_to_top(members: DataFrame, top: DataFrame, packed: DataFrame | SharedPanel, metric: str = "r2", reach: int = 500_000) -> DataFrame:
    """cluster_id, rsid, ld: of each member to its cluster's top SNP (top: cluster_id, rsid); 1 for itself and where the
    panel lacks the top, 0 where it lacks the member.

    Members within `reach` of their top are scored by tiles, as wide as the furthest of them needs; only pairs further
    apart, or of two chromosomes, are joined with the calls of both."""
    t = top.select("cluster_id", F.col("rsid").alias("top"))
    m = members.select("cluster_id", "rsid").distinct().join(t, "cluster_id")
    if isinstance(packed, SharedPanel) and packed.few:
        return shared.to_top(m, packed, metric)
    packed = _unshared(packed)
    at = lambda name, p: packed.select(F.col("rsid").alias(name), F.struct("chrom", "pos").alias(p))
    placed = stored(m.join(at("rsid", "b"), "rsid", "left").join(at("top", "a"), "top", "left").withColumn(
        "far", F.expr(f"if(rsid = top or a is null or b is null, null, if(a.chrom = b.chrom, abs(a.pos - b.pos), {reach} + 1))")), "placed")
    plain = placed.where("far is null").select("cluster_id", "rsid", F.expr("if(rsid = top or a is null, 1.0D, 0.0D)").alias("ld"))
    most = placed.agg(F.max(F.expr(f"if(far <= {reach}, far, null)")), F.count(F.expr(f"if(far > {reach}, 1, null)"))).first()
    parts = [plain]
    if most[0] is not None:
        near = tile_pairs(t.select(F.col("top").alias("rsid")), packed, max(1, int(most[0])))
        near = near.select(F.col("lead").alias("top"), "rsid", F.struct("chrom", "pos").alias("b"), metric)
        # the place of the top is not given back: of a top with several places each pair is met as often as it is scored
        wanted = placed.where(f"far <= {reach}").select("cluster_id", "top", "rsid", "b").distinct()
        parts.append(wanted.join(near, ["top", "rsid", "b"]).select("cluster_id", "rsid", F.coalesce(metric, F.lit(0.0)).alias("ld")))
    if most[1]:
        pairs = placed.where(f"far > {reach}").select("cluster_id", "rsid", "top", F.col("a").alias("place_a"), F.col("b").alias("place_b"))
        site = lambda name, p, alias: packed.select(F.col("rsid").alias(name), F.struct("chrom", "pos").alias(p), _site(alias))
        both = pairs.join(site("rsid", "place_b", "b"), ["rsid", "place_b"]).join(site("top", "place_a", "a"), ["top", "place_a"])
        parts.append(ld_stats(genotype_pair_counts(both)).select("cluster_id", "rsid", F.coalesce(metric, F.lit(0.0)).alias("ld")))
    return reduce(DataFrame.unionByName, parts)
