"""What must not grow with the square of the tables: panels of sites with the same calls, LD of members near their top."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from variantloom.operators import checks, finemap, ld, report, tiles
from variantloom.plans import base
from variantloom.sources import panel

SF = "/root/testdata/sf0.001"


def test_sites_with_the_same_calls_are_packed_once(spark, monkeypatch):
    plain, seen = panel.packed_panel, []

    def counted(lines):
        seen.append(lines.count())
        return plain(lines)

    monkeypatch.setattr(panel, "packed_panel", counted)
    got = {r.rsid: r for r in base.packed(spark, SF).collect()}
    assert len(seen) == 1 and seen[0] <= 69 < len(got)
    want = plain(base.vcf_lines(spark, SF)).select("rsid", "chrom", "pos", "m0", "m1", "m2").collect()
    assert len(want) == len(got) and all(got[r.rsid] == r for r in want)


def test_sites_with_the_same_calls_are_counted_once(monkeypatch):
    rng = np.random.default_rng(3)
    kinds = rng.integers(0, 3, (4, 130))
    masks = np.zeros((3, 40, 3), np.uint64)
    of = rng.integers(0, 4, 40)
    for i, k in enumerate(of):
        for s, dose in enumerate(kinds[k]):
            for m, bit in enumerate((dose == 1, dose == 2, True)):
                masks[m, i, s // 63] |= np.uint64(int(bit) << (s % 63))
    plain, sizes = tiles.pair_counts, []
    monkeypatch.setattr(tiles, "pair_counts", lambda a, b: sizes.append((a.shape[1], b.shape[1])) or plain(a, b))
    block = tiles.Block(np.array([f"rs{i}" for i in range(40)], object), np.arange(40), np.ones(40, bool), np.ones(40, bool), masks)
    every = np.arange(40)
    i, j, n, _ = tiles._scored(block, block, every, every, np.ones((40, 40), bool), None)
    assert sizes == [(4, 4)] and len(i) == 40 * 39
    want = plain(masks, masks)
    assert (n == want[:, :, i, j]).all()
    assert all((kinds[of[0]] == u).astype(int) @ (kinds[of[1]] == v).astype(int) == want[u, v, 0, 1] for u in range(3) for v in range(3))


@pytest.mark.parametrize("metric", ["r2", "d_prime"])
def test_ld_to_top_joins_calls_for_far_members_only(spark, monkeypatch, metric):
    rng = np.random.default_rng(5)
    sites = [(f"rs{k}", "1" if k < 30 else "2", 1000 * k, rng.integers(0, 3, 70).tolist()) for k in range(40)] + [("flat", "1", 500, [1] * 70)]
    calls = spark.createDataFrame([(r, c, p, s, d) for r, c, p, ds in sites for s, d in enumerate(ds)], "rsid string, chrom string, pos long, sample_id long, dosage int")
    packed = ld.pack_genotypes(calls, 70)
    members = [("a", f"rs{k}") for k in range(40)] + [("a", "flat"), ("a", "off"), ("a", "rs3"), ("b", "rs1"), ("b", "rs2"), ("c", "rs1"), ("d", "rs7")]
    m, t = spark.createDataFrame(members, "cluster_id string, rsid string"), spark.createDataFrame([("a", "rs0"), ("b", "gone"), ("c", "rs2")], "cluster_id string, rsid string")
    pairs = packed.select(F.struct("rsid", "chrom", "pos", "m0", "m1", "m2").alias("b")).crossJoin(packed.where("rsid in ('rs0', 'rs2')").select(F.struct("rsid", "chrom", "pos", "m0", "m1", "m2").alias("a")))
    full = {(r.top, r.rsid): r[metric] or 0.0 for r in ld.ld_stats(ld.genotype_pair_counts(pairs)).select(F.col("a.rsid").alias("top"), "b.rsid", metric).collect()}
    want = {("a", f"rs{k}"): full["rs0", f"rs{k}"] for k in range(1, 40)} | {("a", "rs0"): 1.0, ("a", "flat"): full["rs0", "flat"], ("a", "off"): 0.0, ("b", "rs1"): 1.0, ("b", "rs2"): 1.0, ("c", "rs1"): full["rs2", "rs1"]}
    plain, joined = ld.genotype_pair_counts, []
    monkeypatch.setattr(ld, "genotype_pair_counts", lambda df: joined.append(df.count()) or plain(df))
    for reach, far in ((500_000, 10), (9_000, 30)):
        joined.clear()
        rows = ld.ld_to_top(m, t, packed, metric, reach=reach).collect()
        assert len(rows) == len(want) and {(r.cluster_id, r.rsid): pytest.approx(r.ld) for r in rows} == want and joined == [far]


def test_colocalise_singles_like_all_rows(spark):
    """The same as with a row for each member from the start; extreme z scores too."""
    rng = np.random.default_rng(7)
    m = spark.createDataFrame([(c, f"{c}{k}", float(rng.normal()), 0.1) for c, size in (("a", 12), ("b", 5), ("c", 1)) for k in range(size)], "cluster_id string, rsid string, z double, beta double")
    rows = [(f"g{g}", t, f"{c}{k}", float(z)) for g in range(4) for t in "xy" for c in "ab" for k, z in ((g, 2.5 * g), (g + 1, -60.0 if t == "x" else 0.3)) if (g, t) != (3, "y")]
    index = spark.createDataFrame([*rows, ("g9", "x", "c0", 1.0), ("g9", "y", "b2", None), ("g9", "y", "off", 1.0)], "gene_id string, tissue string, rsid string, z double")
    gwas = finemap.posterior(finemap.configurations(m, None, 1000, 1))
    key = lambda r: (r.cluster_id, r.gene_id, r.tissue, tuple(r.snps))
    want = {key(r): r for r in finemap.colocalise(gwas, finemap.eqtl_configurations(m, index)).collect()}
    got = finemap.colocalise_singles(gwas, index).collect()
    assert len(got) == len(want) == 7 * 12 + 8 * 5 + 1
    for r in got:
        w = want[key(r)]
        assert (r.p1, r.p2, r.joint, r.clpp) == pytest.approx((w.p1, w.p2, w.joint, w.clpp))
    assert finemap.colocalise_singles(gwas, index.limit(0)).collect() == []


def test_best_tissue_sorts_a_row_a_tissue(spark):
    rows = spark.createDataFrame([("g", "c", f"rs{k}", t, x) for k in range(50) for t, x in (("AF", 0.25), ("NO", 0.25), ("RO", 0.125))], "gene_id string, cluster string, rsid string, tissue string, clpp_cluster double")
    best = report.best_tissue(rows)
    assert [tuple(r) for r in best.collect()] == [("g", "c", "NO", 0.25)]
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2  # the rows of a tissue become one before they are sorted


def test_checks_count_rows_that_stand_for_several(spark):
    rows = spark.createDataFrame([("x1", "99", 3), ("ENSG1", "1", 5), ("x0", "99", 4)], "gene string, chrom string, n long")
    bad = {"gene": checks.matches("gene", checks.GENE_ID)}
    assert tuple(checks.run_checks(rows, bad, "n").first())[1:] == (7, "x0") and tuple(checks.run_checks(rows, bad).first())[1:] == (2, "x0")
    assert tuple(checks.run_checks(rows.limit(0), bad, "n").first())[1:] == (0, None)
    assert [tuple(r) for r in checks.invalid_values(rows, "chrom", count="n").collect()] == [("99", 7)]
    assert [tuple(r) for r in checks.invalid_values(rows, "chrom").collect()] == [("99", 2)]
