"""Operators on small tables worked out by hand: ties, nulls, empty input and values on each boundary."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from variantloom.functions import scoring
from variantloom.operators import alleles, checks, cluster, evidence, filters, finemap, graph, intervals, ld, output, prep, report
from variantloom.sources import readers


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_overlap_boundaries(spark):
    snps = spark.createDataFrame([("a", "1", 100), ("b", "1", 101), ("c", "1", 200), ("d", "1", 201), ("e", "2", 150), ("f", "1", 9999)], "rsid string, chrom string, pos long")
    bed = spark.createDataFrame([("1", 100, 200, "g"), ("1", 100, 200, "h"), ("1", 50, 50, "none"), ("1", 4000, 21000, "long")], "chrom string, bstart long, bend long, gene_id string")
    assert rows(intervals.overlap(snps, bed).select("rsid", "gene_id")) == [("b", "g"), ("b", "h"), ("c", "g"), ("c", "h"), ("f", "long")]
    assert rows(intervals.overlap(snps.limit(0), bed)) == []


def test_nearest_keeps_ties_and_is_strict(spark):
    snps = spark.createDataFrame([("a", "1", 1000), ("b", "1", 200_000), ("c", "X", 5)], "rsid string, chrom string, pos long")
    tss = spark.createDataFrame([("1", 900, "l"), ("1", 1100, "r"), ("1", 100_000, "edge"), ("1", 300_001, "far")], "chrom string, tss long, gene_id string")
    assert rows(intervals.nearest(snps, tss).select("rsid", "gene_id", "distance")) == [("a", "l", 100), ("a", "r", 100)]
    plan = intervals.nearest(snps, tss)._jdf.queryExecution().toString()
    assert "_bin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_range_joins_hash_on_bins(spark):
    snps = spark.range(10).select(F.col("id").cast("string").alias("rsid"), F.lit("1").alias("chrom"), F.col("id").alias("pos"))
    bed = spark.range(10).select(F.lit("1").alias("chrom"), F.col("id").alias("bstart"), (F.col("id") + 5).alias("bend"))
    for df in (intervals.overlap(snps, bed), cluster.overlapping(bed.select("chrom", F.col("bstart").alias("first"), F.col("bend").alias("last"), F.col("bstart").alias("cluster_id"), F.lit(0.1).alias("pvalue")))):
        plan = df._jdf.queryExecution().toString()
        assert "bin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_blacklist_is_half_open(spark):
    df = spark.createDataFrame([("a", "6", 28477796), ("b", "6", 28477797), ("c", "6", 33448354), ("d", "17", 44784488), ("d", "1", 5)], "cluster_id string, chrom string, pos long")
    assert {r[0] for r in rows(filters.drop_blacklisted(df))} == {"a", "c"}


def geno(spark, sites):
    return spark.createDataFrame([(s, "1", p, i, d) for s, p, ds in sites for i, d in enumerate(ds) if d is not None], "rsid string, chrom string, pos long, sample_id long, dosage int")


def test_ld_of_hand_made_sites(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, 130)
    sites = [("a", 100, x), ("b", 200, x), ("c", 300, 2 - x), ("d", 400, np.zeros(130, int)), ("e", 500, rng.integers(0, 3, 130)), ("far", 250_101, x), ("g", 250_100, [None] * 65 + x[65:].tolist())]
    packed = ld.pack_genotypes(geno(spark, [(s, p, [None if d is None else int(d) for d in ds]) for s, p, ds in sites]), 130)
    leads = spark.createDataFrame([("a", "1", 100, 1e-9), ("off", "2", 7, 1e-9)], "rsid string, chrom string, pos long, pvalue double")
    pairs = ld.ld_stats(ld.genotype_pair_counts(ld.band_pairs(leads, packed, 250_000)))
    got = {r["b"].rsid: r for r in pairs.collect()}
    assert set(got) == {"a", "b", "c", "d", "e", "g"} and got["g"].n == 130 and got["b"].n == 260
    assert got["b"].r == pytest.approx(1) and got["c"].r == pytest.approx(-1) and got["d"].r is None and got["d"].r2 == 0
    assert got["e"].r == pytest.approx(np.corrcoef(x, sites[4][2])[0, 1])
    # r2 by the same iteration in plain Python
    a, e = x, sites[4][2]
    n = lambda i, j: int(((a == i) & (e == j)).sum())
    ab, xx, ax, xb, h = 2 * n(2, 2) + n(1, 2) + n(2, 1), 2 * n(0, 0) + n(1, 0) + n(0, 1), 2 * n(2, 0) + n(1, 0) + n(2, 1), 2 * n(0, 2) + n(1, 2) + n(0, 1), n(1, 1)
    t, last = 0.5, 2.0
    while abs(t - last) > 1e-4:
        last = t
        u, v = (ab + (1 - t) * h) * (xx + (1 - t) * h), (ax + t * h) * (xb + t * h)
        t = v / (u + v) if u + v else 0.5
    fa, fb = a.mean() / 2, e.mean() / 2
    d = (ab + (1 - t) * h) / 260 - fa * fb
    assert got["e"].r2 == pytest.approx(d * d / (fa * fb * (1 - fa) * (1 - fb)))
    window = {(r.lead, r.rsid) for r in ld.ld_window(leads, packed).collect()}
    assert window == {("a", "a"), ("a", "b"), ("a", "c"), ("a", "g"), ("off", "off")}
    members = spark.createDataFrame([("k", s) for s in ("a", "b", "zz")], "cluster_id string, rsid string")
    top = spark.createDataFrame([("k", "a")], "cluster_id string, rsid string")
    assert rows(ld.ld_to_top(members, top, packed)) == [("k", "a", 1.0), ("k", "b", pytest.approx(got["b"].r2)), ("k", "zz", 0.0)]
    assert rows(ld.ld_to_top(members, top.withColumn("rsid", F.lit("zz")), packed)) == [("k", "a", 1.0), ("k", "b", 1.0), ("k", "zz", 1.0)]
    assert rows(ld.ld_to_top(members, top, packed, metric="d_prime"))[1] == ("k", "b", pytest.approx(got["b"].d_prime))
    assert rows(ld.pairwise_ld(members.where("rsid = 'a'"), packed).select("rsid_a", "rsid_b", "r")) == [("a", "a", 1.0)]


def test_merging_and_overlaps(spark):
    leads = spark.createDataFrame([("r1", "1", 10, 1e-12), ("r2", "1", 20, 1e-10), ("r3", "1", 30, 1e-8), ("r4", "2", 10, 1e-9)], "rsid string, chrom string, pos long, pvalue double")
    members = spark.createDataFrame([("r1", "r1"), ("r2", "r2"), ("r2", "r1"), ("r3", "r3"), ("r3", "r1"), ("r4", "r4"), ("r4", "r1")], "lead string, rsid string")
    # r3 is 1e4 times weaker than r1, r4 lies on another chromosome
    assert rows(cluster.merge_edges(leads, members)) == [("r1", "r2")]
    assert {r.rsid: r.cluster_id for r in cluster.merge_preclusters(leads, members).collect()} == {"r1": "r1", "r2": "r1", "r3": "r3", "r4": "r4"}
    ranges = spark.createDataFrame([("a", "1", 0, 10, 1e-9), ("b", "1", 10, 20, 1e-8), ("c", "1", 20, 30, 1e-7), ("d", "1", 31, 40, 1e-7), ("e", "1", 35, 50, 1e-7), ("f", "1", 50, 60, 1e-7)], "cluster_id string, chrom string, first long, last long, pvalue double")
    kept = cluster.remove_overlaps(ranges)
    # c falls to b although b falls to a
    assert [r[0] for r in rows(kept)] == ["a", "d", "e", "f"]
    m = spark.createDataFrame([("d", "x"), ("e", "x"), ("e", "y"), ("f", "y"), ("a", "z")], "cluster_id string, rsid string")
    assert rows(cluster.merge_tied_overlaps(kept, m)) == [("a", "a"), ("d", "d"), ("e", "d"), ("f", "f")]


def test_graph_operators(spark):
    e = spark.createDataFrame([(2, 1), (3, 2), (1, 3), (5, 4)], "child int, parent int")
    assert rows(graph.descendants(e, spark.createDataFrame([(1,), (4,)], "node int"))) == [(1, 1), (1, 2), (1, 3), (4, 5)]
    p = spark.createDataFrame([("a", "b", 2), ("b", "c", 1), ("c", "d", 3), ("a", "e", 4)], "a string, b string, place int")
    assert rows(graph.greedy_pairs(p)) == [("a", "e", 4), ("b", "c", 1)]
    assert rows(graph.components(spark.createDataFrame([("x", "y"), ("y", "z"), ("q", "q")], "a string, b string"))) == [("x", "x"), ("y", "x"), ("z", "x")]


def test_scores_ranks_and_ties(spark):
    cis = spark.createDataFrame([("s", "g1", "PCHiC", 7.0), ("s", "g1", "VEP", 0.25), ("s", "g1", "VEP", 0.5), ("s", "g2", "Nearest", 1.0), ("s", "g2", "GERP", 9.0), ("s", "g3", "GTEx", 0.5)], "rsid string, gene_id string, source string, score double")
    reg = spark.createDataFrame([("s", "Regulome", 0.5), ("s", "GERP", 4.0)], "rsid string, source string, score double")
    v = evidence.v2g_scores(cis, reg)
    got = {r.gene_id: r for r in v.collect()}
    assert got["g1"].score == 1 + 0.5 + 0.5 and got["g1"].PCHiC == 1 and got["g2"].score == 1.5 and got["g2"].GERP == 4.0
    tied = v.withColumn("score", F.when(F.col("gene_id") == "g3", 1.5).otherwise(F.col("score")))
    assert {r.gene_id: r.rank for r in output.gene_rank(tied).collect()} == {"g1": 1, "g2": 3, "g3": 3}
    assert rows(evidence.drop_gtex(cis).where("gene_id = 'g3'")) == [("s", "g3", "none", 0.0)]
    stats = {r.gene_id: (r.VEP_count, r.VEP_sum, r.VEP_mean) for r in evidence.vep_stats(v.select("rsid", "gene_id"), cis).collect()}
    assert stats == {"g1": (2, 0.75, 0.375), "g2": (0, 0, 0), "g3": (0, 0, 0)}


def test_compat_choices(spark):
    a = spark.createDataFrame([("s", 1e-9, 1), ("s", 1e-3, 2), ("t", 1e-9, 3)], "rsid string, pvalue double, n int")
    assert {r.rsid for r in filters.genome_wide(output.gwas_snps(a)).collect()} == {"s", "t"}
    assert {r.rsid for r in filters.genome_wide(output.gwas_snps(a, keep="max")).collect()} == {"t"}
    b = a.withColumn("cluster_id", F.lit(1))
    assert rows(output.top_gwas_hit(b)) == [(1, "s", 1e-9)] and rows(output.top_gwas_hit(b, order="max")) == [(1, "s", 1e-3)]
    e = spark.createDataFrame([("g", "s", "Liver", 0.25, 0.1)], "gene_id string, rsid string, tissue string, pvalue double, beta double")
    assert evidence.tissue_columns(e, ["Liver", "Lung"]).first()[2:] == (0.75, 0.0)
    assert evidence.tissue_columns(e, ["Liver", "Lung"], compat=True).first()[2:] == (0.25, 0.0)
    x = spark.range(1)
    assert x.select(scoring.total_score(F.lit(0.5), F.lit(1.5))).first()[0] == 1.0
    assert x.select(scoring.total_score(F.lit(0.5), F.lit(1.5), 1 / 3)).first()[0] == pytest.approx(((0.5 ** (4 / 3) + 1.5 ** (4 / 3)) / 2) ** 3)
    z = [F.lit(2.0), F.lit(1.0)]
    own, compat = (x.select(scoring.log_bf_gprior(z, F.lit(100.0), F.lit(0.5), compat=c)).first()[0] for c in (False, True))
    quad = (4 + 1 - 2) / 0.75
    assert own == pytest.approx(-math.log(101) + 0.5 * 100 / 101 * quad) and compat == pytest.approx(-0.5 * math.log(101) + 0.5 * 100 / 101 * quad)
    assert x.select(scoring.z_from_p(F.lit(0.0), F.lit(-1.0))).first()[0] == pytest.approx(-38.07, abs=0.3)
    assert x.select(scoring.pics_probability(F.lit(1.0), F.lit(9.0))).first()[0] == 1.0


def test_pair_bayes_factor_equals_matrix_form(spark):
    rng = np.random.default_rng(5)
    cases = [(*rng.normal(0, 3, 2).tolist(), float(rng.uniform(-1, 1)), *rng.uniform(-1.2, 1.2, 2).tolist()) for _ in range(300)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, z1 double, z2 double, r double, b1 double, b2 double")
    got = {r.i: r.x for r in df.select("i", scoring.log_bf_pair(F.col("z1"), F.col("z2"), F.col("r"), F.lit(700.0), F.col("b1"), F.col("b2")).alias("x")).collect()}
    for i, (z1, z2, r, b1, b2) in enumerate(cases):
        want = finemap.set_log_bfs(np.array([[z1, z2]]), np.array([[b1, b2]]), np.array([[[1, r], [r, 1]]]), 700, 0.0025)[0]
        assert got[i] == pytest.approx(want, abs=1e-8)


def test_fine_mapping_sums_to_one(spark):
    m = spark.createDataFrame([("k", f"s{i}", float(i) - 2, 0.01 * i) for i in range(6)] + [("one", "s9", 3.0, 0.1)], "cluster_id string, rsid string, z double, beta double")
    pairs = spark.createDataFrame([("k", f"s{i}", f"s{j}", 0.1 * (i + j) % 1) for i in range(6) for j in range(i + 1, 6)], "cluster_id string, rsid_a string, rsid_b string, r double")
    c = finemap.configurations(m, pairs, 1000, 3).where("m > 1")
    assert c.count() == 6 + 15 + 20
    p = finemap.posterior(c)
    assert p.agg(F.sum("posterior")).first()[0] == pytest.approx(1)
    inc = {r.rsid: r.probability for r in finemap.inclusion_probability(p).collect()}
    assert sum(inc.values()) == pytest.approx(p.agg(F.sum(F.col("posterior") * F.col("size"))).first()[0])
    for r in c.where("size = 3").collect():
        i = [int(s[1:]) for s in r.snps]
        cov = np.array([[1 if a == b else (0.1 * (a + b)) % 1 for b in i] for a in i])
        assert r.log_bf == pytest.approx(finemap.set_log_bfs(np.array([i]) - 2.0, 0.01 * np.array([i]), cov[None], 1000, 0.0025)[0])
    left = m.withColumn("z", F.expr("if(rsid in ('s1', 's3'), null, z)")).withColumn("beta", F.expr("if(rsid in ('s1', 's3'), null, beta)"))
    got = {r.rsid: r for r in finemap.impute_z(left, pairs).collect() if r.cluster_id == "k"}
    s = 0.9 * np.array([[1 if a == b else (0.1 * (a + b)) % 1 for b in range(6)] for a in range(6)]) + 0.1 * np.eye(6)
    k = [0, 2, 4, 5]
    want = s[np.ix_([1, 3], k)] @ np.linalg.pinv(s[np.ix_(k, k)], 1e-4) @ (np.array(k) - 2.0)
    assert [got["s1"].z, got["s3"].z] == pytest.approx(want.tolist()) and got["s1"].imputed and not got["s0"].imputed


def test_duplicate_statistics_are_an_error(spark):
    m = spark.createDataFrame([("k", "s1")], "cluster_id string, rsid string")
    twice = spark.createDataFrame([("s1", 0.1, 1.0), ("s1", 0.2, 1.0)], "rsid string, pvalue double, beta double")
    with pytest.raises(Exception, match="two rows for s1"):
        finemap.attach_summary_stats(m, twice).collect()
    assert finemap.attach_summary_stats(m, twice.limit(1)).first().z == pytest.approx(1.6449, abs=1e-3)


def test_summary_stats_file(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("chromosome\tbase_pair_location\tvariant_id\teffect_allele\t other_allele\tbeta\tstandard_error\tp-value\n1\t5\trs1\tA\tC\t0.1\t0.01\t1e-9\n1\t6\trs2\tA\tC\t-0.1\t0.01\t1e-4\n1\t7\trs3\tA\tC\tNA\t0.01\t1e-9\n1\t8\trs4\tA\tC\t0.2\t0.01\t.\n")
    got = readers.read_summary_stats(spark, str(tmp_path / "s.tsv"), 1e-4).collect()
    assert [(r.snp, r.pvalue, r.beta_coefficient, r.sample_size) for r in got] == [("rs1", 1e-9, 0.1, 1000)]


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", None, 2.5)], "x string, y int, z double")
    readers.write_tsv(df, str(tmp_path / "t"))
    assert rows(spark.read.csv(str(tmp_path / "t"), sep="\t", header=True, nullValue="None", schema=df.schema)) == rows(df)
    readers.write_json(df, str(tmp_path / "j"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == rows(df)
    bed = tmp_path / "b.bed"
    bed.write_text("1\t5\t9\tG\t0.5\n1\tx\t9\tG\t1\n")
    assert rows(readers.read_bed(spark, str(bed), "symbol")) == [("1", 5, 9, "G", 0.5)]


def test_prep_details(spark):
    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    assert rows(prep.pad_columns(lines("a\tb", "a\tb\tc\td"), 3)) == [("a\tb\t",), ("a\tb\tc\td",)]
    assert rows(prep.prefilter_pvalue(lines("1e-5", "1e-4", "x"), 1e-4, 1)) == [("1e-5",)]
    assert rows(prep.ontology_terms(lines("A, B", "N/A,,A"))) == [("A",), ("B",)]
    bed = spark.createDataFrame([("1", 0, 11, "g"), ("1", 490_000, 500_001, "g"), ("1", 990_000, 1_010_000, "g"), ("2", 5, 6, "g"), ("1", 5, 6, "unknown")], "chrom string, bstart long, bend long, gene_id string")
    genes = spark.createDataFrame([("g", "1", 5)], "gene_id string, chrom string, tss long")
    assert rows(prep.fit_fdr_model(bed, genes)) == [(0, 1, pytest.approx(0.99)), (49, 1, pytest.approx(0.99))]


def test_trait_matching_prefers_iris(spark):
    a = spark.createDataFrame([(["i1", "i2"], "d"), (["i3"], "d"), ([], "d"), (["i3"], "other"), (None, "d")], "iris array<string>, reported_trait string")
    assert rows(filters.match_trait(a, ["d"], ["i2"]).select("efo")) == [("i2",), ("i3",), (None,), (None,)]
    assert filters.match_trait(a, [], []).count() == 0


def test_alleles_and_checks(spark):
    a = spark.createDataFrame([(1, "rs1-A"), (1, " rs1-C"), (2, "rs2"), (3, "rs3-?"), (4, "rs4-A"), (4, "rs5-A"), (5, "rs1-A")], "association_id int, risk_allele string")
    split = alleles.split_risk_allele(a)
    assert {(r.association_id, r.status) for r in split.collect()} == {(1, "ok"), (2, "base_missing"), (3, "ok"), (4, "integrity"), (5, "ok")}
    ref = alleles.reference_base(spark.createDataFrame([("rs1", "A/C"), ("rs1", "-/A"), ("rs3", "G/T"), ("rs6", "A/C"), ("rs6", "T/C"), ("rs7", "-/A")], "rsid string, allele_string string"))
    assert rows(ref) == [("rs1", "A", "ok"), ("rs3", "G", "ok"), ("rs6", None, "ambiguous"), ("rs7", None, "none")]
    assert rows(alleles.orientation_consensus(split, ref)) == [(1, None, "mixed"), (3, None, "not_substitution"), (5, True, "ok")]
    df = spark.createDataFrame([("rs1", 0.0, 1), ("x", 1.5, 0), (None, None, None)], "s string, p double, q int")
    got = {r.check: (r.violations, r.example) for r in checks.run_checks(df, {"p": checks.in_range("p", 0, 1), "p#2": checks.in_range("p", 0, 1, allow_null=True), "s": checks.matches("s", checks.SNP_ID), "q": checks.positive("q")}).collect()}
    assert got["s matches ^rs\\d+$"] == (2, "x") and got["q > 0"] == (2, "0")
    u = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "a"), ("i", None)], "k string, v string")
    assert rows(checks.unique_per_group(u, ["k"], ["v"])) == [("k -> v", 2)]


def test_reports(spark):
    df = spark.createDataFrame([(1, 0.0, "a"), (1, 5.0, "a"), (2, 10.0, "b"), (3, None, "b")], "k int, x double, s string")
    assert rows(report.field_histogram(df, "x", bins=10)) == [(0, 1), (5, 1), (9, 1)]
    assert rows(report.field_histogram(df.where("k = 2"), "x", bins=10)) == [(5, 1)]
    assert rows(report.top_values(df, "s", 1)) == [("a", 2)]
    assert rows(report.fit_inverse_curve(spark.createDataFrame([(1.0, 3.0), (2.0, 1.5)], "x double, y double"), "x", "y")) == [(3.0,)]
    assert rows(report.degree_distribution(df, "k", "s")) == [("a", 1, 3), ("b", 1, 1), ("b", 2, 1)]


def test_union_and_unknown_source(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(2)
    assert readers.union_sources({"a": a, "b": b}).count() == 3
    with pytest.raises(ValueError):
        readers.union_sources({"a": a}, ["zz"])


def test_pairs_without_ld_count_with_zero(spark):
    m = spark.createDataFrame([("k", x, 1.0 + i, 0.01) for i, x in enumerate("abd")], "cluster_id string, rsid string, z double, beta double")
    pairs = spark.createDataFrame([("k", "a", "b", 0.5), ("k", "b", "b", 1.0)], "cluster_id string, rsid_a string, rsid_b string, r double")
    for kmax, want in ((2, 6), (3, 7)):
        c = finemap.configurations(m, pairs, 1000, kmax)
        assert c.count() == want == c.select("snps").distinct().count()
    got = {tuple(r.snps): r.log_bf for r in c.collect()}
    cov = np.array([[1, 0.5, 0], [0.5, 1, 0], [0, 0, 1]])
    assert got[("a", "b", "d")] == pytest.approx(finemap.set_log_bfs(np.array([[1.0, 2, 3]]), np.full((1, 3), 0.01), cov[None], 1000, 0.0025)[0])
    assert finemap.member_pairs(m, block=1).count() == 3 and finemap.configurations(m.limit(0), pairs, 1000, 3).count() == 0


def test_expression_is_imputed_and_in_sets_of_two(spark):
    """eQTL sets by brute force: z of each gene and tissue filled by LD, all sets of one and two, softmax."""
    rng = np.random.default_rng(7)
    names = [f"s{i}" for i in range(5)]
    r = np.round(np.clip(rng.uniform(-0.3, 0.8, (5, 5)), -1, 1), 3)
    r = np.triu(r, 1) + np.triu(r, 1).T + np.eye(5)
    members = spark.createDataFrame([("k", n) for n in names] + [("other", "s9")], "cluster_id string, rsid string")
    pairs = spark.createDataFrame([("k", names[i], names[j], float(r[i, j])) for i in range(5) for j in range(i + 1, 5)], "cluster_id string, rsid_a string, rsid_b string, r double")
    hits = {("g1", "t1"): {0: 4.0}, ("g1", "t2"): {1: -2.0, 3: 1.0}, ("g2", "t1"): {i: float(i) for i in range(5)}}
    index = spark.createDataFrame([(g, t, names[i], z, z / 100) for (g, t), own in hits.items() for i, z in own.items()] + [("g3", "t1", "unknown", 1.0, 0.0)], "gene_id string, tissue string, rsid string, z double, beta double")
    got = finemap.eqtl_configurations(members, index, 500, pairs, 2).collect()
    assert {(x.cluster_id, x.gene_id, x.tissue) for x in got} == {("k", *k) for k in hits}
    for (g, t), own in hits.items():
        s, k = 0.9 * r + 0.1 * np.eye(5), sorted(own)
        z = s[:, k] @ np.linalg.pinv(s[np.ix_(k, k)], 1e-4) @ np.array([own[i] for i in k])
        z[k] = [own[i] for i in k]
        bf = {(i,): -0.5 * math.log(2.25) + 0.5 * z[i] ** 2 / (1 / 1.25 + 1) for i in range(5)}
        bf |= {(i, j): finemap.set_log_bfs(z[None, [i, j]], z[None, [i, j]] / 100, r[np.ix_([i, j], [i, j])][None], 500, 0.0025)[0] for i in range(5) for j in range(i + 1, 5)}
        one = math.log(0.2) + 4 * math.log(0.8)
        total = math.log(math.exp(one) + math.exp(2 * math.log(0.2) + 4 * math.log(0.8)))
        x = {s_: b + len(s_) * math.log(0.2) + (5 - len(s_)) * math.log(0.8) - total for s_, b in bf.items()}
        top = max(x.values())
        e = {s_: math.exp(v - top) for s_, v in x.items()}
        mine = {tuple(int(n[1:]) for n in y.snps): y.posterior for y in got if (y.gene_id, y.tissue) == (g, t)}
        assert set(mine) == set(e) and all(mine[s_] == pytest.approx(e[s_] / sum(e.values()), abs=1e-9) for s_ in e)
    assert finemap.eqtl_configurations(members, index.limit(0), 500, pairs, 2).count() == 0


def test_posterior_of_extreme_sets(spark):
    c = spark.createDataFrame([("a", 650.0, 0.0), ("a", 649.0, 0.0), ("a", -800.0, 0.0), ("b", -900.0, -50.0), ("c", 2000.0, 0.0), ("c", 700.0, 0.0), ("d", None, 0.0)], "cluster_id string, log_bf double, log_prior double")
    got = sorted((x.cluster_id, x.posterior) for x in finemap.posterior(c).collect() if x.posterior is not None)
    q = 1 / (1 + math.exp(-1))
    assert [k for k, _ in got] == list("aaabcc") and [v for _, v in got] == pytest.approx([0.0, 1 - q, q, 1.0, 0.5, 0.5])


def test_a_cluster_needs_a_shared_folder():
    from variantloom.functions.tables import shared_dir

    class Conf:
        def get(self, name, other=None):
            return other

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_a_long_chain_of_terms_takes_few_rounds(spark, monkeypatch):
    n, written = 400, []
    monkeypatch.setattr(graph, "stored", lambda df, name="t", keep=graph.stored: written.append(name) or keep(df, name))
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(n + 9, n), (n, n + 9), (None, 3), (5, None)], "child int, parent int")
    found = graph.descendants(edges, spark.createDataFrame([(0,), (n - 3,), (n + 9,), (None,), (0,)], "node int"))
    below = lambda r: set(range(r + 1, n + 1)) | {n + 9}
    want = {(r, x) for r in (0, n - 3) for x in below(r)} | {(n + 9, n), (n + 9, n + 9)}
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert written.count("desc") <= 11  # 400 levels
