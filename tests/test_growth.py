"""What must grow no faster than the tables: pairs within reach, fields of lines, scores of sets, figures of joined rows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from variantloom.functions import scoring
from variantloom.operators import evidence, finemap, output
from variantloom.plans import QUERIES, base
from variantloom.sources import readers, rejects

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["flatten_vep", "flatten_vep_regulatory", "vep_stats", "vep_terms"])
def test_vep_rows_come_from_bins(spark, name):
    joins = [line for line in optimized(QUERIES[name](spark, SF)).splitlines() if "Join Inner" in line and "tss" not in line]
    assert joins and all(re.search(r"_bin#", line) for line in joins)
    want = base.view(spark, SF, "fx_vep")
    got = base.vep(spark, SF)
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()


@pytest.mark.parametrize("parse,lines", [(readers.parse_grasp, "fx_grasp_lines"), (readers.parse_phewas, "fx_phewas_lines"), (readers.parse_gwas_db, "fx_gwasdb_lines"), (readers.parse_neale_ukb, "fx_ukb_lines")])
def test_a_line_is_split_once(spark, parse, lines):
    assert optimized(parse(base.view(spark, SF, lines))).count("rtrim(") == 1


@pytest.mark.parametrize("kind", ["grasp", "phewas", "gwas_db", "neale_ukb"])
def test_the_reason_of_a_line_splits_it_once(spark, kind, monkeypatch):
    seen = []
    monkeypatch.setattr(rejects, "reason", lambda k, plain=rejects.reason: seen.append(plain(k)) or seen[-1])
    lines = spark.createDataFrame([("a\tb",), (None,), ("",)], "value string")
    got = rejects.split_lines(lines, kind)
    assert len(seen) == 1 and "split(" not in str(seen[0])
    assert got.counts == {"read": 3, "accepted": 0, "rejected": 3}
    assert sorted((r.line or "", r.reason) for r in got.rejected.collect()) == [("", "fields"), ("", "no line"), ("a\tb", "fields")]


@pytest.mark.parametrize("k", [2, 3, 4])
def test_sets_are_scored_from_one_decomposition(monkeypatch, k):
    rng = np.random.default_rng(k)
    x = rng.normal(size=(400, k, 6))
    x /= np.linalg.norm(x, axis=2, keepdims=True)
    cov = x @ x.transpose(0, 2, 1)
    cov[::7] *= 0.2
    cov[1::50, 0, 1] = cov[1::50, 1, 0] = 0.95
    cov[:, range(k), range(k)] = 1.0
    z, beta = rng.normal(0, 3, (400, k)), rng.normal(0, 0.3, (400, k))
    want = []
    for c, zz, b in zip(cov, z, beta, strict=True):
        full = np.block([[np.ones((1, 1)), b[None] * np.sqrt(0.5)], [b[:, None] * np.sqrt(0.5), c]])
        left_out = np.abs(np.tril(c, -1)).max() > 0.9 or np.linalg.eigvalsh(full).min() <= 0.1
        want.append(0.0 if left_out else -0.5 * np.linalg.slogdet(np.eye(k) + 2.5 * c)[1] + 0.5 * zz @ np.linalg.pinv(np.eye(k) / 2.5 + c, 1e-4) @ zz)
    monkeypatch.setattr(finemap.np.linalg, "pinv", lambda *a: pytest.fail("a singular value decomposition a set"))
    got = finemap.set_log_bfs(z, beta, cov, 1000, 0.0025)
    assert got == pytest.approx(np.array(want)) and 0 < np.count_nonzero(got) < 400


def test_figures_are_rounded_before_snps_meet_their_genes(spark):
    ld = spark.createDataFrame([("c", "a", 0.8123456789), ("c", "b", 1.0)], "cluster_id string, rsid string, ld double")
    top = spark.createDataFrame([("c", 1e-9)], "cluster_id string, pvalue double")
    v2g = spark.createDataFrame([(r, f"g{i}", i / 7) for r in "ab" for i in range(3)], "rsid string, gene_id string, score double")
    plain = [tuple(x) for x in output.cluster_genes(ld, top, v2g).collect()]
    df = output.cluster_genes(ld, top, v2g, 6)
    assert sorted(tuple(x) for x in df.collect()) == sorted((*p[:3], *(pytest.approx(x, abs=1e-6) for x in p[3:])) for p in plain)
    assert all(round(x, 6) == x for r in df.collect() for x in r[3:])
    assert optimized(QUERIES["cluster_genes"](spark, SF)).split("Join")[0].count("round(") == 1


def dealt_once(df, parts):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") == 1 and f", {parts}), REPARTITION_BY_NUM" in plan


def test_tissue_columns_are_dealt_once(spark):
    rows = [("g", "x", "rs1", 0.25, 1.0), ("g", "x", "rs1", 0.5, 0.0), ("g", "y", "rs1", 0.125, 0.0), ("h", "z", "rs1", 1.0, 0.0), ("h", "off", "rs2", 0.5, 0.0), ("h", "y", "rs2", None, 0.0)]
    got = evidence.tissue_columns(evidence.eqtl_index(spark.createDataFrame(rows, "gene_id string, tissue string, rsid string, pvalue double, beta double")), ["x", "y", "z"])
    assert dealt_once(got, spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(tuple(r) for r in got.collect()) == [("g", "rs1", 0.5, 0.875, 0.0), ("h", "rs1", 0.0, 0.0, 0.0), ("h", "rs2", 0.0, 0.0, 0.0)]


def test_evidence_without_gtex_is_dealt_once(spark):
    rows = [("a", "g", "GTEx", 0.5), ("a", "g", "GTEx", 0.7), ("b", "g", "GTEx", 0.5), ("b", "g", "PCHiC", 6.0), ("b", "g", "PCHiC", 6.0), ("c", "h", "Nearest", None)]
    got = evidence.drop_gtex(spark.createDataFrame(rows, "rsid string, gene_id string, source string, score double"))
    assert dealt_once(got, spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, got.collect())) == [("a", "g", "none", 0.0), ("b", "g", "PCHiC", 6.0), ("b", "g", "PCHiC", 6.0), ("c", "h", "Nearest", None)]


def test_rows_of_single_snps_are_grouped_once_and_not_sent_again(spark, capsys):
    plan = QUERIES["snp_output"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "Exchange hashpartitioning" not in plan[:plan.index("Union")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        QUERIES["snp_output"](spark, SF).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(-?\d+)", capsys.readouterr().out)]
    assert sizes and 0 < min(sizes) and max(sizes) < 8000  # the JVM only interprets longer methods


def test_single_snps_with_and_without_notes(spark):
    table = lambda rows, kinds: spark.createDataFrame(rows, kinds)
    figures = ", ".join(f"{c} double" for c in ("score", *evidence.CIS_SOURCES, *evidence.REG_SOURCES))
    scores = table([("a", "g", *[1 / 3] * 10), ("a", "h", *[0.0] * 10), ("b", "g", *[0.5] * 10), ("off", "g", *[0.5] * 10)], f"rsid string, gene_id string, {figures}")
    snps = table([("a", "1", 5), ("a", "1", 5), ("b", "1", 7), ("c", "1", 8), ("off", "odd", 9)], "rsid string, chrom string, pos long")
    genes = table([(g, g.upper(), "1", 1) for g in "ghi"], "gene_id string, name string, chrom string, tss long")
    eqtl = table([("g", "x", "a", 1 / 7), ("g", "y", "a", 1.0), ("i", "x", "a", 0.5), ("h", "other", "a", 0.25), ("g", "x", "c", 0.5)], "gene_id string, tissue string, rsid string, pvalue double")
    mafs = table([("a", {"eur": 0.25})], "rsid string, mafs map<string,double>")
    terms = table([("a", "g", "t1,t2"), ("a", "i", "t3")], "rsid string, gene_id string, vep_terms string")
    vep = table([("a", "g", 1, 0.1234567, 0.5)], "rsid string, gene_id string, VEP_count long, VEP_sum double, VEP_mean double")
    for most in (0, 10):
        got = output.snp_output(snps, scores, genes, eqtl, mafs, terms, vep, snps.distinct(), genes.select("gene_id", "chrom", "tss"), ["x", "y"], max_broadcast=most, places=6)
        rows = [(r.snp_rsID, r.gene_id, r.eur, r.afr, r.score, r.GERP, r.vep_terms, r.vep_sum, r.vep_mean, r.GTEx_x, r.GTEx_y) for r in got.collect()]
        assert sorted(rows) == [("a", "g", 0.25, None, 0.333333, 0.333333, "t1,t2", 0.123457, 0.5, 0.857143, 0.0), ("a", "h", 0.25, None, 0.0, 0.0, "N/A", 0.0, 0.0, 0.0, 0.0), ("b", "g", None, None, 0.5, 0.5, "N/A", 0.0, 0.0, 0.0, 0.0)]


def test_half_up_is_round(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=3000) * 10.0 ** rng.integers(-9, 14, 3000), np.arange(-500, 500) / 2e6, np.arange(-500, 500) * 1e-7, [0.0, -0.0, 1e300, np.inf, -np.inf, 2.0**40 / 1e6, 4.5e9 + 1e-6]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
    got = df.select(scoring.half_up(df["x"], 6).alias("a"), F.round("x", 6).alias("b"))
    assert got.where("not (a <=> b) or cast(a as string) <> cast(b as string)").count() == 0


def test_priors_of_sets_keep_the_number_of_partitions(spark):
    c = spark.createDataFrame([("c", [f"r{i}"], -1.0) for i in range(4)] + [("c", ["r0", "r2"], -2.0), ("d", ["r0"], -0.5)], "cluster_id string, snps array<string>, log_prior double")
    m = spark.createDataFrame([("c", f"r{i}") for i in range(4)] + [("d", "r0")], "cluster_id string, rsid string")
    notes = spark.createDataFrame([("r0", 1), ("r3", None)], "rsid string, DHS int")
    df = finemap.log_prior_annotation(c, notes, {"DHS": 1.5}, m)
    plan = df._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "snps#" in line]
    assert sent and all("REPARTITION_BY_NUM" in line for line in sent)  # neither combined in the task of one file nor merged
    pi = {"c": (4 * np.exp(-1.0) + np.exp(-2.0)) / 5, "d": np.exp(-0.5)}
    p = lambda k, r: 1 / (1 + np.exp(-(np.log(pi[k] / (1 - pi[k])) + (1.5 if r == "r0" else 0))))
    of = {"c": [f"r{i}" for i in range(4)], "d": ["r0"]}
    got = df.collect()
    assert len(got) == 6 and df.columns == ["cluster_id", "snps", "log_prior"]
    for k, snps, value in got:
        assert value == pytest.approx(sum(np.log(p(k, r)) if r in snps else np.log(1 - p(k, r)) for r in of[k]))
