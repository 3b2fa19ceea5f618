"""Panels whose sites share calls: the same rows as from the masks of each site, without moving them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from variantloom import plans
from variantloom.operators import filters, ld, shared, tiles
from variantloom.plans import base, loci

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(11)
    kinds = rng.integers(0, 4, (7, 130))  # 3: a missing call
    bits = lambda k, d: [int(sum(1 << i for i in np.flatnonzero(kinds[k, w : w + 63] == d).tolist())) for w in range(0, 130, 63)]
    calls = spark.createDataFrame([(k, *(bits(k, d) for d in range(3))) for k in range(7)], "calls long, m0 array<long>, m1 array<long>, m2 array<long>")
    sites = spark.createDataFrame([(f"rs{i}", "1" if i < 50 else "2", int(p), int(rng.integers(0, 7))) for i, p in enumerate(rng.integers(0, 40_000, 80))], "rsid string, chrom string, pos long, calls long")
    return shared.SharedPanel(sites, calls), shared.SharedPanel(sites, calls, most=0)


def _same(a, b):
    def key(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.na.fill(-9.0).collect())

    assert key(a) == key(b.select(a.columns)) and a.limit(1).count()


@pytest.mark.parametrize("most", [20_000, 5])
def test_pairs_of_shared_calls_like_tiles(spark, panel, most):
    few, many = panel
    assert few.few and not many.few
    leads = few.sites.where("pos % 3 = 0").select("rsid")
    for r2 in (None, 0.01):
        _same(tiles.tile_pairs(leads, few.packed(), 9_000, r2), shared.near_pairs(leads, few, 9_000, r2, most))
    _same(ld.near_pairs(leads, few, 9_000), ld.near_pairs(leads, many, 9_000))


def test_clusters_and_tops_of_shared_calls(spark, panel):
    few, many = panel
    members = few.sites.select(F.expr("if(pos % 2 = 0, 'a', 'b')").alias("cluster_id"), "rsid").union(spark.createDataFrame([("a", "off"), ("a", "rs1"), ("b", "rs1")], "cluster_id string, rsid string"))
    top = spark.createDataFrame([("a", "rs3"), ("b", "gone")], "cluster_id string, rsid string")
    _same(ld.pairwise_ld(members, few), ld.pairwise_ld(members, many))
    _same(shared.cluster_pairs(members.distinct(), few, block=3), ld.pairwise_ld(members, few).where("rsid_a < rsid_b"))
    for metric in ("r2", "d_prime"):
        _same(ld.ld_to_top(members, top, few, metric), ld.ld_to_top(members, top, many, metric))


def test_ld_of_the_plans_moves_no_masks(spark, monkeypatch):
    monkeypatch.setattr(tiles, "tile_pairs", None)
    monkeypatch.setattr(ld, "tile_pairs", None)
    monkeypatch.setattr(ld, "block_pairs", None)
    assert base.window(spark, SF).count() and plans.QUERIES["ld_to_top"](spark, SF).count() and plans.QUERIES["impute_z"](spark, SF).count()


def test_near_leads_by_bins(spark):
    got = loci._near_leads(spark, SF, 50_000)
    _same(base.sql(spark, SF, "SELECT s.rsid, l.rsid AS gwas_rsid FROM {fx_snp} s JOIN {fx_lead} l ON l.chrom = s.chrom AND abs(l.pos - s.pos) <= 50000"), got)
    assert "_bin" in got._jdf.queryExecution().optimizedPlan().toString()


def test_ld_filter_takes_pairs_in_either_order(spark):
    rows = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("a", None), (None, "a"), (None, None), ("b", "c")], "rsid string, gwas_rsid string")
    known = spark.createDataFrame([("b", "a", 0.7), ("a", "b", 0.9), ("a", "a", 1.0), (None, "a", 1.0), ("c", "b", 0.6)], "rsid_a string, rsid_b string, r2 double")
    assert sorted(map(tuple, filters.ld_filter(rows, known).select("rsid", "gwas_rsid", "r2").collect())) == [("a", "b", 0.9), ("b", "a", 0.9), ("c", "c", 1.0)]


@pytest.mark.parametrize(("name", "most", "where", "maker"), [
    ("packed_panel", 69 * 8, "panel", "packed_panel"), ("panel_common", 69 * 8, "panel", "packed_panel"), ("read_genotypes", 69 * 4, "readers", "parse_vcf"), ("filter_common_biallelic", 69 * 2 * 100, "prep", "filter_common_biallelic")])
def test_sites_with_the_same_calls_are_read_once(spark, monkeypatch, name, most, where, maker):
    from variantloom.operators import prep
    from variantloom.sources import panel, readers

    module = {"panel": panel, "readers": readers, "prep": prep}[where]
    plain, seen = getattr(module, maker), []
    monkeypatch.setattr(module, maker, lambda rows: seen.append(rows.count()) or plain(rows))
    sites = plans.QUERIES[name](spark, "/root/testdata/sf0.01").select("rsid").distinct().count()
    assert sum(seen) <= most and sites > 600


def test_odd_calls_are_read_as_before(spark):
    from variantloom.sources import readers

    calls = ["0|0", "0/1", "1|0:35", "1/1:9:x", "./.", "0|2", "2", "", "1|1|1", "0:1|1", "1/0\r", "|", "01", "0|1 ", " 0|1"]
    lines = spark.createDataFrame([("\t".join(["1", "5", "rs1", "A", "C", ".", ".", ".", "GT", *calls]),)], "value string")
    assert {r.sample_no: r.dosage for r in readers.parse_vcf(lines).collect()} == {0: 0, 1: 1, 2: 1, 3: 2, 10: 1}
