"""Packed panels against calls in rows, and LD by tiles against LD pair by pair."""

import math
import random

import pytest
from pyspark.sql import functions as F

from variantloom.operators import ld, tiles
from variantloom.sources import panel, readers

CALLS = ["0|0", "0|1", "1|0", "1|1", "0/1", "1/1", "./.", ".", "1|1:35", "0|1:3:0|0", "10|1", "0|2", "1", "", "0|1|1", "0|0:"]


def vcf(rng, sites, samples):
    lines = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(f"s{i}" for i in range(samples))]
    for k in range(sites):
        odd = [CALLS[rng.randrange(len(CALLS))] if rng.random() < 0.2 else rng.choice(CALLS[:4]) for _ in range(samples)]
        lines.append("\t".join([rng.choice("12"), str(1000 + 40 * k), f"rs{k}", "A", "." if k % 17 == 3 else "C", ".", "PASS", "x:y", "GT:DP", *odd]))
    return [*lines, "1\t5\trs_short\tA\tC\t.\t.\t.\tGT", "1\tx\trs_no_place\tA\tC\t.\t.\t.\tGT\t0|0", "", "1\t7\trs_one\tA\tC\t.\t.\t.\tGT\t1|1"]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(x,) for x in vcf(random.Random(2), 120, 150)], "value string")


def test_panel_like_the_long_way(spark, lines):
    found = panel.packed_panel(lines)
    long = readers.parse_vcf(lines.where("value not like '%rs_no_place%'"))
    want = ld.pack_genotypes(long.select("rsid", "chrom", "pos", F.col("sample_no").alias("sample_id"), "dosage"), 150)
    got = {r.rsid: r for r in found.collect()}
    assert got.pop("rs_one")[5:] == (0, 0, 1, [0], [0], [1]) and "rs3" not in got and len(got) == 113
    for r in want.where("rsid != 'rs_one'").collect():
        g = got.pop(r.rsid)
        assert (g.chrom, g.pos, g.m0, g.m1, g.m2) == (r.chrom, r.pos, r.m0, r.m1, r.m2)
        assert [g.n0, g.n1, g.n2] == [sum(w.bit_count() for w in m) for m in (r.m0, r.m1, r.m2)] and (g.ref, g.alt) == ("A", "C")
    assert not got
    assert panel.packed_panel(lines.limit(0)).collect() == []


def test_panel_is_made_without_a_shuffle(spark, lines, tmp_path):
    lines.coalesce(2).write.text(f"{tmp_path}/vcf")
    plan = panel.common(panel.of_samples(panel.packed_panel(spark.read.text(f"{tmp_path}/vcf")), [5, 1, 0]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Generate" not in plan


def test_population_and_frequency(spark, lines):
    samples = spark.createDataFrame([(i, "EUR" if i % 3 == 0 or i > 140 else "AFR") for i in range(150)], "sample_no long, super_pop string")
    mask = panel.sample_mask(samples, F.col("super_pop") == "EUR")
    assert sum(w.bit_count() for w in mask) == 56 and panel.sample_mask(samples.limit(0), F.lit(True)) == []
    cut = panel.of_samples(panel.packed_panel(lines).where("rsid != 'rs_one'"), mask).withColumn("f", panel.frequency())
    long = readers.parse_vcf(lines.where("value not like '%rs_no_place%'")).where("rsid != 'rs_one' and (sample_no % 3 = 0 or sample_no > 140)")
    want = {r.rsid: r for r in long.groupBy("rsid").agg(F.avg("dosage").alias("f"), F.count("*").alias("n")).collect()}
    for r in cut.collect():
        assert r.f == pytest.approx(want[r.rsid].f / 2) and r.n0 + r.n1 + r.n2 == want[r.rsid].n
    assert {r.rsid for r in panel.common(cut, 0.49).collect()} == {k for k, r in want.items() if min(r.f / 2, 1 - r.f / 2) >= 0.49}
    assert panel.common(panel.of_samples(panel.packed_panel(lines), []), 0.0).collect() == []  # no calls, no frequency


@pytest.mark.parametrize("in_order", [False, True])
def test_written_panel_is_read_by_range(spark, lines, tmp_path, in_order):
    path = f"{tmp_path}/panel"
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    panel.write_panel(panel.packed_panel(lines), path, in_order)
    part = panel.read_panel(spark, path, "2", 2000, 3000)
    assert {r.rsid for r in part.collect()} == {r.rsid for r in panel.packed_panel(lines).where("chrom = '2' and pos between 2000 and 3000").collect()} != set()
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(chrom,2)" in plan and "GreaterThanOrEqual(pos,2000)" in plan and "LessThanOrEqual(pos,3000)" in plan
    assert panel.read_panel(spark, path).count() == 114


@pytest.mark.parametrize("most, reach, missing", [(20_000, 300, True), (7, 300, False), (7, 90, True), (20_000, 10**6, False)])
def test_tiles_like_pairs(spark, monkeypatch, most, reach, missing):
    rng = random.Random(most + reach)
    sites = [(f"rs{k}", rng.choice("12"), rng.choice((rng.randrange(3000), 500)), [rng.choice((0, 1, 2, None) if missing else (0, 1, 2)) for _ in range(70)]) for k in range(90)]
    sites += [("flat", "1", 600, [1] * 70), ("twice", "1", 610, [0, 2] * 35), ("twice", "1", 650, [0, 2] * 35)]
    calls = spark.createDataFrame([(r, c, p, s, d) for r, c, p, ds in sites for s, d in enumerate(ds) if d is not None], "rsid string, chrom string, pos long, sample_id long, dosage int")
    packed = ld.pack_genotypes(calls, 70)
    leads = spark.createDataFrame([(f"rs{k}",) for k in range(0, 90, 4)] + [("flat",), ("twice",), ("absent",), (None,), ("rs4",)], "rsid string")
    names = ["lead", "rsid", "chrom", "pos", *tiles.COUNTS, *tiles.STATS]
    want = ld.ld_stats(ld.genotype_pair_counts(ld.band_pairs(leads, packed, reach).where("a.rsid != b.rsid"))).select(F.col("a.rsid").alias("lead"), "b.rsid", "b.chrom", "b.pos", *names[4:])
    key = lambda r: tuple(None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v for v in (r[n] for n in names))
    wanted = sorted(map(key, want.collect()), key=repr)
    got = sorted(map(key, tiles.tile_pairs(leads, packed, reach, most=most).collect()), key=repr)
    assert len(got) == len(wanted) > 100 and got == wanted
    cut = tiles.tile_pairs(leads, packed, reach, 0.05, most).collect()
    assert sorted(map(key, cut), key=repr) == [x for x in wanted if x[names.index("r2")] is not None and x[names.index("r2")] >= 0.05]
    assert tiles.tile_pairs(leads, packed.limit(0), reach).collect() == [] == tiles.tile_pairs(leads.limit(0), packed, reach).collect()


def test_blocks_of_a_cluster_like_pairs(spark):
    rng = random.Random(9)
    sites = [(f"rs{k}", "1", k, [rng.choice((0, 1, 2, None)) for _ in range(66)]) for k in range(60)]
    calls = spark.createDataFrame([(r, c, p, s, d) for r, c, p, ds in sites for s, d in enumerate(ds) if d is not None], "rsid string, chrom string, pos long, sample_id long, dosage int")
    packed = ld.pack_genotypes(calls, 66)
    members = spark.createDataFrame([("k" if k < 50 else "l", f"rs{k}") for k in range(60)] + [("k", "rs1"), ("k", "absent"), ("one", "rs5")], "cluster_id string, rsid string")
    every = {tuple(sorted((r.lead, r.rsid))): r for r in tiles.tile_pairs(members.select("rsid"), packed, 100).collect()}
    for block in (256, 8):
        got = ld.pairwise_ld(members, packed, block).collect()
        assert len(got) == 50 * 51 // 2 + 10 * 11 // 2 + 1 == len({(r.cluster_id, r.rsid_a, r.rsid_b) for r in got})
        for r in got:
            if r.rsid_a == r.rsid_b:
                assert r.r == r.r2 == r.d_prime == 1
            else:
                w = every[r.rsid_a, r.rsid_b]
                assert r.rsid_a < r.rsid_b and (r.r2, r.d_prime, r.r) == pytest.approx((w.r2, w.d_prime, w.r))
