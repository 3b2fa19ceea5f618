"""Stored interval indexes against the joins without one, and what their plans read and move."""

import random

import pytest

from variantloom.operators import intervals
from variantloom.sources import index


@pytest.fixture(scope="module")
def tracks(spark):
    rng = random.Random(6)
    bed = [(rng.choice(("1", "2", "X")), a := rng.randrange(90_000), a + rng.choice((0, 1, 50, 4_000, 12_000)), f"g{i}", rng.random() if i % 9 else float("nan")) for i in range(300)]
    bed += [(None, 1, 10, "g", 1.0), ("3", 5, 4, "g", 1.0), ("1", 4_999, 5_000, "edge", 1.0), ("1", 5_000, 5_001, "edge", 1.0)]
    snps = [(f"rs{i}", rng.choice(("1", "2", "Y")), rng.choice((rng.randrange(100_000), 5_000, 5_001))) for i in range(200)] + [("none", None, 5), ("no_place", "1", None), ("rs0", "1", 77)]
    return spark.createDataFrame(bed, "chrom string, bstart long, bend long, gene string, value double"), spark.createDataFrame(snps, "rsid string, chrom string, pos long")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def scan_files(df):
    """How many files the scan of the index reads."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size()) if "index_" in leaves.apply(i).toString()]
    assert len(found) == 1
    return found[0].metrics().apply("numFiles").value()


def above(plan, leaf):
    """The nodes of a printed plan that stand above the scan of a table."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "Scan" in x and leaf in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    out, level = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < level:
            out, level = [*out, x], depth(x)
    return out


def test_overlap_and_signal_like_without_index(spark, tracks):
    bed, snps = tracks
    stored = index.write_intervals(bed, width=3_000, buckets=4)
    assert rows(index.overlap(snps, stored), "rsid", "pos", "gene", "bend") == rows(intervals.overlap(snps, bed), "rsid", "pos", "gene", "bend") != []
    got, want = (dict(x.collect()) for x in (index.mean_signal(snps.where("pos is not null"), stored), intervals.mean_signal(snps.where("pos is not null"), bed)))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    assert rows(index.overlap(snps.limit(0), stored), "rsid") == [] == rows(index.overlap(snps, index.write_intervals(bed.limit(0))), "rsid")
    with pytest.raises(ValueError, match="columns"):
        index.overlap(snps.withColumnRenamed("rsid", "gene"), stored)
    with pytest.raises(ValueError, match="places"):
        index.nearest(snps, stored)


def test_nearest_like_without_index(spark, tracks):
    rng = random.Random(1)
    tss = spark.createDataFrame([(rng.choice(("1", "2")), rng.randrange(0, 100_000, 500), f"g{i}") for i in range(90)] + [("1", 5_000, "tie_a"), ("1", 5_002, "tie_b"), (None, 1, "g"), ("1", None, "g")], "chrom string, tss long, gene_id string")
    snps = tracks[1]
    for width in (100_000, 700):
        got = index.nearest(snps, index.write_places(tss, width=width, buckets=3))
        assert rows(got, "rsid", "pos", "gene_id", "distance", "tss") == rows(intervals.nearest(snps, tss, width), "rsid", "pos", "gene_id", "distance", "tss") != []


def test_index_is_not_moved_and_read_in_part(spark, tracks):
    bed, snps = tracks
    stored = index.write_intervals(bed, width=3_000, buckets=4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = index.overlap(snps, stored)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(chrom") == 1 and not [x for x in above(plan, "index_") if "Exchange" in x]
        assert any("SortMergeJoin" in x for x in above(plan, "index_")) and "Bucketed: true" in plan
        whole, one = scan_files(index.overlap(snps, stored)), scan_files(index.overlap(snps.where("chrom = '2'"), stored))
        assert 0 < one < whole
        assert scan_files(index.overlap(snps.where("chrom = 'Y'"), stored)) == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    index.drop_index(spark, stored)
    assert not spark.catalog.tableExists(stored.table)
