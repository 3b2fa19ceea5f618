"""Z scores by cluster: which way is taken, and what is left out."""

import pytest
from pyspark.sql import functions as F

from variantloom.operators import finemap, lifecycle

PAIRS = "cluster_id string, rsid_a string, rsid_b string, r double"


def tables(spark):
    members = [("all", "a1"), ("all", "a2"), ("all", "a2"), ("file", "f1"), ("file", "f2"), ("file", "f3"), ("guess", "g1"), ("guess", "g2"), ("none", "n1"), ("weak", "w1"), ("weak", "w2")]
    leads = [("all", "a1", 2.0, 0.1), ("all", "a2", -1.0, None), ("file", "f1", 9.0, 0.9), ("guess", "g1", 3.0, 0.3), ("none", "n1", None, 0.2), ("weak", "w1", 1.0, 0.1), ("weak", "w2", None, 0.1)]
    return (spark.createDataFrame(members, "cluster_id string, rsid string").withColumn("z", F.lit("clash")), spark.createDataFrame(leads, "cluster_id string, rsid string, z double, beta double"),
            spark.createDataFrame([("f2", 0.05, 0.2), ("f3", 0.05, -0.2), ("a1", 0.5, 0.1), ("elsewhere", 0.1, 0.1), ("g1", None, 0.1)], "rsid string, pvalue double, beta double"),
            spark.createDataFrame([("guess", "g1", "g2", 0.5), ("weak", "w1", "w2", -1.0), ("file", "f1", "f2", 0.5)], PAIRS))


def test_each_cluster_goes_one_way(spark):
    members, leads, stats, pairs = tables(spark)
    got = {(r.cluster_id, r.rsid): r for r in lifecycle.cluster_z_scores(leads, members, None, stats, pairs).collect()}
    assert {k: r.origin for k, r in got.items()} == {("all", "a1"): "associations", ("all", "a2"): "associations", ("file", "f2"): "file", ("file", "f3"): "file",
                                                     ("guess", "g1"): "imputed", ("guess", "g2"): "imputed", ("weak", "w1"): "imputed", ("weak", "w2"): "imputed"}
    z = {k[1]: r.z for k, r in got.items()}
    assert z["a1"] == 2 and z["a2"] == -1 and z["f2"] == pytest.approx(1.959964, abs=1e-5) == -z["f3"] and z["g2"] == pytest.approx(0.9 * 0.5 * 3) and z["w2"] == pytest.approx(-0.9)
    bare = {(r.cluster_id, r.rsid): r for r in lifecycle.cluster_z_scores(leads, members, None, None, pairs).collect()}
    assert bare["file", "f2"].origin == "imputed" and bare["file", "f2"].z == pytest.approx(0.9 * 0.5 * 9) and bare["file", "f3"].z == 0
    assert lifecycle.cluster_z_scores(leads, members.limit(0), None, stats, pairs).collect() == []


def test_one_snp_alone_has_the_whole_posterior(spark):
    one = spark.createDataFrame([("c", "s", 3.0, 0.1), ("d", "t", 1.0, 0.1), ("d", "u", 2.0, 0.1)], "cluster_id string, rsid string, z double, beta double")
    got = {r.snps[0]: r.posterior for r in finemap.posterior(finemap.configurations(one)).collect()}
    assert got["s"] == pytest.approx(1) and got["t"] + got["u"] == pytest.approx(1)


def test_best_association_of_a_lead(spark):
    rows = [("c", "s", 1e-9, None, 0.5), ("c", "s", 1e-12, 0.5, None), ("c", "s", None, None, 0.1), ("c", "u", 0.05, None, -1.0), ("c", "v", 1e-9, None, None)]
    got = {r.rsid: r for r in lifecycle.lead_z_scores(spark.createDataFrame(rows, "cluster_id string, rsid string, pvalue double, odds_ratio double, beta double").where("pvalue is not null")).collect()}
    assert got["s"].z == pytest.approx(-7.1305, abs=1e-3) and got["s"].beta == pytest.approx(-0.693147, abs=1e-5) and got["u"].z == pytest.approx(-1.959964, abs=1e-5) and got["v"].z is None
