"""The wide table in parts: the same rows as its join, without the size of it."""

import pytest
from pyspark.sql import functions as F

from variantloom import plans
from variantloom.operators import filters, output, report

SF = "/root/testdata/sf0.001"


def _same(a, b):
    def key(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.na.fill(-9.0).collect())

    assert key(a) == key(b.select(a.columns)) and a.limit(1).count()


@pytest.fixture(scope="module")
def table(spark):
    near = spark.createDataFrame([("c", "g1", "s1", 1), ("c", "g1", "s2", 2), ("c", "g2", "s1", 1), ("d", "g1", "s3", 3), ("d", "g1", "s4", 4)], "cluster_id string, gwas_snp string, ld_snp_rsID string, pos long")
    genes = spark.createDataFrame([("s1", "B", 0.5), ("s1", "A", 0.5), ("s2", "C", 0.25), ("s3", "A", 0.1)], "ld_snp_rsID string, gene_id string, score double")
    assoc = spark.createDataFrame([("c", "g1", "e1", "p2"), ("c", "g1", "e2", "p1"), ("c", "g2", "e1", "p3"), ("d", "g1", "e1", "p2"), ("d", "g1", "e1", "p2")], "cluster_id string, gwas_snp string, efo string, pmid string")
    return output.WideTable(near, genes, assoc)


COLS = [("gene_id",), ("efo", "pmid"), ("gwas_snp", "efo"), ("ld_snp_rsID", "gwas_snp"), ("gene_id", "efo"), ("ld_snp_rsID", "pos"), ("ld_snp_rsID", "efo"), ("gene_id", "ld_snp_rsID", "score"), ("cluster_id", "gene_id", "pmid", "pos"), ("ld_snp_rsID",)]


@pytest.mark.parametrize("by_cluster", [False, True])
def test_parts_like_their_join(table, by_cluster):
    w = table._replace(genes=table.near.select("cluster_id", "ld_snp_rsID").distinct().join(table.genes, "ld_snp_rsID")) if by_cluster else table
    rows = w.rows().select("cluster_id", "gwas_snp", "ld_snp_rsID", "pos", "gene_id", "score", "efo", "pmid")
    assert rows.count() == 2 * 2 + 2 * 1 + 1 * 2 + 1 * 2
    for cols in COLS:
        _same(rows.select(*cols).distinct(), w.distinct(*cols))
        _same(rows.groupBy(*cols).agg(F.count("*").alias("n")), w.counted(*cols).groupBy(*cols).agg(F.sum("n").alias("n")))
    for order in (["gene_id", "pmid"], ["pmid", "gene_id"], ["pmid", "score", "gene_id"]):
        _same(filters.first_per_group(rows, ["ld_snp_rsID", "gwas_snp"], order).select("ld_snp_rsID", "gwas_snp", *order), w.first(["ld_snp_rsID", "gwas_snp"], order))
    names = ["gene_id", "efo", "gwas_snp"]
    _same(report.id_counts(rows, names), report.id_counts(w, names))
    _same(report.pair_counts(rows, [("gene_id", "efo"), ("efo", "pmid")]), report.pair_counts(w, [("gene_id", "efo"), ("efo", "pmid")]))
    _same(report.top_values(rows, "gene_id"), report.top_values(w, "gene_id"))
    assert report.table_shape(w).first() == (10, 8) == report.table_shape(rows).first()


REPORTS = ["id_counts", "pair_counts", "degree_distribution", "field_histogram", "field_histogram_2d", "evidence_overlap", "first_per_group", "top_values", "table_shape",
           "check_no_trans", "check_in_range", "check_regex", "check_unique_per_group", "check_positive", "check_in_set", "check_not_in_range"]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_do_not_join_the_whole_table(spark, monkeypatch, name):
    monkeypatch.setattr(output.WideTable, "rows", None)
    assert plans.QUERIES[name](spark, SF).columns


def test_assembled_rows_are_not_shuffled(spark):
    """Above the join of LD SNPs and genes there is no exchange: notes and associations are met before."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plans.QUERIES["assemble_output"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Join" in plan[: plan.index("Exchange")]
