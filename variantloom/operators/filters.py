"""Row filters and small projections on associations and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Genome-wide significance, and ontologies by prefix of the short form.
MAIN_CHROMS = [*(str(i) for i in range(1, 23)), "X", "Y"]
GENOME_WIDE = 5e-8
ONTOLOGIES = {"EFO_": "efo", "HP_": "hp", "GO_": "go", "Orphanet_": "ordo", "CL_": "cl", "CHEBI_": "chebi"}
#: The major histocompatibility region and an inversion.
BLACKLIST = [("6", 28477797, 33448354), ("17", 44165260, 44784489)]


def match_trait(assoc: DataFrame, diseases: list[str] = (), iris: list[str] = ()) -> DataFrame:
    """Adds efo: the row's first IRI among the wanted ones; else, if its trait is a wanted disease, its first IRI. Others are dropped."""
    wanted = F.array(*[F.lit(i) for i in iris]).cast("array<string>")
    first = F.get(F.filter("iris", lambda i: F.array_contains(wanted, i)), F.lit(0))
    by_name = F.col("reported_trait").isin(list(diseases)) if diseases else F.lit(False)
    return assoc.where(first.isNotNull() | by_name).withColumn("efo", F.coalesce(first, F.get("iris", F.lit(0))))


def sane_associations(assoc: DataFrame, bayesian: bool = False) -> DataFrame:
    """p > 0 and size > 0 or unknown; in Bayesian use, odds ratio or beta must be known."""
    out = assoc.where("pvalue > 0 and (sample_size is null or sample_size > 0)")
    return out.where("odds_ratio is not null or beta_coefficient is not null") if bayesian else out


def genome_wide(df: DataFrame, cutoff: float = GENOME_WIDE) -> DataFrame:
    return df.where(F.col("pvalue") < cutoff)


def protein_coding_only(evidence: DataFrame, genes: DataFrame) -> DataFrame:
    """Evidence rows of known protein-coding genes."""
    return evidence.join(genes.where("biotype = 'protein_coding'").select("gene_id"), "gene_id", "left_semi").select(evidence.columns)


def clean_pmid(col: str) -> Column:
    """PMID<digits>.. as it is, <digits>.. with PMID before it, PUBMEDID: replaced by PMID; else null."""
    c = F.col(col)
    return F.when(c.rlike(r"^PMID\d+"), c).when(c.rlike(r"^\d+"), F.concat(F.lit("PMID"), c)).when(c.rlike(r"^PUBMEDID:\d+"), F.regexp_replace(c, "PUBMEDID:", "PMID"))


def ld_filter(rows: DataFrame, ld: DataFrame, r2: float = 0.7) -> DataFrame:
    """Adds r2 of (rsid, gwas_rsid) from ld (rsid_a, rsid_b, r2; either order): 1 for the SNP itself, 0 if unknown; keeps r2 or more."""
    low, high = (lambda a, b: F.when(F.col(a) <= F.col(b), F.col(a)).otherwise(F.col(b))), (lambda a, b: F.when(F.col(a) <= F.col(b), F.col(b)).otherwise(F.col(a)))
    best = ld.select(low("rsid_a", "rsid_b").alias("_lo"), high("rsid_a", "rsid_b").alias("_hi"), "r2").groupBy("_lo", "_hi").agg(F.max("r2").alias("r2"))
    found = rows.withColumns({"_lo": low("rsid", "gwas_rsid"), "_hi": high("rsid", "gwas_rsid")}).join(best, ["_lo", "_hi"], "left").drop("_lo", "_hi")
    return found.withColumn("r2", F.when(F.col("rsid") == F.col("gwas_rsid"), 1.0).otherwise(F.coalesce("r2", F.lit(0.0)))).where(F.col("r2") >= r2)


def drop_tiny_clusters(members: DataFrame, least: int = 10) -> DataFrame:
    big = members.groupBy("cluster_id").count().where(F.col("count") >= least).select("cluster_id")
    return members.join(big, "cluster_id", "left_semi").select(members.columns)


def efo_short_form(col: str) -> Column:
    return F.regexp_replace(col, "^.*/", "")


def ontology_of(col: str) -> Column:
    out = F.lit(None).cast("string")
    for prefix, name in reversed(ONTOLOGIES.items()):
        out = F.when(F.col(col).startswith(prefix), name).otherwise(out)
    return out


def first_per_group(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def ontology_label(df: DataFrame, terms: DataFrame, col: str = "efo") -> DataFrame:
    """Adds label of the term (terms: efo, label); N/A stays N/A."""
    t = terms.groupBy(F.col("efo").alias(col)).agg(F.min("label").alias("label"))
    return df.join(t, col, "left").withColumn("label", F.when(F.col(col) == "N/A", "N/A").otherwise(F.col("label")))


def drop_blacklisted(clusters: DataFrame, regions: list[tuple[str, int, int]] | None = None) -> DataFrame:
    """Rows (cluster_id, chrom, pos, ..) of the clusters without a SNP in a region, half-open."""
    inside = F.lit(False)
    for chrom, start, end in BLACKLIST if regions is None else regions:
        inside |= (F.col("chrom") == chrom) & (F.col("pos") >= start) & (F.col("pos") < end)
    bad = clusters.where(inside).select("cluster_id").distinct()
    return clusters.join(bad, "cluster_id", "left_anti").select(clusters.columns)


def main_assembly_only(df: DataFrame, col: str = "chrom") -> DataFrame:
    return df.where(F.col(col).isin(MAIN_CHROMS))
