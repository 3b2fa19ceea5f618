"""Evidence that links SNPs to genes, and its scores.

Evidence tables are long: rsid, gene_id (none in SNP-level evidence), source, score, and tissue or terms where known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import dealt
from .intervals import overlap

#: Sources in the order of the result table, those that count with their weights, and the tissues.
CIS_SOURCES = ["GTEx", "VEP", "Fantom5", "DHS", "PCHiC", "Nearest"]
REG_SOURCES = ["Regulome", "VEP_reg", "GERP"]
WEIGHTS = {"Regulome": 1, "VEP": 1, "GTEx": 1, "Fantom5": 1, "DHS": 1, "PCHiC": 1, "Nearest": 1}
TISSUES = [
    "Adipose_Subcutaneous", "Adipose_Visceral_Omentum", "Adrenal_Gland", "Artery_Aorta", "Artery_Coronary", "Artery_Tibial", "Brain_Anterior_cingulate_cortex_BA24",
    "Brain_Caudate_basal_ganglia", "Brain_Cerebellar_Hemisphere", "Brain_Cerebellum", "Brain_Cortex", "Brain_Frontal_Cortex_BA9", "Brain_Hippocampus", "Brain_Hypothalamus",
    "Brain_Nucleus_accumbens_basal_ganglia", "Brain_Putamen_basal_ganglia", "Breast_Mammary_Tissue", "Cells_EBV-transformed_lymphocytes", "Cells_Transformed_fibroblasts",
    "Colon_Sigmoid", "Colon_Transverse", "Esophagus_Gastroesophageal_Junction", "Esophagus_Mucosa", "Esophagus_Muscularis", "Heart_Atrial_Appendage", "Heart_Left_Ventricle",
    "Liver", "Lung", "Muscle_Skeletal", "Nerve_Tibial", "Ovary", "Pancreas", "Pituitary", "Prostate", "Skin_Not_Sun_Exposed_Suprapubic", "Skin_Sun_Exposed_Lower_leg",
    "Small_Intestine_Terminal_Ileum", "Spleen", "Stomach", "Testis", "Thyroid", "Uterus", "Vagina", "Whole_Blood"]


def apply_fdr_model(pairs: DataFrame, fdr: DataFrame, width: int = 10_000, most: int = 500_000) -> DataFrame:
    """Pairs (chrom, pos, gene_chrom, tss, ..) -> adds score = 1 - fdr of the distance's bin (fdr: bin, fdr); rows on other
    chromosomes, beyond `most`, in a missing bin or with score 0 are dropped."""
    near = pairs.where("chrom = gene_chrom").withColumn("_d", F.abs(F.col("pos") - F.col("tss"))).where(F.col("_d") <= most)
    near = near.withColumn("bin", F.floor(F.col("_d") / width).cast("int"))
    return near.join(fdr.select("bin", "fdr"), "bin").withColumn("score", 1 - F.col("fdr")).where("score != 0").drop("bin", "fdr", "_d")


def pchic_evidence(snps: DataFrame, bed: DataFrame, above: float = 5.0) -> DataFrame:
    return overlap(snps, bed.where(F.col("score") > above)).select("rsid", "gene_id", "score", F.lit("PCHiC").alias("source"))


def regulome_evidence(snps: DataFrame, bed: DataFrame) -> DataFrame:
    score = F.when(F.substring("category", 1, 1).isin("1", "2"), 1.0).otherwise(0.5)
    return overlap(snps, bed).select("rsid", score.alias("score"), F.lit("Regulome").alias("source"))


def fdr_evidence(snps: DataFrame, bed: DataFrame, genes: DataFrame, fdr: DataFrame, source: str) -> DataFrame:
    """Overlaps of SNPs with intervals (gene_id), scored by the distance to the gene's TSS."""
    g = genes.select("gene_id", F.col("chrom").alias("gene_chrom"), "tss")
    return apply_fdr_model(overlap(snps, bed).join(g, "gene_id"), fdr).select("rsid", "gene_id", "score", F.lit(source).alias("source"))


def cis_evidence(evidence: DataFrame, genes: DataFrame) -> DataFrame:
    """Per (rsid, gene_id) of protein-coding genes: the sorted (source, score) list."""
    coding = genes.where("biotype = 'protein_coding'").select("gene_id")
    return evidence.join(coding, "gene_id", "left_semi").groupBy("rsid", "gene_id").agg(F.array_sort(F.collect_list(F.struct("source", "score"))).alias("evidence"))


def v2g_scores(cis: DataFrame, reg: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Per (rsid, gene_id) in cis: the largest score of each source (PCHiC at most 1), SNP-level sources of reg included,
    and score, their weighted sum. GERP and VEP_reg have columns but no weight. Absent sources are 0. All is dealt by SNP, once."""
    weights = WEIGHTS if weights is None else weights
    best = lambda df, keys, names: df.groupBy(*keys).agg(*[F.max(F.when(F.col("source") == s, F.col("score"))).alias(s) for s in names])
    both = best(dealt(cis, "rsid"), ["rsid", "gene_id"], CIS_SOURCES).join(best(reg, ["rsid"], REG_SOURCES), "rsid", "left")
    cols = {s: F.coalesce(F.col(s).cast("double"), F.lit(0.0)) for s in CIS_SOURCES + REG_SOURCES}
    out = both.withColumns(cols | {"PCHiC": F.least(cols["PCHiC"], F.lit(1.0))})
    total = F.lit(0.0)
    for s in CIS_SOURCES + REG_SOURCES:
        if weights.get(s):
            total = total + F.col(s) * weights[s]
    return out.withColumn("score", total)


def vep_stats(pairs: DataFrame, cis: DataFrame) -> DataFrame:
    """Adds VEP_count, VEP_sum, VEP_mean to (rsid, gene_id) rows; 0 without VEP evidence."""
    v = cis.where("source = 'VEP'").groupBy("rsid", "gene_id").agg(F.count("*").alias("VEP_count"), F.sum("score").alias("VEP_sum"), F.avg("score").alias("VEP_mean"))
    out = pairs.join(v, ["rsid", "gene_id"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("VEP_count", "VEP_sum", "VEP_mean")})


def vep_terms(vep: DataFrame) -> DataFrame:
    """Per (rsid, gene_id): distinct terms in order, joined by comma; N/A if none."""
    terms = vep.groupBy("rsid", "gene_id").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))), ",").alias("vep_terms"))
    return terms.withColumn("vep_terms", F.when(F.col("vep_terms") == "", "N/A").otherwise(F.col("vep_terms")))


def eqtl_index(eqtl: DataFrame, *order: str) -> DataFrame:
    """One row per (gene_id, tissue, rsid): the last by the order columns (p value, then beta, by default). Dealt by SNP."""
    order = order or ("pvalue", "beta")
    rows = dealt(eqtl, "rsid").groupBy("rsid", "gene_id", "tissue")
    if len(order) == 1:
        return rows.agg(F.max(order[0]).alias(order[0])).select("gene_id", "tissue", "rsid", *order)
    return rows.agg(F.max(F.struct(*order)).alias("x")).select("gene_id", "tissue", "rsid", *[F.col(f"x.{c}").alias(c) for c in order])


def tissue_columns(index: DataFrame, tissues: list[str] | None = None, compat: bool = False) -> DataFrame:
    """Per (gene_id, rsid) a column per tissue: 1 - p of its eQTL (p itself with compat), 0 where there is none."""
    tissues = TISSUES if tissues is None else tissues
    value = F.col("pvalue") if compat else 1 - F.col("pvalue")
    return index.groupBy("gene_id", "rsid").agg(*[F.coalesce(F.max(F.when(F.col("tissue") == t, value)), F.lit(0.0)).alias(t) for t in tissues])


def population_mafs(reg: DataFrame, population: str) -> DataFrame:
    """rsid, maf of the population in the mafs maps, 0 where unknown (largest if there are several rows)."""
    return reg.groupBy("rsid").agg(F.coalesce(F.max(F.try_element_at("mafs", F.lit(population))), F.lit(0.0)).alias("maf"))


def annotation_matrix(evidence: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Per rsid a 0/1 column for each source but GTEx: whether it has a positive score."""
    names = [s for s in (sources or CIS_SOURCES + REG_SOURCES) if s != "GTEx"]
    return evidence.groupBy("rsid").agg(*[F.max(F.when((F.col("source") == s) & (F.col("score") > 0), 1).otherwise(0)).alias(s) for s in names])


def drop_gtex(cis: DataFrame) -> DataFrame:
    """Evidence without GTEx rows, as in scoring; a pair with GTEx rows alone keeps one row of source none and score 0."""
    kept = F.collect_list(F.when(F.col("source") != "GTEx", F.struct("source", "score")))
    none = F.array(F.struct(F.lit("none").alias("source"), F.lit(0.0).alias("score")))
    pairs = dealt(cis.select("rsid", "gene_id", "source", "score"), "rsid", "gene_id").groupBy("rsid", "gene_id").agg(kept.alias("e"))
    return pairs.select("rsid", "gene_id", F.explode(F.when(F.size("e") > 0, F.col("e")).otherwise(none)).alias("e")).select("rsid", "gene_id", "e.source", "e.score")
