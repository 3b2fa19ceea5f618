"""Preparation of reference data from raw text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import overlap

SUPERPOPULATIONS = ("AFR", "AMR", "EAS", "EUR", "SAS")


def _fields(lines: DataFrame, sep: str = "\t") -> DataFrame:
    return lines.withColumn("f", F.split("value", sep))


def pad_columns(lines: DataFrame, n: int) -> DataFrame:
    """Tab lines with at least n fields, the added ones empty."""
    return _fields(lines).select(F.concat_ws("\t", F.concat("f", F.array_repeat(F.lit(""), F.greatest(F.lit(0), n - F.size("f"))))).alias("value"))


def prefilter_pvalue(lines: DataFrame, p_max: float = 1e-4, field: int = 11) -> DataFrame:
    """Tab lines whose field (from 1) is a number below p_max."""
    return _fields(lines).where(F.get("f", F.lit(field - 1)).try_cast("double") < p_max).select("value")


def unquoted(col: str):
    return F.regexp_replace(col, '^("+)(.*?)("+)$', "$2")


def map_phenotype(df: DataFrame, col: str, mapping: DataFrame) -> DataFrame:
    """Adds `efo`: the terms of the phenotype (its outer quotes stripped) in mapping (trait, efo), joined by comma, else N/A.

    The mapping is reduced to one row a trait before the join; Spark broadcasts it if it is small."""
    terms = mapping.groupBy(unquoted("trait").alias("_trait")).agg(F.concat_ws(",", F.array_sort(F.collect_list("efo"))).alias("efo"))
    return df.withColumn("_trait", unquoted(col)).join(terms, "_trait", "left").drop("_trait").withColumn("efo", F.coalesce("efo", F.lit("N/A")))


def csv_to_tsv(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Quoted CSV lines -> tab lines."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return lines.select(F.from_csv("value", schema, {"quote": '"', "escape": '"'}).alias("r")).select(
        F.concat_ws("\t", *[F.coalesce(F.col(f"r.`{c}`"), F.lit("")) for c in columns]).alias("value"))


def prep_gwas_db(lines: DataFrame) -> DataFrame:
    """The first six fields of lines with more than five."""
    return _fields(lines).where("size(f) > 5").select(F.concat_ws("\t", F.slice("f", 1, 6)).alias("value"))


def prep_fantom5(names: DataFrame) -> DataFrame:
    """Name fields "coords;..;symbol;..;FDR:x" in `value` -> chrom, bstart, bend, symbol, fdr."""
    f = F.split("value", ";")
    coords = r"^(?:chr)?([^:]+):(\d+)-(\d+)$"
    return names.where(F.col("value").contains("FDR:")).select(f.alias("f")).select(
        F.regexp_extract(F.col("f")[0], coords, 1).alias("chrom"), F.regexp_extract(F.col("f")[0], coords, 2).try_cast("bigint").alias("bstart"),
        F.regexp_extract(F.col("f")[0], coords, 3).try_cast("bigint").alias("bend"), F.get("f", F.lit(2)).alias("symbol"),
        F.regexp_replace(F.get("f", F.lit(4)), "FDR:", "").try_cast("double").alias("fdr")).where("bstart is not null")


def prep_dhs(lines: DataFrame) -> DataFrame:
    """Fields 5, 6, 7, 4, 8 as chrom (without chr), bstart, bend, symbol, score."""
    return _fields(lines).where("size(f) >= 8").select(
        F.regexp_replace(F.col("f")[4], "^chr", "").alias("chrom"), F.col("f")[5].try_cast("bigint").alias("bstart"), F.col("f")[6].try_cast("bigint").alias("bend"),
        F.col("f")[3].alias("symbol"), F.col("f")[7].try_cast("double").alias("score"))


def prep_regulome(*categories: DataFrame) -> DataFrame:
    """Tab lines chrom, pos, .., .., category of each category file -> one-base intervals."""
    out = None
    for lines in categories:
        part = _fields(lines).where("size(f) >= 5").select(
            F.regexp_replace(F.col("f")[0], "^chr", "").alias("chrom"), F.col("f")[1].try_cast("bigint").alias("bstart"),
            (F.col("f")[1].try_cast("bigint") + 1).alias("bend"), F.col("f")[4].alias("category"))
        out = part if out is None else out.unionByName(part)
    return out


def prep_pchic(lines: DataFrame, tss: DataFrame) -> DataFrame:
    """Tab lines of bait chrom, start, end and "chr:start-end,score" -> the other end, score and gene of each TSS in the bait."""
    other = r"^(?:chr)?([^:]+):(\d+)-(\d+),(.*)$"
    bait = _fields(lines).where("size(f) >= 4").select(
        F.regexp_replace(F.col("f")[0], "^chr", "").alias("chrom"), F.col("f")[1].cast("bigint").alias("bstart"), F.col("f")[2].cast("bigint").alias("bend"),
        *[F.regexp_extract(F.col("f")[3], other, i).alias(n) for i, n in enumerate(("other_chrom", "other_start", "other_end", "score"), 1)])
    return overlap(tss.select("chrom", F.col("tss").alias("pos"), "gene_id"), bait).select(
        F.col("other_chrom").alias("chrom"), F.col("other_start").cast("bigint").alias("bstart"), F.col("other_end").cast("bigint").alias("bend"), F.col("score").cast("double").alias("score"), "gene_id")


def prep_tss(gtf: DataFrame) -> DataFrame:
    """GTF lines of protein-coding transcripts -> chrom, bstart, bend (one base at the strand's start), gene_id."""
    f = _fields(gtf).where(F.col("value").contains("protein_coding") & (F.size("f") >= 9)).where("f[2] = 'transcript' and f[6] in ('+', '-')")
    at = F.when(F.col("f")[6] == "+", F.col("f")[3]).otherwise(F.col("f")[4]).cast("bigint")
    return f.select(F.col("f")[0].alias("chrom"), at.alias("bstart"), (at + 1).alias("bend"), F.regexp_extract("value", 'gene_id "([^"]+)"', 1).alias("gene_id"))


def fit_fdr_model(bed: DataFrame, genes: DataFrame, width: int = 10_000, most: int = 500_000) -> DataFrame:
    """Interval midpoints against the TSS of their gene -> bin, n, fdr = 0.99 * n of the last bin / n; far or other chromosomes do not count."""
    pairs = bed.join(genes.select("gene_id", F.col("chrom").alias("gene_chrom"), "tss"), "gene_id").where("chrom = gene_chrom")
    d = pairs.select(F.expr("abs(cast(floor((bstart + bend) / 2) as bigint) - tss)").alias("d")).where(F.col("d") < most)
    counts = d.groupBy(F.expr(f"cast(floor(d / {width}) as int)").alias("bin")).agg(F.count("*").alias("n"))
    last = counts.agg(F.coalesce(F.max(F.when(F.col("bin") == (most - 1) // width, F.col("n"))), F.lit(0)).alias("last"))
    return counts.crossJoin(F.broadcast(last)).select("bin", "n", (F.col("last") * F.lit(0.99) / F.col("n")).alias("fdr"))


def ontology_terms(*lists: DataFrame) -> DataFrame:
    """Distinct terms of comma lists in `value`, without blanks, empty ones and N/A."""
    out = None
    for df in lists:
        part = df.select(F.explode(F.split(F.regexp_replace("value", " ", ""), ",")).alias("term"))
        out = part if out is None else out.unionByName(part)
    return out.where("term not in ('', 'N/A')").distinct()


def population_samples(panel: DataFrame, population: str) -> DataFrame:
    if population not in SUPERPOPULATIONS:
        raise ValueError(f"unknown population {population}")
    return panel.where(F.col("super_pop") == population).select("sample_id")


def filter_common_biallelic(geno: DataFrame, maf: float = 0.01) -> DataFrame:
    """Calls of sites whose allele frequency (over the calls given) is maf or more for both alleles."""
    f = geno.groupBy("rsid").agg((F.sum("dosage") / (2 * F.count("dosage"))).alias("f"))
    return geno.join(f.where(F.least(F.col("f"), 1 - F.col("f")) >= maf).select("rsid"), "rsid", "left_semi").select(geno.columns)
