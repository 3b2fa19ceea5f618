"""Interval, nearest and location joins, all as equi-joins on (chromosome, bin)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import MAIN_CHROMS, main_assembly_only


def _bin(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width)).cast("bigint")


def overlap(snps: DataFrame, bed: DataFrame, width: int = 5_000) -> DataFrame:
    """SNPs (chrom, pos 1-based) with the columns of each interval (chrom, bstart, bend) that covers them: bstart < pos <= bend.

    A SNP lies in one bin and an interval is repeated for each bin that it meets, so no pair comes twice."""
    s = snps.withColumn("_bin", _bin(F.col("pos"), width))
    b = bed.where("bend > bstart").withColumn("_bin", F.explode(F.sequence(_bin(F.col("bstart") + 1, width), _bin(F.col("bend"), width))))
    return s.join(b, ["chrom", "_bin"]).where("bstart < pos and pos <= bend").drop("_bin")


def nearest(snps: DataFrame, tss: DataFrame, most: int = 100_000) -> DataFrame:
    """Each SNP with its closest TSS (all on ties) at less than `most` bases, and the distance.

    TSS are gathered by the bins on either side of theirs, as one sorted list of places a bin: a SNP meets its bin's list
    once, finds the least distance in it, and only then joins the TSS at that distance, so no candidate pair is shuffled."""
    t = tss.withColumn("_tss_bin", F.explode(F.sequence(_bin(F.col("tss"), most) - 1, _bin(F.col("tss"), most) + 1)))
    places = t.groupBy("chrom", "_tss_bin").agg(F.collect_set("tss").alias("_places"))
    s = snps.withColumn("_tss_bin", _bin(F.col("pos"), most)).join(places, ["chrom", "_tss_bin"])
    s = s.withColumn("distance", F.expr("array_min(transform(_places, x -> abs(x - pos)))")).where(F.col("distance") < most).drop("_places", "_tss_bin")
    at = s.withColumn("tss", F.explode(F.expr("if(distance = 0, array(pos), array(pos - distance, pos + distance))")))
    return at.join(tss, ["chrom", "tss"])


def locate_snps(rsids: DataFrame, snp_ref: DataFrame) -> DataFrame:
    """rsid -> chrom, pos through names and synonyms of snp_ref (name, synonyms, mappings: array of (chrom, start, end)).

    The last mapping on a main chromosome is used; pos is its midpoint, rounded down."""
    main = ", ".join(f"'{c}'" for c in MAIN_CHROMS)
    last = F.expr(f"try_element_at(filter(mappings, m -> m.chrom in ({main})), -1)")
    at = snp_ref.select("name", "synonyms", last.alias("m")).where("m is not null")
    names = at.select(F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("synonyms", F.array().cast("array<string>"))))).alias("rsid"), "name", "m")
    best = names.groupBy("rsid").agg(F.max_by("m", F.struct((F.col("name") == F.col("rsid")).alias("own"), "name")).alias("m"))
    return rsids.select("rsid").distinct().join(best, "rsid").select("rsid", "m.chrom", F.expr("cast(floor((m.start + m.end) / 2) as bigint)").alias("pos"))


def resolve_genes(df: DataFrame, gene_ref: DataFrame, col: str = "gene") -> DataFrame:
    """Adds gene_id, gene_name, gene_chrom, tss and biotype, the gene given by stable id or by symbol; unknown genes are dropped.

    gene_ref: gene_id, name, chrom, start, end, strand, biotype. The TSS is the start on the + strand, else the end."""
    g = gene_ref.select("gene_id", F.col("name").alias("gene_name"), F.col("chrom").alias("gene_chrom"), F.when(F.col("strand") > 0, F.col("start")).otherwise(F.col("end")).alias("tss"), "biotype")
    keys = g.select(F.col("gene_id").alias(col), *g.columns).unionByName(
        g.join(g.select(F.col("gene_id").alias("gene_name")), "gene_name", "left_anti").groupBy("gene_name").agg(F.min(F.struct(*g.columns)).alias("g")).select(F.col("gene_name").alias(col), "g.*"))
    return df.join(keys, col)


def mean_signal(snps: DataFrame, signal: DataFrame) -> DataFrame:
    """rsid, score: the length-weighted mean of signal (chrom, bstart, bend, value) over [pos - 1, pos + 1), NaN left out."""
    clean = signal.where("not isnan(value)")
    spots = snps.withColumn("_at", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("pos", F.col("pos") + F.col("_at"))
    return overlap(spots, clean).groupBy("rsid").agg(F.avg("value").alias("score"))


def add_grch38(df: DataFrame, snp38: DataFrame, gene38: DataFrame) -> DataFrame:
    """Adds the second assembly's places of the SNP and gene; rows without one, or off the main chromosomes, are dropped."""
    s = snp38.select("rsid", F.col("chrom").alias("snp38_chrom"), F.col("pos").alias("snp38_pos"))
    g = gene38.select("gene_id", F.col("chrom").alias("gene38_chrom"), F.col("tss").alias("gene38_tss"))
    return main_assembly_only(main_assembly_only(df.join(s, "rsid").join(g, "gene_id"), "snp38_chrom"), "gene38_chrom")
