"""Cluster results and the wide result table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring
from ..functions.tables import dealt, stored
from . import evidence as ev
from .filters import clean_pmid, efo_short_form, first_per_group, ld_filter, main_assembly_only


def gwas_snps(assoc: DataFrame, keep: str = "min") -> DataFrame:
    """One association per rsid: that with the smallest p value (the largest with keep='max'); ties by the other columns."""
    sign = F.asc if keep == "min" else F.desc
    rest = [c for c in assoc.columns if c not in ("rsid", "pvalue")]
    w = Window.partitionBy("rsid").orderBy(sign("pvalue"), *rest)
    return assoc.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def gene_rank(scores: DataFrame, *keys: str) -> DataFrame:
    """Adds rank of the score among the SNP's genes: the number of genes with at least this score."""
    w = Window.partitionBy(*(keys or ("rsid",))).orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, 0)
    return scores.withColumn("rank", F.count("*").over(w).cast("int"))


def top_gwas_hit(leads: DataFrame, order: str = "min") -> DataFrame:
    """One lead per cluster_id: the smallest p value (the largest with order='max'), then rsid."""
    value = F.struct("pvalue", "rsid") if order == "min" else F.struct(-F.col("pvalue"), "rsid")
    best = leads.groupBy("cluster_id").agg(F.min(value).alias("x"))
    return best.select("cluster_id", F.col("x.rsid").alias("rsid"), F.abs(F.col("x")[("pvalue" if order == "min" else "col1")]).alias("pvalue"))


def normalise_pics(probabilities: DataFrame) -> DataFrame:
    """probability over the sum of its cluster, as pics."""
    total = probabilities.groupBy("cluster_id").agg(F.sum("probability").alias("_sum"))
    return probabilities.join(total, "cluster_id").withColumn("pics", F.col("probability") / F.col("_sum")).drop("_sum")


def cluster_sample_size(leads: DataFrame) -> DataFrame:
    """cluster_id, n: the mean over its SNPs of their largest sample size, rounded down."""
    per = leads.groupBy("cluster_id", "rsid").agg(F.max("sample_size").alias("s"))
    return per.groupBy("cluster_id").agg(F.floor(F.avg("s")).cast("bigint").alias("n"))


def cluster_extent(members: DataFrame) -> DataFrame:
    """cluster_id, chrom, first, last, label."""
    e = members.groupBy("cluster_id", "chrom").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    return e.withColumn("label", F.format_string("GWAS_Cluster_%s:%d-%d", "chrom", "first", "last"))


def cluster_genes(ld_to_top: DataFrame, top: DataFrame, v2g: DataFrame, places: int | None = None) -> DataFrame:
    """LD to the top (cluster_id, rsid, ld), top (cluster_id, pvalue), scores (rsid, gene_id, score) -> cluster_id, rsid,
    gene_id, ld, pics, v2g, score. The probabilities are normalised over all LD SNPs, with or without genes.
    With places the figures are rounded: those of an LD SNP or of a score before each SNP is repeated for its genes."""
    told = lambda c: F.col(c) if places is None else F.round(c, places)
    p = ld_to_top.join(top.select("cluster_id", (-F.log10("pvalue")).alias("_l")), "cluster_id")
    p = normalise_pics(p.withColumn("probability", scoring.pics_probability(F.col("ld"), F.col("_l")))).drop("_l", "probability")
    p = p.select("cluster_id", "rsid", told("ld").alias("ld"), told("pics").alias("pics"), F.col("ld").alias("_ld"), F.col("pics").alias("_pics"))
    g = p.join(v2g.select("rsid", "gene_id", told("score").alias("v2g"), F.col("score").alias("_v2g")), "rsid")
    g = g.withColumn("score", scoring.total_score(F.col("_pics"), F.col("_v2g") * F.col("_ld")))
    return g.select("cluster_id", "rsid", "gene_id", "ld", "pics", "v2g", told("score").alias("score"))


def sort_by_score(genes: DataFrame) -> DataFrame:
    return genes.orderBy("score", "cluster_id", "gene_id", "rsid")


POPULATIONS = ["afr", "amr", "eas", "eur", "sas", "gnomad", "gnomad_sas", "gnomad_oth", "gnomad_asj", "gnomad_nfe", "gnomad_afr", "gnomad_amr", "gnomad_fin", "gnomad_eas"]


PLACE = ["chrom", "pos", "GRCh38_chrom", "GRCh38_pos"]
GENE = ["gene_symbol", "gene_id", "gene_chrom", "gene_tss", "GRCh38_gene_chrom", "GRCh38_gene_pos"]
VEP = ["vep_terms", "vep_sum", "vep_mean"]


def _noted(scores: DataFrame, eqtl: DataFrame, terms: DataFrame, vep: DataFrame, tissues: list[str], places: int | None = None) -> DataFrame:
    """A row a SNP and gene that scores have: rsid, gene_id, score, sources, VEP, GTEx_ columns; one grouping of all four
    tables, dealt by SNP. With places the figures are rounded, scores before the grouping and notes after it: all in one
    step would be a method beyond what the JVM compiles."""
    figures = ["score", *ev.CIS_SOURCES, *ev.REG_SOURCES]
    told = lambda c: c if places is None else scoring.half_up(c, places)
    keyed = [scores.select("rsid", "gene_id", F.struct(*[told(F.col(c)).alias(c) for c in figures]).alias("_scores")), dealt(terms.select("rsid", "gene_id", "vep_terms"), "rsid"),
             dealt(vep.select("rsid", "gene_id", F.struct("VEP_sum", "VEP_mean").alias("_vep")), "rsid"), eqtl.select("rsid", "gene_id", "tissue", (1 - F.col("pvalue")).alias("_value"))]
    every = keyed[0]
    for other in keyed[1:]:
        every = every.unionByName(other, allowMissingColumns=True)
    by_tissue = [F.max(F.when(F.col("tissue") == t, F.col("_value"))).alias(f"GTEx_{t}") for t in tissues]
    rows = every.groupBy("rsid", "gene_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("_scores", "vep_terms", "_vep")], *by_tissue).where("_scores is not null")
    absent = {"vep_terms": (F.col("vep_terms"), "N/A"), "vep_sum": (F.col("_vep.VEP_sum"), 0.0), "vep_mean": (F.col("_vep.VEP_mean"), 0.0)} | {f"GTEx_{t}": (F.col(f"`GTEx_{t}`"), 0.0) for t in tissues}
    rows = rows.select("rsid", "gene_id", "_scores.*", *[F.coalesce(c, F.lit(x)).alias(name) for name, (c, x) in absent.items()])
    return rows.withColumns({c: told(F.col(f"`{c}`")) for c in absent if c != "vep_terms"})


def _gene_places(genes: DataFrame, gene38: DataFrame, max_broadcast: int = 500_000) -> DataFrame:
    """Genes with both places, on main chromosomes of the second assembly; sent to all tasks while they are few."""
    g = genes.select("gene_id", F.col("name").alias("gene_symbol"), F.col("chrom").alias("gene_chrom"), F.col("tss").alias("gene_tss"))
    g = main_assembly_only(g.join(gene38.select("gene_id", F.col("chrom").alias("GRCh38_gene_chrom"), F.col("tss").alias("GRCh38_gene_pos")), "gene_id"), "GRCh38_gene_chrom")
    return F.broadcast(g) if genes.count() <= max_broadcast else g


def _snp38(snp38: DataFrame) -> DataFrame:
    return main_assembly_only(snp38.select("rsid", F.col("chrom").alias("GRCh38_chrom"), F.col("pos").alias("GRCh38_pos")), "GRCh38_chrom")


def _frequencies(mafs: DataFrame) -> DataFrame:
    return mafs.select("rsid", *[F.try_element_at("mafs", F.lit(p)).alias(p) for p in POPULATIONS])


def snp_output(snps: DataFrame, scores: DataFrame, genes: DataFrame, eqtl: DataFrame, mafs: DataFrame, terms: DataFrame, vep: DataFrame,
               snp38: DataFrame, gene38: DataFrame, tissues: list[str] | None = None, max_broadcast: int = 500_000, places: int | None = None) -> DataFrame:
    """The table of single SNPs (rsid, chrom, pos): a row for each gene that a SNP has a score for, without clusters.

    Scores, VEP notes and eQTLs, all dealt by SNP, become one row a SNP and gene by one grouping; what belongs to a SNP
    alone is put together before it meets them in the same partitions. Up to max_broadcast genes are sent to all tasks,
    and then no wide row is shuffled. With places the figures are rounded."""
    tissues = ev.TISSUES if tissues is None else tissues
    rows = _noted(scores, eqtl, terms, vep, tissues, places)
    at = main_assembly_only(snps.select("rsid", "chrom", "pos").distinct()).join(_snp38(snp38).hint("merge"), "rsid").join(_frequencies(mafs).hint("merge"), "rsid", "left")
    out = rows.join(at.hint("merge"), "rsid").join(_gene_places(genes, gene38, max_broadcast), "gene_id")
    return out.select(F.col("rsid").alias("snp_rsID"), *PLACE, *POPULATIONS, *GENE, "score", *VEP, *[f"`GTEx_{t}`" for t in tissues], *ev.CIS_SOURCES, *ev.REG_SOURCES)


PAIR, LINK = ["cluster_id", "gwas_snp"], "ld_snp_rsID"


class WideTable(NamedTuple):
    """The wide table as the three tables whose join it is, so that what needs a part of it does not join all.

    near: LD SNPs of GWAS SNPs that have associations (cluster_id, gwas_snp, ld_snp_rsID and what belongs to the pair);
    genes: a row an LD SNP and gene (ld_snp_rsID, gene_id, ..), by cluster too if it has cluster_id; assoc: associations
    (cluster_id, gwas_snp, ..)."""

    near: DataFrame
    genes: DataFrame
    assoc: DataFrame

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.near.columns, *self.genes.columns, *self.assoc.columns]))

    def _link(self) -> list[str]:
        return [c for c in ("cluster_id", LINK) if c in self.genes.columns]

    def rows(self) -> DataFrame:
        """All rows: associations meet the LD SNPs first, so that no row with genes is shuffled."""
        return self.near.join(self.assoc, PAIR).join(self.genes, self._link())

    def written(self) -> WideTable:
        """The same with near and genes written, for several uses."""
        return WideTable(stored(self.near, "near"), stored(self.genes, "genes"), self.assoc)

    def _split(self, cols: tuple[str, ...]) -> tuple[list[str], list[str], list[str]]:
        of_near = [c for c in cols if c in self.near.columns]
        of_assoc = [c for c in cols if c in self.assoc.columns and c not in of_near]
        return of_near, of_assoc, [c for c in cols if c not in of_near + of_assoc]

    def counted(self, *cols: str) -> DataFrame:
        """cols and n, the number of rows with them: GWAS SNPs and associations are summed up for each LD SNP before it
        meets its genes. The same values may come in several rows, each with its share of n."""
        of_near, of_assoc, of_gene = self._split(cols)
        a = self.assoc.groupBy(*PAIR, *of_assoc).agg(F.count("*").alias("_a"))
        link = self._link()
        x = self.near.join(a, PAIR).groupBy(*dict.fromkeys([*link, *of_near, *of_assoc])).agg(F.sum("_a").alias("_n"))
        g = self.genes.groupBy(*dict.fromkeys([*link, *of_gene])).agg(F.count("*").alias("_g"))
        return x.join(g, link).select(*cols, (F.col("_n") * F.col("_g")).alias("n"))

    def distinct(self, *cols: str) -> DataFrame:
        """The distinct rows of cols, made from the parts that have them; the others are met by their keys alone."""
        of_near, of_assoc, of_gene = self._split(cols)
        link = self._link()
        if not of_gene:
            linked = self.near.join(self.genes.select(*link).distinct(), link, "left_semi")
            if set(cols) <= set(self.assoc.columns):
                return self.assoc.join(linked.select(*PAIR).distinct(), PAIR, "left_semi").select(*cols).distinct()
            return (linked.join(self.assoc.select(*PAIR, *of_assoc).distinct(), PAIR) if of_assoc else linked).select(*cols).distinct()
        x = self.near.join(self.assoc.select(*PAIR, *of_assoc).distinct(), PAIR) if of_assoc else self.near
        return x.select(*dict.fromkeys([*link, *of_near, *of_assoc])).distinct().join(self.genes.select(*dict.fromkeys([*link, *of_gene])), link).select(*cols).distinct()

    def first(self, keys: list[str], order: list[str]) -> DataFrame:
        """The first row of each of keys (columns of near) by order. As each column of order belongs to one of the parts,
        the first row of a pair is that of its genes with that of its associations."""
        of_near, of_assoc, of_gene = self._split(tuple(order))
        part = lambda df, own, by: first_per_group(df, own, by or own)
        g, a = part(self.genes, self._link(), of_gene), part(self.assoc, PAIR, of_assoc)
        return first_per_group(self.near.join(a, PAIR).join(g, self._link()), keys, order)


def wide_parts(assoc: DataFrame, members: DataFrame, scores: DataFrame, genes: DataFrame, ld: DataFrame, eqtl: DataFrame | None, mafs: DataFrame | None, terms: DataFrame | None,
               vep: DataFrame | None, snp38: DataFrame, gene38: DataFrame, tissues: list[str] | None = None, r2: float = 0.7, clpp: DataFrame | None = None, summed: dict[str, str] | None = None) -> WideTable:
    """The parts of assemble_output. Without eqtl, mafs, terms and vep there are no columns of these."""
    optional = {"pvalue_description": "string", "ci_start": "double", "ci_end": "double"}
    a = assoc.withColumns({c: F.lit(None).cast(k) for c, k in optional.items() if c not in assoc.columns})
    a = a.withColumn("gwas_pmid", clean_pmid("publication")).where("gwas_pmid is not null")
    a = a.select("cluster_id", F.col("rsid").alias("gwas_snp"), F.col("pvalue").alias("gwas_pvalue"), F.col("disease").alias("disease_name"), efo_short_form("efo").alias("disease_efo_id"),
                 F.col("source").alias("gwas_source"), F.col("pvalue_description").alias("gwas_pvalue_description"), F.col("odds_ratio").alias("gwas_odds_ratio"),
                 F.col("ci_start").alias("gwas_odds_ratio_ci_start"), F.col("ci_end").alias("gwas_odds_ratio_ci_end"), F.col("beta").alias("gwas_beta"), F.col("sample_size").alias("gwas_size"),
                 "gwas_pmid", F.col("study").alias("gwas_study"), F.col("reported_trait").alias("gwas_reported_trait"))
    leads = a.select("cluster_id", F.col("gwas_snp").alias("gwas_rsid")).distinct()
    if summed is not None:
        a = a.groupBy(*PAIR, "gwas_source", "gwas_study").agg(*[F.expr(x).alias(c) for c, x in summed.items()])
    near = ld_filter(main_assembly_only(members.select("cluster_id", "rsid", "chrom", "pos")).join(leads, "cluster_id"), ld, r2)
    near = near.select("cluster_id", F.col("gwas_rsid").alias("gwas_snp"), F.col("rsid").alias(LINK), "chrom", "pos", "r2", (F.col("rsid") == F.col("gwas_rsid")).cast("int").alias("ld_snp_is_gwas_snp"))
    tissues = ev.TISSUES if tissues is None else tissues
    # the rank is among all genes that a SNP has a score for, also those without a place
    rows = gene_rank(scores if eqtl is None else _noted(scores, eqtl, terms, vep, tissues)).join(_snp38(snp38).hint("merge"), "rsid")
    if mafs is not None:
        rows = rows.join(_frequencies(mafs).hint("merge"), "rsid", "left")
    rows = rows.join(_gene_places(genes, gene38), "gene_id").withColumnRenamed("rsid", LINK)
    if clpp is not None:
        by_tissue = clpp.groupBy("cluster_id", "gene_id", F.col("rsid").alias(LINK)).pivot("tissue", tissues).agg(F.max("clpp_snp"))
        by_tissue = by_tissue.select("cluster_id", "gene_id", LINK, *[F.col(f"`{t}`").alias(f"{t}_CLPP") for t in tissues])
        rows = near.select("cluster_id", LINK).distinct().join(rows, LINK).join(by_tissue, ["cluster_id", "gene_id", LINK], "left")
        rows = rows.withColumns({f"{t}_CLPP": F.coalesce(F.col(f"`{t}_CLPP`"), F.lit(0.0)) for t in tissues})
    return WideTable(near, rows, a)


def assemble_output(assoc: DataFrame, members: DataFrame, scores: DataFrame, genes: DataFrame, ld: DataFrame, eqtl: DataFrame | None, mafs: DataFrame | None, terms: DataFrame | None,
                    vep: DataFrame | None, snp38: DataFrame, gene38: DataFrame, tissues: list[str] | None = None, r2: float = 0.7, clpp: DataFrame | None = None, summed: dict[str, str] | None = None) -> DataFrame:
    """The wide table: a row for each association of a cluster's GWAS SNP, LD SNP and gene.

    assoc: cluster_id, rsid (GWAS SNP), pvalue, efo, disease, reported_trait, source, publication, study, sample_size,
    odds_ratio, beta, and if known pvalue_description, ci_start, ci_end; members: cluster_id, rsid, chrom, pos; scores: as
    v2g_scores; ld: rsid_a, rsid_b, r2; eqtl: as eqtl_index; mafs: rsid, mafs map; terms and vep: as vep_terms and
    vep_stats. Rows need a publication, both places on main chromosomes and r2 to the GWAS SNP. A left join adds what may
    be missing. With clpp (gene_id, cluster_id, rsid, tissue, clpp_snp) there is a <tissue>_CLPP column per tissue, 0
    where the SNP has none. What belongs to an LD SNP and gene is put together once, and associations meet the LD SNPs
    before these meet their genes (WideTable). Without eqtl, mafs, terms and vep there are no columns of these. With summed (column name: aggregate of the columns of associations) these
    are summed up for each GWAS SNP, source and study before they are joined, and the given columns stand for theirs.
    """
    parts = wide_parts(assoc, members, scores, genes, ld, eqtl, mafs, terms, vep, snp38, gene38, tissues, r2, clpp, summed)
    tissues = ev.TISSUES if tissues is None else tissues
    by_assoc = [c for c in parts.assoc.columns if c not in (*PAIR, "gwas_source", "gwas_study")]
    out = parts.rows()
    wanted = [LINK, *PLACE, *POPULATIONS, *GENE, "score", "rank", "r2", "cluster_id", "gwas_source", "gwas_snp", "gwas_study", *by_assoc, "ld_snp_is_gwas_snp", *VEP, *[f"GTEx_{t}" for t in tissues],
              *ev.CIS_SOURCES, *ev.REG_SOURCES, *([] if clpp is None else [f"{t}_CLPP" for t in tissues])]
    return out.select(*[f"`{c}`" for c in wanted if c in out.columns])
