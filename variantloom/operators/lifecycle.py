"""Runs: from associations of wanted traits to clusters (the first half, whose second half is assemble_output), and on to
colocalisation with expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from ..functions.tables import stored
from . import cluster, filters, finemap, ld, output


def trait_clusters(assoc: DataFrame, located: DataFrame, packed: DataFrame, diseases: list[str] = (), iris: list[str] = (), least: int = 10) -> dict[str, DataFrame]:
    """Associations (rsid, pvalue, iris, reported_trait, sample_size, ..), located SNPs (rsid, chrom, pos) and packed
    genotypes -> tables of a run:

    assoc: the wanted, sane associations of the clusters' GWAS SNPs with cluster_id and efo; leads: cluster_id, rsid,
    chrom, pos, pvalue (least of the SNP) of genome-wide significant SNPs; members: cluster_id, rsid, chrom, pos; ld:
    lead, rsid, r2. SNPs without a place are dropped, and so are clusters in blacklisted regions, beaten by an
    overlapping one, or of fewer than `least` SNPs. Without a wanted association all tables are empty.
    """
    wanted = stored(filters.sane_associations(filters.match_trait(assoc, diseases, iris)), "wanted")
    best = filters.genome_wide(output.gwas_snps(wanted.select("rsid", "pvalue").where("pvalue is not null")))
    leads = stored(located.select("rsid", "chrom", "pos").join(best, "rsid").select("rsid", "chrom", "pos", "pvalue"), "leads")
    sets = stored(ld.ld_window(leads, packed), "sets")
    labelled, members = cluster.cluster_gwas_snps(leads, packed, least, sets)
    labelled = stored(labelled, "leads")
    return {"assoc": wanted.join(labelled.select("rsid", "cluster_id"), "rsid"), "leads": labelled, "members": stored(members, "members"), "ld": sets.select("lead", "rsid", "r2")}


def lead_z_scores(assoc: DataFrame) -> DataFrame:
    """Associations (cluster_id, rsid, pvalue, odds_ratio, beta) -> cluster_id, rsid, z, beta by the least p value of a SNP
    in its cluster (then by odds ratio and beta). Those without a direction have no z."""
    best = assoc.groupBy("cluster_id", "rsid").agg(F.min_by(F.struct("pvalue", "odds_ratio", "beta"), F.struct("pvalue", "odds_ratio", "beta")).alias("best"))
    z, beta = scoring.z_of_association(F.col("best.pvalue"), F.col("best.odds_ratio"), F.col("best.beta"))
    return best.select("cluster_id", "rsid", z.alias("z"), beta.alias("beta"))


def cluster_z_scores(leads: DataFrame, members: DataFrame, packed: DataFrame, stats: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """GWAS SNPs (cluster_id, rsid, z, beta), members (cluster_id, rsid) and summary statistics (rsid, pvalue, beta) ->
    cluster_id, rsid, z, beta, origin; each cluster by one way for all of its SNPs:

    associations: every member is a GWAS SNP with a z score; else file: the members that the statistics hold, the others
    are left out; else (no statistics, or none of its members in them) imputed from the GWAS SNPs by LD. LD is computed for
    the imputed clusters alone, unless pairs (cluster_id, rsid_a, rsid_b, r) are given. Clusters in which nothing is known
    give no rows. Repeated rows of members and GWAS SNPs count once.
    """
    own = members.select("cluster_id", "rsid").distinct()
    known = leads.where("z is not null").groupBy("cluster_id", "rsid").agg(F.min(F.struct("z", "beta")).alias("g"))
    table = own.join(known, ["cluster_id", "rsid"], "left").select("cluster_id", "rsid", F.col("g.z").alias("z"), F.col("g.beta").alias("beta"))
    if stats is None:
        table = table.withColumns({"file_z": F.lit(None).cast("double"), "file_beta": F.lit(None).cast("double")})
    else:
        wanted = stats.select("rsid", "pvalue", "beta").join(own.select("rsid").distinct(), "rsid", "left_semi")
        found = finemap.attach_summary_stats(own, wanted).select("cluster_id", "rsid", F.col("z").alias("file_z"), F.col("beta").alias("file_beta"))
        table = table.join(found, ["cluster_id", "rsid"], "left")
    way = F.when(F.count("*") == F.count("z"), "associations").when(F.count("file_z") > 0, "file").otherwise("imputed")
    table = stored(table.join(table.groupBy("cluster_id").agg(way.alias("origin")), "cluster_id"), "z")
    told = table.where("origin = 'associations'").select("cluster_id", "rsid", "z", "beta", "origin")
    filed = table.where("origin = 'file' and file_z is not null").select("cluster_id", "rsid", F.col("file_z").alias("z"), F.col("file_beta").alias("beta"), "origin")
    need = table.where("origin = 'imputed'").select("cluster_id", "rsid", "z", "beta")
    near = ld.pairwise_ld(need, packed) if pairs is None else pairs.join(need.select("cluster_id").distinct(), "cluster_id", "left_semi")
    guessed = finemap.impute_z(need, near).select("cluster_id", "rsid", "z", "beta", F.lit("imputed").alias("origin"))
    return told.unionByName(filed).unionByName(guessed)


def summary_stats_to_clpp(assoc: DataFrame, located: DataFrame, packed: DataFrame, index: DataFrame, stats: DataFrame | None = None, diseases: list[str] = (), iris: list[str] = (),
                          least: int = 10, n: int = 1000, n_eqtl: int = finemap.EQTL_SAMPLES, kmax: int = 1) -> tuple[DataFrame, DataFrame]:
    """A run from associations to colocalisation -> (clpp_table, z scores).

    Associations become clusters (trait_clusters), the members of a cluster get z scores (cluster_z_scores), sets of up to
    kmax of them get posteriors for the trait and, by eQTLs (index: gene_id, tissue, rsid, z, beta), for the expression of
    each gene and tissue, and both are multiplied. A cluster's label is its cluster_id. LD is needed for all clusters only
    if kmax > 1; it is then computed once, and members without an eQTL are imputed too.
    """
    run = trait_clusters(assoc, located, packed, diseases, iris, least)
    pairs = stored(ld.pairwise_ld(run["members"], packed).select("cluster_id", "rsid_a", "rsid_b", "r"), "pairs") if kmax > 1 else None
    z = stored(cluster_z_scores(lead_z_scores(run["assoc"]), run["members"], packed, stats, pairs), "z")
    gwas = finemap.posterior(finemap.configurations(z, pairs, n, kmax))
    both = finemap.colocalise_singles(gwas, index, n_eqtl) if kmax == 1 else finemap.colocalise(gwas, finemap.eqtl_configurations(z, index, n_eqtl, pairs, kmax))
    return finemap.clpp_table(both), z
