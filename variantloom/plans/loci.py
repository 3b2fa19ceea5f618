"""Queries of filters, interval joins, LD and clustering."""

from __future__ import annotations

from ..functions.tables import stored
from ..operators import cluster, evidence, filters, graph, intervals, ld, output, tiles
from ..sources import index
from .base import ORACLES, F, query, rounded, shared, sql, view, window
from .sources import FDR

TRAITS = "SELECT rsid, pvalue, CASE WHEN line % 2 = 0 THEN array('E_9', 'E_' || efo) ELSE array('E_' || efo) END AS iris, 'T' || CAST(line AS STRING) AS reported_trait FROM {fx_gwas}"


@query("match_trait", "SELECT rsid, CASE WHEN efo IN ('RF', 'AF') THEN 'E_' || efo WHEN line % 2 = 0 THEN 'E_9' ELSE 'E_' || efo END AS efo, 'T' || CAST(line AS VARCHAR) AS reported_trait FROM {fx_gwas} WHERE efo IN ('RF', 'AF') OR line IN (1, 2)")
def _match(s, d):
    return filters.match_trait(sql(s, d, TRAITS), ["T1", "T2"], ["E_RF", "E_AF"]).select("rsid", "efo", "reported_trait")


@query("sane_associations", "SELECT rsid, pvalue, CASE WHEN line = 1 THEN 0 ELSE sample_size END AS sample_size, round(beta, 6) AS beta_coefficient FROM {fx_gwas} WHERE pvalue > 0 AND line <> 2 AND line <> 3 AND (line = 1 OR sample_size > 0)")
def _sane(s, d):
    a = sql(s, d, "SELECT rsid, pvalue, CASE line WHEN 1 THEN NULL WHEN 2 THEN 0 ELSE sample_size END AS sample_size, CASE line WHEN 3 THEN NULL ELSE round(beta, 6) END AS beta_coefficient, CAST(NULL AS DOUBLE) AS odds_ratio FROM {fx_gwas}")
    return filters.sane_associations(a, bayesian=True).select("rsid", "pvalue", F.expr("coalesce(sample_size, 0)").alias("sample_size"), "beta_coefficient")


@query("genome_wide", "SELECT rsid, pvalue FROM {fx_gwas} WHERE pvalue < 5e-8")
def _gw(s, d):
    return filters.genome_wide(view(s, d, "fx_gwas")).select("rsid", "pvalue")


CLUSTERS = "SELECT chrom || ':' || CAST(CAST(floor(pos / 1000000) AS BIGINT) AS VARCHAR(9)) AS cluster_id, rsid, chrom, pos FROM {fx_snp}"


@query("drop_blacklisted", f"WITH c AS ({CLUSTERS}) SELECT * FROM c WHERE cluster_id NOT IN (SELECT cluster_id FROM c WHERE (chrom = '6' AND pos >= 28477797 AND pos < 33448354) OR (chrom = '17' AND pos >= 44165260 AND pos < 44784489))")
def _black(s, d):
    return filters.drop_blacklisted(sql(s, d, CLUSTERS))


@query("protein_coding_only", "SELECT e.rsid, e.gene_id, e.tissue FROM {fx_eqtl} e WHERE gene_id IN (SELECT gene_id FROM {fx_gene} WHERE biotype = 'protein_coding')")
def _coding(s, d):
    return filters.protein_coding_only(view(s, d, "fx_eqtl"), view(s, d, "fx_gene")).select("rsid", "gene_id", "tissue")


@query("main_assembly_only", "SELECT rsid, CASE WHEN k % 10 = 4 THEN 'HSCHR6_MHC' ELSE chrom END AS chrom FROM {fx_snp} WHERE k % 10 <> 4")
def _main(s, d):
    return filters.main_assembly_only(sql(s, d, "SELECT rsid, CASE WHEN k % 10 = 4 THEN 'HSCHR6_MHC' ELSE chrom END AS chrom FROM {fx_snp}"))


@query("clean_pmid", "SELECT rsid, line, CASE line % 4 WHEN 3 THEN NULL ELSE 'PMID' || CAST(study_id AS VARCHAR) END AS pmid FROM {fx_gwas}")
def _pmid(s, d):
    a = sql(s, d, "SELECT rsid, line, CASE line % 4 WHEN 0 THEN 'PMID' WHEN 1 THEN '' WHEN 2 THEN 'PUBMEDID:' ELSE 'doi:' END || CAST(study_id AS STRING) AS publication FROM {fx_gwas}")
    return a.select("rsid", "line", filters.clean_pmid("publication").alias("pmid"))


def _near_leads(s, d, reach):
    """rsid, gwas_rsid: the SNPs at most reach bases from each lead, by bins: SQL would compare all of a chromosome."""
    leads = view(s, d, "fx_lead").select("chrom", F.col("rsid").alias("gwas_rsid"), F.expr(f"pos - {reach + 1}").alias("bstart"), F.expr(f"pos + {reach}").alias("bend"))
    return intervals.overlap(view(s, d, "fx_snp").select("rsid", "chrom", "pos"), leads, width=reach).select("rsid", "gwas_rsid")


@query("ld_filter", "SELECT p.rsid, p.gwas_rsid, CASE WHEN p.rsid = p.gwas_rsid THEN 1 ELSE round(l.r2, 6) END AS r2 FROM (SELECT s.rsid, l.rsid AS gwas_rsid FROM {fx_snp} s JOIN {fx_lead} l ON s.chrom = l.chrom AND abs(s.pos - l.pos) <= 100000) p LEFT JOIN {or_ld} l ON l.lead = p.gwas_rsid AND l.rsid = p.rsid WHERE p.rsid = p.gwas_rsid OR l.r2 >= 0.7")
def _ldf(s, d):
    rows = _near_leads(s, d, 100_000)
    found = window(s, d).select(F.col("lead").alias("rsid_a"), F.col("rsid").alias("rsid_b"), "r2")
    return rounded(filters.ld_filter(rows, found), "r2")


@query("drop_tiny_clusters", f"WITH c AS ({CLUSTERS}) SELECT * FROM c WHERE cluster_id IN (SELECT cluster_id FROM c GROUP BY cluster_id HAVING count(*) >= 10)")
def _tiny(s, d):
    return filters.drop_tiny_clusters(sql(s, d, CLUSTERS))


@query("efo_short_form", "SELECT rsid, line, 'EFO_' || efo AS efo FROM {fx_gwas}")
def _short(s, d):
    return sql(s, d, "SELECT rsid, line, 'http://www.ebi.ac.uk/efo/EFO_' || efo AS iri FROM {fx_gwas}").select("rsid", "line", filters.efo_short_form("iri").alias("efo"))


@query("ontology_of", "SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'efo' WHEN 1 THEN 'hp' WHEN 2 THEN 'go' WHEN 3 THEN 'ordo' WHEN 4 THEN 'cl' WHEN 5 THEN 'chebi' END AS ontology FROM {part}")
def _ontology(s, d):
    t = sql(s, d, "SELECT p_partkey, element_at(array('EFO_1', 'HP_1', 'GO_1', 'Orphanet_1', 'CL_1', 'CHEBI_1', 'MP_1'), CAST(p_partkey % 7 + 1 AS INT)) AS t FROM {part}")
    return t.select("p_partkey", filters.ontology_of("t").alias("ontology"))


@query("locate_snps", "SELECT rsid, chrom, CAST(floor((pos + pos + 3) / 2) AS BIGINT) AS pos FROM (SELECT rsid, chrom, pos, k FROM {fx_snp} WHERE k % 4 <> 3 UNION ALL SELECT 'ss' || substr(rsid, 3), chrom, pos, k FROM {fx_snp} WHERE k % 4 <> 3) x WHERE k % 3 <> 1")
def _locate(s, d):
    ref = sql(s, d, """SELECT rsid AS name, array('ss' || substr(rsid, 3)) AS synonyms, CASE WHEN k % 4 = 3 THEN array(named_struct('chrom', 'HG7', 'start', pos, 'end', pos)) ELSE array(named_struct('chrom', '9', 'start', pos - 5, 'end', pos),
      named_struct('chrom', chrom, 'start', pos, 'end', pos + 3), named_struct('chrom', 'HG7', 'start', pos, 'end', pos)) END AS mappings FROM {fx_snp}""")
    wanted = sql(s, d, "SELECT rsid FROM {fx_snp} WHERE k % 3 <> 1 UNION ALL SELECT 'ss' || substr(rsid, 3) FROM {fx_snp} WHERE k % 3 <> 1")
    return intervals.locate_snps(wanted, ref)


@query("resolve_genes", "SELECT b.feature_id, g.gene_id, CASE WHEN g.tss % 2 = 0 THEN g.tss ELSE g.tss + 900 END AS tss FROM {fx_bed} b JOIN {fx_gene} g ON b.gene_id = g.gene_id")
def _resolve(s, d):
    ref = sql(s, d, "SELECT gene_id, name, chrom, tss AS start, tss + 900 AS end, CASE WHEN tss % 2 = 0 THEN 1 ELSE -1 END AS strand, biotype FROM {fx_gene}")
    rows = sql(s, d, "SELECT b.feature_id, CASE WHEN feature_id % 2 = 0 THEN b.gene_id ELSE g.name END AS gene FROM {fx_bed} b LEFT JOIN {fx_gene} g ON b.gene_id = g.gene_id")
    return intervals.resolve_genes(rows, ref).select("feature_id", "gene_id", "tss")


@query("overlap", "SELECT rsid, feature_id, gene_id FROM {or_overlap}")
def _overlap(s, d):
    return intervals.overlap(view(s, d, "fx_snp"), view(s, d, "fx_bed")).select("rsid", "feature_id", "gene_id")


@query("nearest", "SELECT * FROM {or_nearest}")
def _nearest(s, d):
    return intervals.nearest(view(s, d, "fx_snp"), view(s, d, "fx_gene").select("chrom", "tss", "gene_id")).select("rsid", "gene_id", "distance")


@query("mean_signal", "SELECT rsid, round(avg(v), 4) AS score FROM (SELECT s.rsid, b.score AS v FROM {fx_snp} s JOIN {fx_bed} b ON s.chrom = b.chrom AND b.bstart < s.pos AND s.pos <= b.bend WHERE b.feature_id % 11 <> 0 UNION ALL SELECT s.rsid, b.score FROM {fx_snp} s JOIN {fx_bed} b ON s.chrom = b.chrom AND b.bstart < s.pos + 1 AND s.pos + 1 <= b.bend WHERE b.feature_id % 11 <> 0) x GROUP BY rsid")
def _signal(s, d):
    signal = sql(s, d, "SELECT chrom, bstart, bend, CASE WHEN feature_id % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE score END AS value FROM {fx_bed}")
    return rounded(intervals.mean_signal(view(s, d, "fx_snp"), signal), "score", places=4)


@query("index_overlap", "SELECT rsid, feature_id, gene_id FROM {or_overlap}")
def _index_overlap(s, d):
    return index.overlap(view(s, d, "fx_snp"), index.write_intervals(view(s, d, "fx_bed"))).select("rsid", "feature_id", "gene_id")


@query("index_nearest", "SELECT * FROM {or_nearest}")
def _index_nearest(s, d):
    places = index.write_places(view(s, d, "fx_gene").select("chrom", "tss", "gene_id"))
    return index.nearest(view(s, d, "fx_snp"), places).select("rsid", "gene_id", "distance")


@query("index_signal", ORACLES["mean_signal"])
def _index_signal(s, d):
    signal = sql(s, d, "SELECT chrom, bstart, bend, CASE WHEN feature_id % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE score END AS value FROM {fx_bed}")
    return rounded(index.mean_signal(view(s, d, "fx_snp"), index.write_intervals(signal)), "score", places=4)


FDR_SCORE = f"SELECT o.rsid, o.gene_id, o.feature_id, round(1 - m.fdr, 6) AS score FROM {{or_overlap}} o JOIN {{fx_gene}} g ON o.gene_id = g.gene_id AND o.chrom = g.chrom JOIN (SELECT c.bin, 0.99 * coalesce((SELECT n FROM ({FDR}) z WHERE bin = 49), 0) / c.n AS fdr FROM ({FDR}) c) m ON m.bin = CAST(floor(abs(o.pos - g.tss) / 10000) AS INT) WHERE abs(o.pos - g.tss) <= 500000 AND m.fdr <> 1"


@query("apply_fdr_model", FDR_SCORE)
def _fdr(s, d):
    from ..operators import prep

    genes = view(s, d, "fx_gene")
    pairs = intervals.overlap(view(s, d, "fx_snp"), view(s, d, "fx_bed").drop("score")).join(genes.select("gene_id", F.col("chrom").alias("gene_chrom"), "tss"), "gene_id")
    return rounded(evidence.apply_fdr_model(pairs, prep.fit_fdr_model(view(s, d, "fx_bed"), genes)).select("rsid", "gene_id", "feature_id", "score"), "score")


@query("pchic_evidence", "SELECT rsid, gene_id, round(score, 6) AS score FROM {or_overlap} WHERE score > 5")
def _pchic_ev(s, d):
    return rounded(evidence.pchic_evidence(view(s, d, "fx_snp"), view(s, d, "fx_bed")).drop("source"), "score")


@query("regulome_evidence", "SELECT s.rsid, CASE WHEN left(b.category, 1) IN ('1', '2') THEN 1.0 ELSE 0.5 END AS score FROM {fx_snp} s JOIN {fx_regulome} b ON s.chrom = b.chrom AND b.bstart < s.pos AND s.pos <= b.bend")
def _regulome(s, d):
    return evidence.regulome_evidence(view(s, d, "fx_snp"), view(s, d, "fx_regulome")).drop("source")


@query("add_grch38", "SELECT e.rsid, e.gene_id, e.tissue, s.pos + 1000 AS snp38_pos, g.tss + 1000 AS gene38_tss FROM {fx_eqtl} e JOIN {fx_snp} s ON e.rsid = s.rsid JOIN {fx_gene} g ON e.gene_id = g.gene_id WHERE s.k % 9 <> 0 AND g.tss % 3 <> 0")
def _38(s, d):
    snp = sql(s, d, "SELECT rsid, CASE WHEN k % 9 = 0 THEN 'HG9' ELSE chrom END AS chrom, pos + 1000 AS pos FROM {fx_snp}")
    gene = sql(s, d, "SELECT gene_id, chrom, tss + 1000 AS tss FROM {fx_gene} WHERE tss % 3 <> 0")
    return intervals.add_grch38(view(s, d, "fx_eqtl"), snp, gene).select("rsid", "gene_id", "tissue", "snp38_pos", "gene38_tss")


def _all_pairs(s, d):
    return ld.near_pairs(view(s, d, "fx_lead"), shared(s, d), 250_000)


@query("genotype_pair_counts", "SELECT lead, rsid, " + ", ".join(f"CAST(n{i}{j} AS INT) AS n{i}{j}" for i in range(3) for j in range(3)) + " FROM {or_counts}")
def _counts(s, d):
    return _all_pairs(s, d).select("lead", "rsid", *tiles.COUNTS)


@query("ld_r2", "SELECT lead, rsid, CAST(n AS INT) AS n, round(r2, 6) AS r2 FROM {or_ld}")
def _r2(s, d):
    return rounded(_all_pairs(s, d).select("lead", "rsid", "n", "r2"), "r2")


@query("ld_prune", "SELECT lead, rsid, round(r2, 6) AS r2 FROM {or_ld} WHERE n >= 40 AND r2 >= 0.05")
def _prune(s, d):
    return rounded(ld.prune_weak(_all_pairs(s, d)).select("lead", "rsid", "r2"), "r2")


@query("ld_dprime", "SELECT lead, rsid, round(d_prime, 6) AS d_prime FROM {or_ld}")
def _dprime(s, d):
    return rounded(_all_pairs(s, d).select("lead", "rsid", "d_prime"), "d_prime")


@query("ld_pearson", "SELECT p.lead, p.rsid, round(corr(a.dosage, b.dosage), 6) AS r FROM {or_pairs} p JOIN {fx_geno} a ON a.rsid = p.lead JOIN {fx_geno} b ON b.rsid = p.rsid AND a.sample_id = b.sample_id GROUP BY p.lead, p.rsid")
def _pearson(s, d):
    return rounded(_all_pairs(s, d).select("lead", "rsid", "r"), "r")


@query("ld_window", "SELECT lead, rsid, chrom, pos, round(r2, 6) AS r2 FROM {or_window}")
def _window(s, d):
    return rounded(window(s, d), "r2")


BLOCKS = "SELECT cluster_id, rsid, chrom, pos FROM {fx_block}"


@query("pairwise_ld", f"WITH c AS ({BLOCKS}) SELECT x.cluster_id, x.rsid AS rsid_a, y.rsid AS rsid_b, CASE WHEN x.rsid = y.rsid THEN 1 ELSE round(corr(a.dosage, b.dosage), 6) END AS r FROM c x JOIN c y ON x.cluster_id = y.cluster_id AND x.rsid <= y.rsid JOIN {{fx_geno}} a ON a.rsid = x.rsid JOIN {{fx_geno}} b ON b.rsid = y.rsid AND a.sample_id = b.sample_id GROUP BY x.cluster_id, x.rsid, y.rsid")
def _pairwise(s, d):
    return rounded(ld.pairwise_ld(sql(s, d, BLOCKS), shared(s, d)).select("cluster_id", "rsid_a", "rsid_b", "r"), "r")


@query("ld_to_top", "SELECT l.rsid AS cluster_id, s.rsid, CASE WHEN s.rsid = l.rsid THEN 1 ELSE round(x.r2, 6) END AS ld FROM {fx_lead} l JOIN {fx_snp} s ON l.chrom = s.chrom AND abs(l.pos - s.pos) <= 50000 LEFT JOIN {or_ld} x ON x.lead = l.rsid AND x.rsid = s.rsid")
def _top(s, d):
    m = _near_leads(s, d, 50_000).withColumnRenamed("gwas_rsid", "cluster_id")
    t = sql(s, d, "SELECT rsid AS cluster_id, rsid FROM {fx_lead}")
    return rounded(ld.ld_to_top(m, t, shared(s, d)), "ld")


@query("merge_edges", "SELECT a, b FROM {or_edges}")
def _edges(s, d):
    return cluster.merge_edges(view(s, d, "fx_lead"), window(s, d))


REACH = "WITH RECURSIVE e AS (SELECT a, b FROM {or_edges} UNION SELECT b, a FROM {or_edges}), r AS (SELECT rsid AS root, rsid AS node FROM {fx_lead} UNION SELECT r.root, e.b FROM r JOIN e ON r.node = e.a), lab AS (SELECT root AS rsid, min(node) AS cluster_id FROM r GROUP BY root)"


@query("merge_preclusters", REACH + " SELECT l.rsid, l.pvalue, lab.cluster_id FROM {fx_lead} l JOIN lab USING (rsid)")
def _merge(s, d):
    return cluster.merge_preclusters(view(s, d, "fx_lead"), window(s, d)).select("rsid", "pvalue", "cluster_id")


RANGES = REACH + ", mem AS (SELECT DISTINCT lab.cluster_id, w.rsid, w.chrom, w.pos FROM {or_window} w JOIN lab ON lab.rsid = w.lead), rng AS (SELECT m.cluster_id, m.chrom, min(m.pos) AS first, max(m.pos) AS last, p.pvalue FROM mem m JOIN (SELECT cluster_id, min(pvalue) AS pvalue FROM lab JOIN {fx_lead} USING (rsid) GROUP BY cluster_id) p USING (cluster_id) GROUP BY m.cluster_id, m.chrom, p.pvalue)"


def _ranges(s, d):
    w = window(s, d)
    lab = stored(cluster.merge_preclusters(view(s, d, "fx_lead"), w), "labelled")
    m = cluster.cluster_members(lab, w)
    return lab, m, cluster.cluster_ranges(lab, m)


@query("cluster_union", RANGES + " SELECT cluster_id, rsid FROM mem")
def _union(s, d):
    return _ranges(s, d)[1].select("cluster_id", "rsid")


@query("remove_overlaps", RANGES + " SELECT * FROM rng a WHERE NOT EXISTS (SELECT 1 FROM rng b WHERE a.chrom = b.chrom AND a.cluster_id <> b.cluster_id AND a.first <= b.last AND b.first <= a.last AND b.pvalue < a.pvalue)")
def _remove(s, d):
    return cluster.remove_overlaps(_ranges(s, d)[2])


def clusters_sql(win: str, lead: str) -> str:
    """WITH RECURSIVE ..: clusters from LD sets and leads, up to ids (cluster_id, merged_id), as plain set operations."""
    return f"""WITH RECURSIVE bad AS (SELECT DISTINCT lead FROM {win} WHERE (chrom = '6' AND pos >= 28477797 AND pos < 33448354) OR (chrom = '17' AND pos >= 44165260 AND pos < 44784489)),
  win AS (SELECT * FROM {win} WHERE lead NOT IN (SELECT lead FROM bad)), top AS (SELECT * FROM {lead} WHERE rsid NOT IN (SELECT lead FROM bad)),
  edge AS (SELECT DISTINCT w.rsid AS a, w.lead AS b FROM win w JOIN top a ON a.rsid = w.rsid JOIN top b ON b.rsid = w.lead WHERE a.chrom = b.chrom AND (a.pvalue < b.pvalue OR (a.pvalue = b.pvalue AND a.rsid < b.rsid)) AND b.pvalue * 1e-3 <= a.pvalue),
  e AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge), r AS (SELECT rsid AS root, rsid AS node FROM top UNION SELECT r.root, e.b FROM r JOIN e ON r.node = e.a),
  lab AS (SELECT root AS rsid, min(node) AS cluster_id FROM r GROUP BY root), {MERGED}"""


MERGED = """mem AS (SELECT DISTINCT lab.cluster_id, w.rsid, w.chrom, w.pos FROM win w JOIN lab ON lab.rsid = w.lead),
  rng AS (SELECT m.cluster_id, m.chrom, min(m.pos) AS first, max(m.pos) AS last, p.pvalue FROM mem m JOIN (SELECT cluster_id, min(pvalue) AS pvalue FROM lab JOIN top USING (rsid) GROUP BY cluster_id) p USING (cluster_id) GROUP BY m.cluster_id, m.chrom, p.pvalue),
  stay AS (SELECT * FROM rng a WHERE NOT EXISTS (SELECT 1 FROM rng b WHERE a.chrom = b.chrom AND a.cluster_id <> b.cluster_id AND a.first <= b.last AND b.first <= a.last AND b.pvalue < a.pvalue)),
  tied AS (SELECT row_number() OVER (ORDER BY pvalue, a, b) AS n, a, b FROM (SELECT DISTINCT x.pvalue, x.cluster_id AS a, y.cluster_id AS b FROM stay x JOIN stay y ON x.chrom = y.chrom AND x.first <= y.last AND y.first <= x.last AND x.pvalue = y.pvalue AND x.cluster_id < y.cluster_id
    WHERE EXISTS (SELECT 1 FROM mem m JOIN mem o ON m.rsid = o.rsid WHERE m.cluster_id = x.cluster_id AND o.cluster_id = y.cluster_id))),
  greedy AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS b UNION ALL
    SELECT g.i + 1, CASE WHEN list_contains(g.used, t.a) OR list_contains(g.used, t.b) THEN g.used ELSE g.used || [t.a, t.b] END, CASE WHEN list_contains(g.used, t.a) OR list_contains(g.used, t.b) THEN NULL ELSE t.a END, t.b FROM greedy g JOIN tied t ON t.n = g.i + 1),
  ids AS (SELECT s.cluster_id, coalesce(g.a, s.cluster_id) AS merged_id FROM (SELECT DISTINCT cluster_id FROM stay) s LEFT JOIN (SELECT a, b FROM greedy WHERE a IS NOT NULL) g ON g.b = s.cluster_id),
  mm AS (SELECT DISTINCT ids.merged_id AS cluster_id, mem.rsid, mem.chrom, mem.pos FROM mem JOIN ids ON ids.cluster_id = mem.cluster_id),
  big AS (SELECT * FROM mm WHERE cluster_id IN (SELECT cluster_id FROM mm GROUP BY cluster_id HAVING count(*) >= 10)),
  final AS (SELECT t.rsid, t.chrom, t.pos, t.pvalue, ids.merged_id AS cluster_id FROM top t JOIN lab USING (rsid) JOIN ids ON ids.cluster_id = lab.cluster_id WHERE ids.merged_id IN (SELECT cluster_id FROM big))"""


@query("merge_tied_overlaps", REACH + ", win AS (SELECT * FROM {or_window}), top AS (SELECT * FROM {fx_lead}), " + MERGED + " SELECT cluster_id, merged_id FROM ids")
def _tied(s, d):
    _, m, r = _ranges(s, d)
    kept = stored(cluster.remove_overlaps(r), "ranges")
    return cluster.merge_tied_overlaps(kept, stored(m, "members"))


@query("cluster_gwas_snps", clusters_sql("{or_window}", "{fx_lead}") + " SELECT f.cluster_id, f.rsid, f.pvalue, n.n_members FROM final f JOIN (SELECT cluster_id, count(*) AS n_members FROM big GROUP BY cluster_id) n USING (cluster_id)")
def _clusters(s, d):
    lab, m = cluster.cluster_gwas_snps(view(s, d, "fx_lead"), shared(s, d))
    return lab.select("cluster_id", "rsid", "pvalue").join(m.groupBy("cluster_id").agg(F.count("*").alias("n_members")), "cluster_id")


@query("descendants", "WITH RECURSIVE r AS (SELECT parent AS root, child AS node FROM {fx_edges} UNION SELECT r.root, e.child FROM r JOIN {fx_edges} e ON e.parent = r.node) SELECT root, node FROM r")
def _desc(s, d):
    e = view(s, d, "fx_edges")
    return graph.descendants(e, e.select(F.col("parent").alias("node")))


@query("expand_terms", "WITH RECURSIVE r AS (SELECT parent AS node FROM {fx_edges} WHERE parent IN (1, 4) UNION SELECT e.child FROM r JOIN {fx_edges} e ON e.parent = r.node) SELECT node FROM r")
def _expand(s, d):
    e = view(s, d, "fx_edges")
    return graph.expand_terms(e, e.where("parent in (1, 4)").select(F.col("parent").alias("node")))


@query("gwas_snps", "SELECT rsid, min(pvalue) AS pvalue FROM {fx_gwas} GROUP BY rsid")
def _gwas(s, d):
    return output.gwas_snps(view(s, d, "fx_gwas")).select("rsid", "pvalue")


@query("gwas_snps_largest", "SELECT rsid, max(pvalue) AS pvalue FROM {fx_gwas} GROUP BY rsid HAVING max(pvalue) < 5e-8")
def _gwas_max(s, d):
    return filters.genome_wide(output.gwas_snps(view(s, d, "fx_gwas"), keep="max")).select("rsid", "pvalue")


@query("ontology_label", "SELECT p_partkey, efo, CASE WHEN efo = 'N/A' THEN 'N/A' ELSE label END AS label FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'N/A' ELSE m.efo END AS efo, m.trait AS label FROM {part} p JOIN {fx_map} m ON p.p_type = m.trait) x")
def _label(s, d):
    rows = sql(s, d, "SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'N/A' ELSE m.efo END AS efo FROM {part} p JOIN {fx_map} m ON p.p_type = m.trait")
    return filters.ontology_label(rows, sql(s, d, "SELECT efo, trait AS label FROM {fx_map}")).select("p_partkey", "efo", "label")
